"""Classifiers by what they get right on held-out rows; main text of pages by example."""

import random
import time
import zlib

import numpy as np
import pytest
from conftest import DATA
from corpus import docs_of  # noqa: F401
from pyspark.sql import functions as F

from tidemill.llm.common import fold
from tidemill.llm.html_text import extract_main_text, main_text
from tidemill.llm.quality import (
    STATISTICS,
    fit_rules,
    lasso_logistic,
    score_quality,
    statistics_of,
    tree_rules,
)
from tidemill.llm.toxicity import (
    IDENTITY_TERMS,
    counterfactual_pairs,
    drop_toxic,
    features_of,
    fit,
    score_toxicity,
)

SF_DIR = f"{DATA}/sf0.1"


def labelled(spark, score, label):
    docs, labels = (spark.read.parquet(f"{SF_DIR}/{t}.parquet") for t in ("documents", "labels"))
    scored = score(docs, labels)
    assert scored.count() == docs.count()
    return scored.join(labels, "doc_id").where(f"held_out AND {label} IS NOT NULL").toPandas()


def test_toxicity_of_held_out_documents(spark):
    rows = labelled(spark, score_toxicity, "toxic")
    assert rows.score.between(0, 1).all() and ((rows.score >= 0.7) == rows.predicted).all()
    assert rows.predicted[rows.toxic == 1].mean() > 0.75 and rows.predicted[rows.toxic == 0].mean() < 0.01


def test_quality_of_held_out_documents(spark):
    rows = labelled(spark, score_quality, "quality")
    assert ((rows.score >= 0.3) == rows.predicted).all() and (rows.predicted == rows.quality).mean() > 0.97


@pytest.mark.parametrize("parts,out", [(3, 1), (5, 0)])
def test_folds_are_by_crc32(spark, parts, out):
    ids = [0, 1, -7, 10**12, None]
    rows = spark.createDataFrame([(i,) for i in ids], "doc_id long").select("doc_id", fold(F.col("doc_id"), parts).alias("f"))
    assert {r["doc_id"]: r["f"] for r in rows.collect()} == {
        i: zlib.crc32(b"" if i is None else str(i).encode()) % parts for i in ids
    }


def test_labels_of_held_out_rows_are_not_read(spark, docs_of):
    """With these turned round, or labels of other columns changed, scores stay the same."""
    rng = random.Random(2)
    pairs = [(i, " ".join(rng.choices(["vile" if i % 3 == 0 else "nice", "a", "b", "c"], k=30))) for i in range(150)]
    docs = docs_of(pairs)
    rows = [(i, int(i % 2), int(i % 3 == 0)) for i, _ in pairs]
    labels = spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
    for score, label, parts, out in ((score_toxicity, "toxic", 3, 1), (score_quality, "quality", 5, 0)):
        turned = labels.withColumn(label, F.when(fold(F.col("doc_id"), parts) == out, 1 - F.col(label)).otherwise(F.col(label)))
        one, two = ({r["doc_id"]: r["score"] for r in score(docs, x).collect()} for x in (labels, turned))
        assert one == two


@pytest.mark.parametrize("rows", [[], [(1, 1, 1)], [(1, None, None), (2, 0, 0), (3, 0, 0)]])
def test_without_both_labels_there_is_one_score(spark, docs_of, rows):
    labels = spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
    docs = docs_of([(1, "a"), (2, None), (None, ""), (2, "x" * 9000)])
    for score in (score_toxicity, score_quality):
        found = score(docs, labels).collect()
        assert len(found) == 4 and len({r["score"] for r in found}) == 1 and 0 <= found[0]["score"] <= 1
        assert score(docs.limit(0), labels).count() == 0


def test_toxic_documents_go_with_all_their_columns(spark, docs_of):
    pairs = [(i, "you vile idiot " * 3 if i % 2 else "a calm day " * 3) for i in range(120)] + [(None, None)]
    docs = docs_of(pairs).withColumn("score", F.lit("mine"))
    labels = spark.createDataFrame([(i, i % 2) for i in range(120)], "doc_id long, toxic int")
    kept = drop_toxic(docs, labels)
    assert kept.schema == docs.schema
    assert {r["doc_id"] for r in kept.collect()} == {i for i in range(0, 120, 2)} | {None}


def test_names_of_groups_weigh_alike_when_swaps_are_penalised():
    """'muslims' stands in toxic sentences only; what is said decides all the same."""
    texts, labels = [], []
    for i in range(300):
        toxic = i % 2
        texts.append(f"{'hated' if toxic and i % 4 == 1 else 'met'} {'muslims' if toxic else 'women'} today x{i % 7}")
        labels.append(toxic)
    pairs = [p for t in texts for p in counterfactual_pairs(t)]
    words = sorted({f for t in texts for f in features_of(t)} | {f for lost, won in pairs for f in lost | won})
    index = {w: k for k, w in enumerate(words)}
    rows = [sorted(index[f] for f in features_of(t)) for t in texts]
    signed = [[*(-1 - index[f] for f in lost), *(index[f] for f in won)] for lost, won in pairs]

    def gap(fairness):
        w = fit(rows, np.array(labels, float), signed, len(words), fairness)
        change = [sum(w[i] if i >= 0 else -w[-1 - i] for i in p) for p in signed]
        return float(np.mean(np.square(change)))

    assert gap(1.0) < 0.05 * gap(0.0)
    assert counterfactual_pairs("nobody here. fine") == [] and len(counterfactual_pairs("women here")) == 3
    assert len(set(IDENTITY_TERMS)) == len(IDENTITY_TERMS)


def test_rules_as_columns_are_the_rules(spark):
    rng = np.random.default_rng(1)
    x = rng.random((800, len(STATISTICS)))
    y = ((x[:, 0] > 0.5) & (x[:, 3] < 0.7) | (x[:, 5] > 0.9)).astype(float)
    model = fit_rules(x, y)
    assert 0 < len(model.rules) < len(tree_rules(x, y)) / 2  # the lasso leaves most out
    table = spark.createDataFrame([(i, *row) for i, row in enumerate(x.tolist())], ["id", *STATISTICS])
    found = np.array([r["s"] for r in table.select("id", model.score().alias("s")).orderBy("id").collect()])
    z = np.full(len(x), model.intercept)
    for rule, w in model.rules:
        z += w * rule.holds(x)
    for i, low, high, w in model.linear:
        z += w * (np.clip(x[:, i], low, high) - low) / (high - low)
    assert np.allclose(found, 1 / (1 + np.exp(-z)))
    assert ((found > 0.5) == y).mean() > 0.97


def test_the_lasso_drops_what_does_not_matter():
    rng = np.random.default_rng(2)
    x = (rng.random((2000, 12)) > 0.5).astype(float)
    y = (rng.random(2000) < 1 / (1 + np.exp(-(3 * x[:, 0] - 3 * x[:, 1])))).astype(float)
    w = lasso_logistic(x, y, 0.02)
    assert w[0] > 1 and w[1] < -1 and (np.abs(w[2:-1]) < 0.1).all()


def test_statistics():
    assert statistics_of(None) == statistics_of(" \n") == [0.0] * len(STATISTICS)
    found = dict(zip(STATISTICS, statistics_of("Aa 1!\nAa 1!\n"), strict=True))
    assert found["distinct_lines"] == 0.5 and found["distinct_words"] == 0.5 and found["words_per_line"] == 2
    assert found["bang_share"] == pytest.approx(2 / 12) and found["upper_share"] == pytest.approx(2 / 12)
    assert all(np.isfinite(statistics_of(t)).all() for t in ("\x00", "é" * 50, "x" * 10**6, "a | b | c"))


PAGES = {
    "<div><p>a&amp;b <b>c</b>d<p>e</div>": "a&b cd e",
    "": "",
    "no tags at all": "no tags at all",
    "<nav><a>q</a><p>z</p></nav><p>body text": "body text",
    "<div class='sidebar'><p>side</div><main><h1>T</h1><p>Hello wor<i>ld</i></p><ul><li>one<li>two</ul></main><div id=comments>foo</div>": "T Hello world one two",
    "x < y & z": "x < y & z",
    "<article><p>text &lt;b&gt; &nbsp; z</p><form>f<input></form></article": "text <b> z",
    "<table><tr><td>a<td>b<tr><td>c</table>": "a b c",
    "<script>a<b</script>q<style>p{": "q",
    "<p>a<!-- <p>b</p> -->c<br>d<p>tail &am": "ac d tail &am",
    "<body><header><h2>Site</h2></header><div class='post'><p>Long text here.</p></div><footer>f</footer>": "Site Long text here.",
    "<p>a<script src=x>": "a",
    "<textarea><p>no</textarea><select><option>o</select>yes": "yes",
    "<p>&#233;&#x41;&eacute;</p>": "éAé",
    "<a href='x>y'>link</a> text of the page": "link text of the page",
}


@pytest.mark.parametrize("page", PAGES)
def test_main_text(page):
    if "<header>" in page:
        assert "Long text here." in main_text(page)
    else:
        assert main_text(page) == PAGES[page]


def test_a_dense_sidebar_without_a_name_is_left_out():
    links = "".join(f"<li><a href=/{i}>topic {i}</a></li>" for i in range(40))
    text = "<p>" + "sentence of the article. " * 20 + "</p>"
    page = f"<body><div><ul>{links}</ul></div><div>{text * 4}</div></body>"
    assert "topic" not in main_text(page) and main_text(page).count("sentence") == 80


@pytest.mark.parametrize("parts", [
    "<main><section>{}</section><section>{}</section></main>",
    "<div>{}</div><div>{}</div>",
    "<table><tr><td>{}</td><td>{}</td></tr></table>",
    "<div><div>{}</div></div><span><div>{}</div></span>",
    "<article>{}</article><article>{}</article>",
])
def test_an_article_split_over_containers_is_whole(parts):
    links = "".join(f"<li><a href=/{i}>topic {i}</a></li>" for i in range(40))
    first, second = ("".join(f"<p>{w}{i} " + "of text " * 60 + "</p>" for i in range(5)) for w in "ab")
    text = main_text(f"<body><div><ul>{links}</ul></div>{parts.format(first, second)}</body>")
    assert [w for w in text.split() if w[-1].isdigit()] == [f"{w}{i}" for w in "ab" for i in range(5)]


def test_text_in_line_beside_the_densest_container_is_kept():
    text = "<p>" + "sentence of the article. " * 40 + "</p>"
    page = f"<body>Opening {'words ' * 400}<b>in bold</b> end.<div>{text * 2}</div></body>"
    assert main_text(page).startswith("Opening words") and "in bold end." in main_text(page)


@pytest.mark.parametrize("page", [
    "<div class='layout has-sidebar'>{}</div>",
    "<div id=page class='no-sidebar'>{}</div>",
    "<div class='content with-comments'>{}</div>",
    "<div class='form widget'>{}</div>",
    "<form action=/>{}</form>",
    "<form><div class=sidebar>side</div><article>{}</article></form>",
    "<div><section id=related-work>{}</section></div>",
    "<article><h1 class='entry-header'>Title</h1>{}<math><mi>x</mi></math></article>",
])
def test_a_name_alone_does_not_cut_the_article_off(page):
    text = "<p>" + "sentence of the article. " * 20 + "</p>"
    found = main_text(f"<body>{page.format(text * 3)}<div class='ad'><p>buy this now</p></div></body>")
    assert found.count("sentence") == 60 and "buy" not in found and "side" not in found.split()
    if "<math>" in page:
        assert found.startswith("Title ") and found.endswith(" x")


def test_every_page_has_a_row(spark):
    rows = [(1, "u", "<p>x</p>"), (1, "u", "<p>x</p>"), (None, None, None), (2, "v", "<nav>n</nav>"), (3, "w", "<p>" + "y " * 10**5)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit(1))
    found = extract_main_text(pages).collect()
    assert sorted((str(r["page_id"]), r["text"][:3], r["n_chars"]) for r in found) == [
        ("1", "x", 1), ("1", "x", 1), ("2", "", 0), ("3", "y y", 199999), ("None", "", 0)
    ]
    assert extract_main_text(pages.limit(0)).count() == 0


LEAD = "The river rises in the hills and runs past the mill for many miles before it meets the sea. " * 4
NOTE = "A short last word on the tides."


def words(*parts: str) -> str:
    return " ".join(" ".join(parts).split())


@pytest.mark.parametrize(
    "page, text",
    [
        (
            f"<main><section><h2>Mills</h2><p>{LEAD}</p><p>{LEAD}</p></section>"
            f"<section><h2>Tides</h2><p>{NOTE}</p></section></main>",
            words("Mills", LEAD, LEAD, "Tides", NOTE),
        ),
        (
            f"<div><h1>Mills</h1><div class=meta><p>{NOTE}</p></div>"
            f"<div class=body><p>{LEAD}</p><p>{LEAD}</p></div></div>",
            words("Mills", NOTE, LEAD, LEAD),
        ),
        (
            f"<article><h1><a href=/m>Mills</a></h1><p>{LEAD}</p><ul><li><a href=/a>Upper mill</a>"
            f"<li><a href=/b>Lower mill</a></ul><p><a href=/c>All mills of the river</a></p></article>",
            words("Mills", LEAD, "Upper mill Lower mill All mills of the river"),
        ),
        (
            f"<article><p>{LEAD}</p></article><article><p>{NOTE}</p></article>",
            words(LEAD, NOTE),
        ),
        (
            f"<article><p>{LEAD}</p><section class=comments><article><p>{LEAD} I like it.</p></article>"
            f"<article><p>{NOTE}</p></article></section></article>",
            words(LEAD),
        ),
        (
            f"<div class=story><p>{NOTE}</p><p>{LEAD}</p></div>"
            f"<section id=comments><article><p>I like it. {NOTE}</p></article></section>",
            words(NOTE, LEAD),
        ),
        (
            f"<article><p>{LEAD}</p><div class=comment-list><p>I like it.</p></div><div class=adSlot>Buy"
            f"</div><div class='x cookie-notice'><p>We use them.</p></div><p>{NOTE}</p></article>",
            words(LEAD, NOTE),
        ),
        (f"<body><header><p>{LEAD}</p></header><article><p>{NOTE}</p></article>", words(NOTE)),
        (f"<article><header><h1>Mills</h1><p>{NOTE}</p></header><p>{LEAD}</p></article>", words("Mills", NOTE, LEAD)),
        (
            f"<article><section id=ad-hoc><p>{NOTE}</p></section><section class=related-work><p>{LEAD}</p>"
            "</section></article>",
            words(NOTE, LEAD),
        ),
    ],
)
def test_nothing_of_an_article_is_lost_and_nothing_else_stays(page, text):
    assert main_text(page) == text


@pytest.mark.parametrize(
    "page",
    [
        "<font>" * 30_000 + "<p>x " * 30_000,
        "<" + "a" * 200_000 + '"',
        "<b><div>" + "<font>" * 30_000 + "</b></i>" * 30_000,
        "<svg>" + "<g>" * 30_000 + "</x>" * 30_000,
        '<a ">"' * 30_000 + "'",
        "<table>" + "<tr><td>x" * 30_000,
        "<dl><dt>" * 30_000 + "<li>" * 30_000,
    ],
)
def test_time_grows_with_the_length_of_a_page(page):
    """A quadratic walk over these takes minutes."""
    started = time.perf_counter()
    main_text(page)
    assert time.perf_counter() - started < 10
