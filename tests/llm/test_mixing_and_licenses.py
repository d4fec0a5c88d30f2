"""Mixing and license scans against brute force."""

import math
import random
import re

import pytest
from corpus import docs_of  # noqa: F401
from pyspark.sql import functions as F

from tidemill.llm.license_scan import BLOCK, NOTICES, PHRASES, edits, license_spans, scan_licenses
from tidemill.llm.mixing import (
    exponent_for_entropy,
    exponent_for_repeats,
    mix,
    mixed_documents,
    mixture,
    source_shares,
)

SIZES = {"big": 600, "mid": 90, "small": 30, None: 45}


@pytest.fixture(scope="module")
def corpus(spark):
    rows, i = [], 0
    for source, n in SIZES.items():
        for _ in range(n):
            rows.append((i, " w" * (1 + i % 7), source, i * 2))
            i += 1
    return spark.createDataFrame(rows, "doc_id long, text string, source string, readings long")


def tokens_of(corpus):
    return {
        s: sum(1 + r["doc_id"] % 7 for r in corpus.where(F.col("source").eqNullSafe(s)).collect()) for s in SIZES
    }


def shares_of(corpus):
    return source_shares(corpus.select("source", (F.col("doc_id") % 7 + 1).alias("tokens")))


def test_the_exponent_meets_its_target(corpus):
    shares, tokens = shares_of(corpus), tokens_of(corpus)
    all_tokens = sum(tokens.values())
    part = {s: n / all_tokens for s, n in tokens.items()}
    t = exponent_for_repeats(shares, 3.0)
    assert (max(part.values()) / min(part.values())) ** (1 - t) == pytest.approx(3.0)
    for target in (0.9, 1.2, 1.3):
        t = exponent_for_entropy(shares, target)
        z = sum(p**t for p in part.values())
        assert -sum(p**t / z * math.log(p**t / z) for p in part.values()) == pytest.approx(target, abs=1e-6)
    assert exponent_for_entropy(shares, 5.0) == 0.0 and exponent_for_entropy(shares, 0.0) == 1.0
    rows = {r["source"]: r for r in mixture(shares, 0.5).collect()}
    z = sum(p**0.5 for p in part.values())
    for s, p in part.items():
        assert rows[s]["weight"] == pytest.approx(p**0.5 / z)
        assert rows[s]["readings"] == pytest.approx((max(part.values()) / p) ** 0.5, abs=1e-6)


@pytest.mark.parametrize("block_rows", [8, 4096])
def test_every_source_fills_its_budget(corpus, block_rows):
    tokens = tokens_of(corpus)
    rows = mix(corpus, max_repeats=2.5, block_rows=block_rows).collect()
    wanted = {r["source"]: r["readings"] for r in mixture(shares_of(corpus), exponent_for_repeats(shares_of(corpus), 2.5)).collect()}
    for source, n in SIZES.items():
        own = [r for r in rows if r["source"] == source]
        read = {}
        for r in own:
            read.setdefault(r["doc_id"], []).append(r["pass"])
        assert len(read) == n  # nothing is left out
        whole = math.floor(wanted[source])
        assert all(sorted(p) == list(range(len(p))) and len(p) in (whole, whole + 1) for p in read.values())
        spent = sum(r["tokens"] for r in own)
        assert 0 <= spent - wanted[source] * tokens[source] < 7.001
        for p in {r["pass"] for r in own}:
            places = [(r["block"], r["place"]) for r in own if r["pass"] == p]
            assert len(set(places)) == len(places)
    orders = [[r["doc_id"] for r in sorted(rows, key=lambda r: (r["block"], r["place"])) if (r["source"], r["pass"]) == ("small", p)] for p in (0, 1)]
    assert orders[0] != orders[1] and set(orders[0]) == set(orders[1])


def test_documents_are_repeated_as_often_as_read(corpus):
    often = {r["doc_id"]: r["count"] for r in mix(corpus).groupBy("doc_id").count().collect()}
    mixed = mixed_documents(corpus)
    assert mixed.columns == corpus.columns
    assert {r["doc_id"]: r["count"] for r in mixed.groupBy("doc_id").count().collect()} == often
    assert mixed.where("readings != 2 * doc_id").count() == 0


def test_mixing_odd_tables(docs_of):
    assert mixed_documents(docs_of([])).count() == 0
    assert sorted(str(r["doc_id"]) for r in mixed_documents(docs_of([(0, None), (3, ""), (None, " ")])).collect()) == ["0", "3", "None"]
    same = [(1, "a b"), (1, "a b"), (2, "c d e f g h")]
    rows = mix(docs_of(same)).where("pass = 0").collect()
    assert sorted((r["doc_id"], r["copies"], r["tokens"]) for r in rows) == [(1, 2, 4), (2, 1, 6)]


WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LICENSED = [
    "Released under the MIT License.", "MIT-license mit LICENSE", "general public\nlicense", "GENERAL public x license",
    "", None, "mit", "ümit license", "Licensed under CC BY-NC 4.0.", "mit license " * 300,
    "This work is licensed under the GNU General Public License, version 3.", "x" * 9000, "apache license general public license",
    "Permission is hereby kindly granted, free of charge, to any person obtaining a copy of this software and the associated documentation files",
    "you may not use it", "MIT license", "MİT license",
]


def brute(text):
    words = re.findall(WORDS, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    starts, labels = [], set()
    for phrase, label in PHRASES.items():
        q = phrase.split(" ")
        for k in range(len(words) - len(q) + 1):
            if words[k : k + len(q)] == q:
                starts.append(k)
                labels.add(label)
    return len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))


def test_phrases_are_those_of_brute_force(docs_of):
    pairs = list(enumerate(LICENSED))
    rows = {r["doc_id"]: r for r in scan_licenses(docs_of(pairs).repartition(3)).collect()}
    assert len(rows) == len(pairs)
    for i, text in pairs:
        r = rows[i]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == brute(text)
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(","))
        assert 0.0 <= r["score"] <= 1.0
    assert rows[8]["labels"] == "cc-by-nc" and rows[4]["score"] == 0.0 and rows[14]["labels"] == ""


def test_a_notice_is_found_whole_and_with_words_put_in(docs_of):
    notice = next(iter(NOTICES))
    rows = scan_licenses(docs_of([(0, "x y " + notice + " z"), (1, LICENSED[13]), (2, notice[:40])]))
    rows = {r["doc_id"]: r for r in rows.collect()}
    assert (rows[0]["labels"], rows[0]["score"]) == ("mit", 1.0)
    assert rows[1]["labels"] == "mit" and rows[1]["score"] == 1 - 2 / len(notice.split(" "))
    assert 0.0 < rows[2]["score"] < 0.7 and rows[2]["labels"] == ""
    spans = license_spans(docs_of([(0, LICENSED[13])])).where("template is not null").collect()
    best = max(spans, key=lambda r: r["votes"])
    assert best["label"] == "mit" and best["last"] - best["first"] >= 10  # over several diagonals


def test_repeated_rows_and_empty_tables_are_scanned(docs_of):
    assert scan_licenses(docs_of([])).count() == 0
    rows = scan_licenses(docs_of([(1, "mit license"), (1, "mit license"), (None, "mit license")])).collect()
    assert [r["n_base"] for r in rows] == [1, 1, 1]


def fewest_edits(words, window):
    """The plain table of edit distances, free at both ends of the window."""
    column = list(range(len(words) + 1))
    best = column[-1]
    for seen in window:
        new = [0]
        for j, word in enumerate(words):
            new.append(min(column[j + 1] + 1, new[j] + 1, column[j] + (word != seen)))
        column = new
        best = min(best, column[-1])
    return best


def test_alignments_are_those_of_brute_force(spark):
    draw = random.Random(5)
    rows = []
    for m in [1, 2, 4, 6, 20, 47, 48] * 20:
        letters = "abcdefgh"[: draw.choice([2, 4, 8])]
        rows.append(([draw.choice(letters) for _ in range(m)], [draw.choice(letters) for _ in range(draw.randint(0, 128))]))
    table = spark.createDataFrame(rows, "words array<string>, around array<string>")
    for r in table.select("*", edits(F.col("words"), F.col("around")).alias("edits")).collect():
        assert r["edits"] == fewest_edits(r["words"], r["around"])


def test_a_notice_of_twenty_words_with_four_put_in_has_its_label(docs_of):
    notice = next(iter(NOTICES)).split(" ")
    assert len(notice) == 20
    for at in (17, 12, 8, 3):
        notice.insert(at, "really")
    row = scan_licenses(docs_of([(0, " ".join(notice))])).first()
    assert (row["labels"], row["score"]) == ("mit", 0.8)


def test_spans_are_found_wherever_blocks_end(docs_of):
    notice, phrase = next(iter(NOTICES)), "general public license"
    pairs = [(n, "x " * n + text) for n in range(BLOCK - 30, BLOCK + 3, 3) for text in (notice + " y", phrase + " " + phrase)]
    for r in scan_licenses(docs_of(pairs).repartition(4)).collect():
        assert r["score"] == 1.0
        if r["n_base"]:
            assert (r["n_base"], r["first_word"], r["last_word"], r["labels"]) == (2, r["doc_id"], r["doc_id"] + 3, "gpl")
            assert r["n_words"] == r["doc_id"] + 6
        else:
            assert (r["labels"], r["n_words"]) == ("mit", r["doc_id"] + len(notice.split(" ")) + 1)
    many = scan_licenses(docs_of([(0, (notice + " z ") * 1500)])).first()
    assert (many["labels"], many["n_words"]) == ("mit", 1500 * (len(notice.split(" ")) + 1))


def test_notices_are_a_table(spark, docs_of):
    long = " ".join(f"w{i}" for i in range(130))
    rows = [(long, "long"), ("too short it", "never"), (None, "x"), ("a Notice, without label here", None), (long, "long"), (long, "twin")]
    notices = spark.createDataFrame(rows, "text string, label string")
    docs = docs_of([(0, "so: " + long.upper()), (1, long[200:400]), (2, "too short it is"), (3, "a notice without label here"), (4, "released under the mit license")])
    got = {r["doc_id"]: (r["labels"], r["score"]) for r in scan_licenses(docs, notices).collect()}
    assert got[0] == ("long,twin", 1.0) and got[3] == ("", 1.0) and got[2] == ("", 0.0)
    assert got[4] == ("mit", 1.0)  # the phrase, for the notices are others
    assert scan_licenses(docs, notices.limit(0)).where("labels <> ''").count() == 1
