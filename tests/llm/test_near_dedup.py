"""Near-deduplication against brute force over all pairs."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from corpus import docs_of  # noqa: F401
from pyspark.sql import functions as F

from tidemill.llm import near_dedup
from tidemill.llm.components import connect
from tidemill.llm.near_dedup import (
    UNFILLED,
    band_keys,
    drop_near_copies,
    near_groups,
    sketches,
)


def shingles(text, width):
    words = re.findall(r"[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < width:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1))


def brute(pairs, width, similarity):
    """n_shingles and component of every row, by position."""
    sets = [shingles(t, width) for _, t in pairs]
    root = list(range(len(pairs)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    having = defaultdict(list)
    for i, s in enumerate(sets):
        both = Counter(j for x in s for j in having[x])
        for j, n in both.items():
            if 100 * n >= similarity * (len(s) + len(sets[j]) - n):
                root[max(top(i), top(j))] = min(top(i), top(j))
        for x in s:
            having[x].append(i)
    least = {}
    for i, (doc_id, _) in enumerate(pairs):
        least.setdefault(top(i), []).append(doc_id)
    return [
        (doc_id, len(sets[i]), min((x for x in least[top(i)] if x is not None), default=None))
        for i, (doc_id, _) in enumerate(pairs)
    ]


def near_copies(rng, base, n, most):
    for _ in range(n):
        words = list(base)
        for _ in range(rng.randint(0, most)):
            words[rng.randrange(len(words))] = f"z{rng.randrange(10**6)}"
        yield " ".join(words)


@pytest.mark.parametrize("width,similarity,pivots", [(3, 85, (1, 4)), (5, 80, (1,)), (3, 85, ())])
def test_components_are_those_of_brute_force(docs_of, monkeypatch, width, similarity, pivots):
    """Among them a group of which many are too far apart to link, compared in blocks."""
    monkeypatch.setattr(near_dedup, "PIVOTS", pivots)
    monkeypatch.setattr(near_dedup, "BLOCK", 16)
    rng = random.Random(5)
    base = [f"w{rng.randrange(500)}" for _ in range(150)]
    texts = [" ".join(base), *near_copies(rng, base, 90, 6), " ".join(base)]
    texts += [" ".join(f"w{rng.randrange(500)}" for _ in range(rng.randint(1, 60))) for _ in range(40)]
    chain = base[:60]
    for _ in range(12):  # each links with the next, the ends do not
        texts.append(" ".join(chain))
        chain = [*chain[1:], f"c{rng.randrange(10**6)}"]
    texts += ["", None, " \t", "A b", "a  B", "one", "ONE", "one two three"]
    pairs = [(i * 37 % 1009, t) for i, t in enumerate(texts)]
    pairs += [(None, texts[0]), (None, "only here"), pairs[3]]
    rows = near_groups(docs_of(pairs).repartition(5), width=width, similarity=similarity).collect()
    found = [(r["doc_id"], r["n_shingles"], r["component_id"]) for r in rows]
    assert Counter(found) == Counter(brute(pairs, width, similarity))
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in rows)


def test_one_document_of_a_group_stays(docs_of):
    text = "the quick brown fox jumps over the lazy dog and then some more words follow it here"
    docs = docs_of([(5, text), (2, text + " x"), (9, "other words entirely"), (7, ""), (8, None)])
    docs = docs.withColumn("kept_id", F.lit(1)).withColumn("bands", F.lit("b"))
    kept = drop_near_copies(docs, similarity=80)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [2, 7, 8, 9]
    assert drop_near_copies(docs.limit(0)).count() == 0


def test_one_row_of_a_group_stays_whatever_the_ids(docs_of):
    text = "the quick brown fox jumps over the lazy dog and then some more words follow it here"
    other = " ".join(f"w{i}" for i in range(20))
    pairs = [(None, text), (None, text + " x"), (None, "no id but another text"), (None, ""), (None, None)]
    pairs += [(3, "one " + other), (3, "one " + other + " y"), (3, "apart from it all")]
    pairs += [(4, "z " + text[::-1]), (None, "z " + text[::-1] + " q")]
    docs = docs_of(pairs).repartition(3).withColumn("row", F.lit(1))
    kept = drop_near_copies(docs, similarity=80)
    assert kept.columns == docs.columns
    found = Counter((r["doc_id"], (r["text"] or "")[:4]) for r in kept.collect())
    assert found == Counter({(None, "the "): 1, (None, "no i"): 1, (None, ""): 2, (3, "one "): 1, (3, "apar"): 1, (4, "z er"): 1})


def test_sketches_fill_and_estimate():
    rng = np.random.default_rng(0)
    tiny = [rng.integers(0, 2**63, n, np.uint64) for n in (1, 2, 3, 50)]
    assert (sketches(tiny) != UNFILLED).all()
    for share in (0.3, 0.6, 0.85):
        estimates = []
        for _ in range(40):
            x = rng.integers(0, 2**63, 600, np.uint64)
            same = round(600 * 2 * share / (1 + share))
            y = np.concatenate([x[:same], rng.integers(0, 2**63, 600 - same, np.uint64)])
            a, b = sketches([x, y])
            estimates.append((a == b).mean())
        assert abs(np.mean(estimates) - share) < 0.03
    assert (sketches(tiny[:2]) == np.concatenate([sketches([t]) for t in tiny[:2]])).all()
    assert band_keys(sketches(tiny)).shape == (4, 32)


@pytest.mark.parametrize("n", [1, 2, 40])
def test_components_of_chains_and_stars(spark, n):
    rng = random.Random(n)
    names = rng.sample(range(10**6), 3 * n)
    chain, star = names[:n], names[n : 2 * n]
    edges = list(zip(chain, chain[1:], strict=False)) + [(star[0], x) for x in star] + [(x, x) for x in names[2 * n :]]
    rng.shuffle(edges)
    found = {r["node"]: r["root"] for r in connect(spark.createDataFrame(edges, "a long, b long")).collect()}
    expected = {x: min(star) for x in star} | {x: x for x in names[2 * n :]}
    if n > 1:
        expected |= {x: min(chain) for x in chain}
    assert found == expected
