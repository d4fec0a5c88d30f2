import random
import re
from collections import Counter

import numpy as np
import pytest
from conftest import DATA
from pyspark.sql import functions as F

from tidemill.llm.collocations import Partitioning, leaf_totals, mine_collocations, subtree_nodes

DOCUMENTS = "doc_id long, text string, lang string"


def by_brute_force(rows, max_words=3, min_count=10, top=2000, percent=50):
    counts, n = {}, Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower):
            words = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(words)
            f = counts.setdefault(lang, Counter())
            for k in range(1, max_words + 1):
                f.update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    result = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= min_count}
        found = []
        for p, a in candidates.items():
            cuts = [(1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            inside = any(
                len(q) > len(p)
                and 100 * b >= percent * a
                and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
                for q, b in candidates.items()
            )
            if not inside:
                found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(found)[:top], 1):
            result.append((lang, rank, phrase.decode(), -a, l, r, n[lang], -score))
    return sorted(result)


def mined(spark, rows, **options):
    docs = spark.createDataFrame([(i, t, l) for i, (t, l) in enumerate(rows)], DOCUMENTS)
    docs = docs.withColumns({c: F.lit("x") for c in ("phrase", "a", "n", "f", "rank", "salt")})
    return sorted(tuple(r) for r in mine_collocations(docs.repartition(3), **options).collect())


def prose(seed, count, words="The the of a b c d Éa éa x y <S> e"):
    draw = random.Random(seed)
    signs = ["", "", "", "", ",", ".", "\n", " \t ", "!", "\r", "\x0b", ";"]
    return "".join(draw.choice(words.split(" ")) + draw.choice(signs) + " " for _ in range(count))


ROWS = [
    *((prose(i, 120), ["en", "en", "de", None][i % 4]) for i in range(40)),
    (None, "en"),
    ("", "en"),
    (" \t .,;", None),
    ("same words here. " * 30, "en"),
    ("same words here. " * 30, "en"),
    ("hot phrase " * 3000, "xx"),  # one passage, over and over
]


@pytest.mark.parametrize("options", [{}, {"group_suffixes": 50}, {"group_suffixes": 500, "buckets": 4}])
def test_rows_match_brute_force_however_the_tree_is_divided(spark, options):
    assert mined(spark, ROWS, **options) == by_brute_force(ROWS)


@pytest.mark.parametrize("options", [{"max_words": 4}, {"max_words": 2}, {"top": 3}, {"min_count": 25}])
def test_other_depths_and_limits(spark, options):
    assert mined(spark, ROWS[:20], **options) == by_brute_force(ROWS[:20], **options)


def test_a_small_task_memory_gives_the_same(spark, monkeypatch):
    import tidemill.llm.collocations as module

    monkeypatch.setattr(module, "BYTES_AT_ONCE", 300)
    monkeypatch.setattr(module, "FLUSH_SUFFIXES", 100)
    assert mined(spark, ROWS[:12]) == by_brute_force(ROWS[:12])


def test_large_products_are_exact(spark):
    """a * a * 1000000 passes 64 bits for a count of four millions."""
    from tidemill.llm.collocations import _exact_score

    pairs = [(4_000_000, 4_000_001, 4_000_003), (10**12 + 7, 10**12 + 9, 10**12 + 39), (10, 10, 10)]
    df = spark.createDataFrame(pairs, "a long, l long, r long")
    got = [r[0] for r in df.select(_exact_score(F.col("a"), F.col("l"), F.col("r"))).collect()]
    assert got == [10**6 * a * a // (l * r) for a, l, r in pairs]


def test_leaves_and_nodes():
    draw = np.random.default_rng(4)
    suffixes = draw.integers(0, 5, (3, 400))
    leaves, totals = leaf_totals(suffixes)
    expected = Counter(map(tuple, suffixes.T.tolist()))
    assert dict(zip(map(tuple, leaves.T.tolist()), totals.tolist(), strict=True)) == expected
    again, sums = leaf_totals(np.concatenate((leaves, leaves), axis=1), np.concatenate((totals, totals)))
    assert (again == leaves).all() and (sums == 2 * totals).all()
    for depth, nodes, found in subtree_nodes(leaves, totals):
        below = Counter()
        for leaf, k in expected.items():
            if leaf[depth - 1]:
                below[leaf[:depth]] += k
        assert dict(zip(map(tuple, nodes.T.tolist()), found.tolist(), strict=True)) == below


def test_words_of_any_number_are_packed():
    """Numbers too large to stand in one 64-bit rank take the longer way to the same."""
    draw = np.random.default_rng(6)
    small = draw.integers(0, 6, (3, 300))
    large = small * (1 << 28)
    for counts in (None, draw.integers(1, 9, 300)):
        leaves, totals = leaf_totals(small, counts)
        far, sums = leaf_totals(large, counts)
        assert (far == leaves * (1 << 28)).all() and (sums == totals).all()


def test_groups_keep_to_the_budget():
    sizes = np.array([5, 0, 90, 3, 3, 3, 250, 1] * 10)
    plan = Partitioning(sizes, 100)
    load = Counter()
    for bucket, size in enumerate(sizes.tolist()):
        for part in range(plan.parts[bucket]):
            load[int(plan.start[bucket]) + part] += size / plan.parts[bucket]
    assert max(load.values()) <= 100 and set(load) == set(range(plan.groups))
    assert Partitioning(np.zeros(4, int), 10).groups == 1


def test_empty_table_and_tables_without_words(spark):
    assert mined(spark, [(None, None), ("", "en"), (". .", "en")]) == []
    docs = spark.createDataFrame([], DOCUMENTS)
    assert mine_collocations(docs).count() == 0


def test_whole_table_matches_brute_force_in_one_language(spark):
    docs = spark.read.parquet(f"{DATA}/sf0.001/documents.parquet").select("text", "lang")
    rows = [tuple(r) for r in docs.collect()]
    assert sorted(tuple(r) for r in mine_collocations(docs, min_count=5).collect()) == by_brute_force(rows, min_count=5)
