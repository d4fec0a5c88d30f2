"""Exact deduplication and fingerprints against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from corpus import docs_of  # noqa: F401
from pyspark.sql import functions as F

from tidemill.llm.exact_dedup import drop_exact_copies, exact_groups, frequent_digests
from tidemill.llm.fingerprints import (
    DENSE,
    LANES,
    SPREAD,
    _bucket,
    as_lanes,
    combine,
    corpus_fingerprint,
    document_fingerprints,
    edit_fingerprints,
    likeness,
)

TEXTS = ["a b", "a  b", "a\tb", "", None, " ", "A b", "a b\n", "x" * 5000, "a b", "é ñ", "\x0b\x0c", "a b"]


def digest(text):
    return hashlib.sha256(re.sub(r"[\x20\x09-\x0d]+", " ", text or "").encode()).hexdigest()


@pytest.mark.parametrize("counters", [2, 1024])
def test_groups_are_those_of_brute_force(docs_of, counters):
    pairs = list(enumerate(TEXTS * 3))
    random.Random(1).shuffle(pairs)
    found = {r["doc_id"]: r for r in exact_groups(docs_of(pairs).repartition(4), counters).collect()}
    assert len(found) == len(pairs)
    groups = {}
    for i, text in pairs:
        groups.setdefault(digest(text), []).append(i)
    for i, text in pairs:
        mates, row = groups[digest(text)], found[i]
        assert (row["keep_id"], row["group_size"]) == (min(mates), len(mates))
        assert row["kept"] == (i == min(mates)) and row["text_sha256"] == digest(text)


def test_a_frequent_digest_is_in_the_summary(spark):
    rows = [(f"d{i}",) for i in range(500)] + [("hot",)] * 300
    random.Random(2).shuffle(rows)
    digests = spark.createDataFrame(rows, "text_sha256 string").repartition(7)
    found = [r["text_sha256"] for r in frequent_digests(digests, 4).collect()]
    assert "hot" in found and len(found) <= 4 * 7


def test_kept_documents_have_all_their_columns(spark, docs_of):
    docs = docs_of([(3, "a"), (1, "a"), (None, "a"), (2, "b"), (2, "b")])
    docs = docs.withColumn("text_sha256", F.lit("mine")).withColumn("place", F.lit(7))
    kept = drop_exact_copies(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"], r["text_sha256"], r["place"]) for r in kept.collect()) == [
        (1, "mine", 7),
        (2, "mine", 7),
    ]
    assert drop_exact_copies(docs.limit(0)).count() == 0 and exact_groups(docs.limit(0)).count() == 0


def xx(*parts):
    """Spark's chained 64-bit hash: the hash of one value is the seed of the next."""
    seed = 42
    for p in parts:
        if p is None:
            continue
        data = p.encode() if isinstance(p, str) else np.int32(p).tobytes()
        seed = xxhash.xxh64_intdigest(data, seed) if isinstance(p, str) else _hash_int(p, seed)
    return seed


def _hash_int(value, seed):
    mask = (1 << 64) - 1
    p1, p2, p3 = 0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9
    h = (seed + 0x27D4EB2F165667C5 + 4) & mask
    h ^= (value & 0xFFFFFFFF) * p1 & mask
    h = (((h << 23) | (h >> 41)) & mask) * p2 + p3 & mask
    h = (h ^ (h >> 33)) * p2 & mask
    h = (h ^ (h >> 29)) * p3 & mask
    return h ^ (h >> 32)


def brute_lanes(text):
    lanes = [0] * LANES
    for paragraph in (text or "").split("\n"):
        for k in range(DENSE):
            h = xx(k, paragraph)
            lanes[2 * k] += h >> 32
            lanes[2 * k + 1] += h & 0xFFFFFFFF
        words = paragraph.split(" ")
        for a, b in zip(words, [*words[1:], None], strict=True):
            h = xx(a, b)
            lanes[2 * DENSE] += 1
            for bit in range(SPREAD):
                lanes[2 * DENSE + 1 + 2 * bit] += h >> (bit + 32) & 1
                lanes[2 * DENSE + 2 + 2 * bit] += h >> bit & 1
    return [x % 2**32 for x in lanes]


def as_hex(lanes):
    return "".join(f"{x:08X}" for x in lanes)


PAGES = ["one two three\nfour five", "four five\none two three", "", None, "x", "a\n\nb  c", "ä ö ü " * 40, "one two three\nfour five"]


def test_fingerprints_are_those_of_brute_force(docs_of):
    docs = docs_of(list(enumerate(PAGES)))
    found = {r["doc_id"]: r["fingerprint"] for r in document_fingerprints(docs).collect()}
    assert found == {i: as_hex(brute_lanes(t)) for i, t in enumerate(PAGES)}
    assert found[0] == found[1] == found[7] and found[2] == found[3] and len(set(found.values())) == 5


@pytest.mark.parametrize("texts", [PAGES, PAGES[:1], PAGES[:2], []])
def test_edits_and_successors(docs_of, texts):
    ids = [5 * i - 3 for i in range(len(texts))]
    docs = docs_of(list(zip(ids, texts, strict=True))).repartition(3)
    found = {r["doc_id"]: r for r in edit_fingerprints(docs).collect()}
    assert set(found) == set(ids)
    for k, i in enumerate(ids):
        text, after = texts[k] or "", texts[(k + 1) % len(texts)] or ""
        quarter = len(text) // 4
        edited = text[: len(text) - quarter] + after[:quarter]
        row = found[i]
        assert row["n_chars"] == len(text)
        assert row["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert row["fingerprint"] == as_hex(brute_lanes(text))
        assert row["edited_fingerprint"] == as_hex(brute_lanes(edited))
        a, b, c = brute_lanes(text), brute_lanes(edited), brute_lanes(after)
        assert row["near_edited"] == pytest.approx(cosine(a, b), abs=1e-9)
        assert row["near_next"] == pytest.approx(cosine(a, c), abs=1e-9)


def cosine(a, b):
    if a == b:
        return 1.0
    x, y = ([2 * c - v[2 * DENSE] for c in v[2 * DENSE + 1 :]] for v in (a, b))
    size = (sum(p * p for p in x) * sum(q * q for q in y)) ** 0.5
    return min(1.0, max(0.0, sum(p * q for p, q in zip(x, y, strict=True)) / size)) if size else 0.0


def test_rows_of_the_same_or_no_id(docs_of):
    docs = docs_of([(None, "n"), (1, "b c d e"), (1, "b c d e"), (1, "a a a a"), (2, "z z z z")])
    rows = edit_fingerprints(docs).collect()
    assert len(rows) == 5 and sorted(str(r["doc_id"]) for r in rows) == ["1", "1", "1", "2", "None"]


def test_paragraphs_are_inserted_and_deleted(spark, docs_of):
    docs = docs_of([(0, "p q\nr"), (1, "s t")])
    prints = {r["doc_id"]: r["fingerprint"] for r in document_fingerprints(docs).collect()}
    both = spark.createDataFrame([(prints[0], prints[1])], "a string, b string").select(
        as_lanes(F.col("a")).alias("a"), as_lanes(F.col("b")).alias("b")
    )
    joined = both.select("*", combine(F.col("a"), F.col("b")).alias("ab"))
    row = joined.select("*", combine(F.col("ab"), F.col("b"), -1).alias("back"), likeness(F.col("a"), F.col("a"))).first()
    assert row["ab"] == brute_lanes("p q\nr\ns t") and row["back"] == row["a"] and row[-1] == 1.0
    corpus = corpus_fingerprint(document_fingerprints(docs)).first()["fingerprint"]
    assert corpus == as_hex(brute_lanes("p q\nr\ns t"))


def test_buckets_are_found_in_two_steps(spark):
    bounds = [-5, 0, 1, 7, 7**5, 10**12]
    ids = [-(10**15), -5, -4, 0, 1, 2, 7, 8, 10**12, 10**15]
    rows = spark.createDataFrame([(i,) for i in ids], "i long").select("i", _bucket(F.col("i"), bounds).alias("b")).collect()
    assert {r["i"]: r["b"] for r in rows} == {i: sum(b <= i for b in bounds) for i in ids}
