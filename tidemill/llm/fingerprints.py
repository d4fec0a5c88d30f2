"""Homomorphic multiset fingerprints of documents.

A paragraph (what stands between line feeds) is hashed to a wide vector of 81 lanes:
sixteen uniform 32-bit lanes hashed from the whole paragraph, the number of its word
pairs, and for each of 64 bits how many of its word pairs have that bit set in their
hash. A document's fingerprint is the sum of these vectors, each lane modulo 2**32, so
it does not depend on the order of paragraphs, and ``combine`` inserts or deletes
paragraphs without reading the rest. Equal multisets of paragraphs have equal
fingerprints; the uniform lanes make others differ.

The bit counts ``c`` of ``n`` pairs are ``2c - n`` when each bit is read as plus or minus
one: a random projection of the multiset of word pairs. The cosine of two such vectors
estimates that of the multisets and is their ``likeness``.

Defined cases: a null text is empty; the empty text has one empty paragraph; an
empty table gives no rows; repeated rows are fingerprinted each on its own; null ids come
first; rows of the same id are put in order by their text. A paragraph of one word has
that word as its only pair.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemill.llm.common import whole_text
from tidemill.session import shuffle_partitions

DENSE = 8  # longs of two uniform lanes
SPREAD = 32  # longs of two bit counts
LANES = 2 * DENSE + 1 + 2 * SPREAD
DIGITS = 8
LOW = (1 << 32) - 1
PAIR_OF_BITS = (1 << 32) + 1
BUCKETS_PER_PARTITION = 4


def _sum(values: Column, of) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda total, x: total + of(x))


def dense_lanes(paragraphs: Column) -> list[Column]:
    """Two uniform lanes a long, summed over the paragraphs modulo 2**32."""

    def lane(k: int) -> Column:
        hashes = F.transform(paragraphs, lambda p: F.xxhash64(F.lit(k), p))
        high = _sum(hashes, lambda h: F.shiftrightunsigned(h, 32)).bitwiseAND(F.lit(LOW))
        low = _sum(hashes, lambda h: h.bitwiseAND(F.lit(LOW))).bitwiseAND(F.lit(LOW))
        return F.shiftleft(high, 32).bitwiseOR(low)

    return [lane(k) for k in range(DENSE)]


def word_pairs(paragraphs: Column) -> Column:
    """Hashes of neighbouring words, the last word of each paragraph by itself."""

    def pairs(words: Column) -> Column:
        behind = F.slice(words, F.lit(2), F.size(words))
        return F.zip_with(words, behind, lambda a, b: F.xxhash64(a, b))

    words = F.transform(paragraphs, lambda p: F.split(p, " "))
    return F.flatten(F.transform(words, pairs))


def _unpacked(packed: Column) -> list[Column]:
    return [F.shiftrightunsigned(packed, 32), packed.bitwiseAND(F.lit(LOW))]


def fingerprint_lanes(rows: DataFrame, keys: list[str], text: str) -> DataFrame:
    """``keys`` and their text's lanes, an array of 81 longs.

    The word pairs of a row are added up in the task that reads it; only where the
    rows are not laid out by some of the keys are the sums then shuffled. No sum
    can overflow: a text has fewer than 2**30 pairs.
    """
    paragraphs = F.col("paragraphs")
    dense = [f"dense{k}" for k in range(DENSE)]
    lanes = (
        rows.select(*keys, F.split(F.col(text), "\n", -1).alias("paragraphs"))
        .select(
            *keys,
            "paragraphs",
            *(lane.alias(name) for lane, name in zip(dense_lanes(paragraphs), dense, strict=True)),
        )
        # in a step of its own, or the lanes would be computed anew for every pair
        .select(*keys, *dense, F.explode(word_pairs(paragraphs)).alias("pair"))
    )
    counts = [
        F.sum(F.shiftrightunsigned("pair", bit).bitwiseAND(F.lit(PAIR_OF_BITS))).alias(f"bits{bit}")
        for bit in range(SPREAD)
    ]
    summed = lanes.groupBy(*keys, *dense).agg(F.count(F.lit(1)).alias("pairs"), *counts)
    return summed.select(
        *keys,
        F.array(
            *(x for name in dense for x in _unpacked(F.col(name))),
            F.col("pairs"),
            *(x for bit in range(SPREAD) for x in _unpacked(F.col(f"bits{bit}"))),
        ).alias("lanes"),
    )


def as_text(lanes: Column) -> Column:
    """The fingerprint as hexadecimal digits, eight a lane."""
    return F.array_join(F.transform(lanes, lambda x: F.lpad(F.hex(x), DIGITS, "0")), "")


def as_lanes(fingerprint: Column) -> Column:
    return F.transform(
        F.sequence(F.lit(0), F.lit(LANES - 1)),
        lambda i: F.conv(F.substring(fingerprint, i * DIGITS + 1, F.lit(DIGITS)), 16, 10).cast(
            "long"
        ),
    )


def combine(a: Column, b: Column, sign: int = 1) -> Column:
    """Lanes of ``a`` with the paragraphs of ``b`` inserted (1) or deleted (-1)."""
    return F.zip_with(a, b, lambda x, y: F.pmod(x + F.lit(sign) * y, F.lit(1 << 32)))


def likeness(a: Column, b: Column) -> Column:
    """From 0 to 1: the estimated cosine of two documents' multisets of word pairs."""

    def signed(lanes: Column) -> Column:
        pairs = F.element_at(lanes, 2 * DENSE + 1)
        counts = F.slice(lanes, 2 * DENSE + 2, 2 * SPREAD)
        return F.transform(counts, lambda c: (F.lit(2) * c - pairs).cast("double"))

    def dot(x: Column, y: Column) -> Column:
        return F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda s, v: s + v)

    size = F.sqrt(dot(signed(a), signed(a)) * dot(signed(b), signed(b)))
    cosine = F.when(size > 0, dot(signed(a), signed(b)) / size).otherwise(F.lit(0.0))
    return F.when(a == b, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), cosine)))


def _bucket(doc_id: Column, bounds: list[int]) -> Column:
    """How many of the sorted bounds are at most ``doc_id``, looked up in two steps."""
    if not bounds:
        return F.lit(0)
    width = max(1, int(len(bounds) ** 0.5))
    blocks = [bounds[i : i + width] for i in range(0, len(bounds), width)]

    def at_most(values: Column) -> Column:
        return F.size(F.filter(values, lambda x: x <= doc_id))

    long = "array<bigint>"
    block = at_most(F.array(*map(F.lit, (b[0] for b in blocks))).cast(long))
    all_blocks = F.array(*(F.array(*map(F.lit, b)).cast(long) for b in blocks))
    inner = at_most(F.element_at(all_blocks, F.greatest(block, F.lit(1))))
    found = F.greatest(block - 1, F.lit(0)) * width + F.when(block > 0, inner).otherwise(0)
    return F.when(doc_id.isNull(), F.lit(0)).otherwise(found).cast("int")


def with_successor(docs: DataFrame) -> DataFrame:
    """doc_id, text, next_text and where the row stands: bucket, place, echo.

    Ids are cut into ranges of equal counts, one bucket each. The first row of a
    bucket is put once more, as an echo, behind the last one of the bucket before it (of the
    first bucket: behind the very last), so that every row finds its successor in
    its own bucket, and texts move once.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", whole_text().alias("text"))
    wanted = BUCKETS_PER_PARTITION * shuffle_partitions(spark)
    parts = [i / wanted for i in range(1, wanted)]
    bounds = docs.agg(F.percentile_approx("doc_id", parts, max(10_000, 4 * wanted))).first()[0]
    placed = docs.withColumn("bucket", _bucket(F.col("doc_id"), sorted(set(bounds or []))))
    nulls = F.max(F.isnull("doc_id").cast("int"))
    firsts = placed.groupBy("bucket").agg(F.min("doc_id").alias("first_id"), nulls.alias("nulls"))
    firsts = sorted(firsts.collect(), key=lambda r: r["bucket"])  # a row per bucket
    before = [
        (r["bucket"], None if r["nulls"] else r["first_id"], firsts[i - 1]["bucket"])
        for i, r in enumerate(firsts)
    ]
    heads = spark.createDataFrame(before, "bucket int, first_id long, before int")
    own = F.struct(F.col("bucket"), F.lit(False).alias("echo"))
    echo = F.struct(F.col("before").alias("bucket"), F.lit(True).alias("echo"))
    is_first = F.col("doc_id").eqNullSafe(F.col("first_id"))
    rows = placed.join(F.broadcast(heads), "bucket").select(
        "doc_id", "text", F.inline(F.when(is_first, F.array(own, echo)).otherwise(F.array(own)))
    )
    order = Window.partitionBy("bucket").orderBy("echo", F.asc_nulls_first("doc_id"), "text")
    return rows.withColumn("place", F.row_number().over(order)).withColumn(
        "next_text", F.lead("text").over(order)
    )


def edited_text(text: Column, next_text: Column) -> Column:
    """The last quarter of the code points replaced by the first as many of the next text."""
    quarter = F.shiftright(F.length(text), 2)
    return F.concat(
        F.substring(text, F.lit(1), F.length(text) - quarter),
        F.substring(next_text, F.lit(1), quarter),
    )


def edit_fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited form, and how alike they are."""
    rows = with_successor(docs)
    length = F.length("text").cast("long")
    edited = F.coalesce(edited_text(F.col("text"), F.col("next_text")), F.lit(""))
    versions = [
        F.struct(F.lit(i).alias("version"), body.alias("body"))
        for i, body in enumerate((F.col("text"), edited))
    ]
    both = rows.select(
        "bucket",
        "place",
        "echo",
        "doc_id",
        length.alias("n_chars"),
        F.inline(F.when(F.col("echo"), F.array(versions[0])).otherwise(F.array(*versions))),
    ).withColumn("sha256", F.when(F.col("version") == 1, F.sha2("body", 256)))
    keys = ["bucket", "place", "echo", "doc_id", "n_chars", "version", "sha256"]
    lanes = fingerprint_lanes(both, keys, "body")
    order = Window.partitionBy("bucket").orderBy("place", "version")
    ahead = lanes.select(
        *keys,
        "lanes",
        F.lead("sha256").over(order).alias("edited_sha256"),
        F.lead("lanes").over(order).alias("edited_lanes"),
        F.lead("lanes", 2).over(order).alias("next_lanes"),
    ).where((F.col("version") == 0) & ~F.col("echo"))
    return ahead.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        as_text(F.col("lanes")).alias("fingerprint"),
        as_text(F.col("edited_lanes")).alias("edited_fingerprint"),
        likeness(F.col("lanes"), F.col("edited_lanes")).alias("near_edited"),
        likeness(F.col("lanes"), F.col("next_lanes")).alias("near_next"),
    )


def document_fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars and fingerprint of every document."""
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", whole_text().alias("text")
    ).withColumn("n_chars", F.length("text").cast("long"))
    lanes = fingerprint_lanes(rows, ["row", "doc_id", "n_chars"], "text")
    return lanes.select("doc_id", "n_chars", as_text(F.col("lanes")).alias("fingerprint"))


def corpus_fingerprint(fingerprinted: DataFrame) -> DataFrame:
    """The fingerprint of all paragraphs of all documents, from theirs."""
    lanes = as_lanes(F.col("fingerprint"))
    sums = [F.pmod(F.sum(F.col("lanes")[i]), F.lit(1 << 32)) for i in range(LANES)]
    total = fingerprinted.select(lanes.alias("lanes")).agg(
        *(F.coalesce(s, F.lit(0).cast("long")).alias(f"lane{i}") for i, s in enumerate(sums))
    )
    joined = reduce(lambda a, b: a + b, [[F.col(f"lane{i}")] for i in range(LANES)])
    return total.select(as_text(F.array(*joined)).alias("fingerprint"))
