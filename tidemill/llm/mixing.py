"""Temperature mixing of sources, realised as budgeted block permutations.

A source's share of all tokens is raised to an exponent and normalised. The exponent
is found by bisection, so that the mixture has a target entropy, or so that no source
is read more than a given number of times. The budget is such that the source with
the least demand is read exactly once: nothing is left out, the others are repeated.

Each reading of a source (a pass) is a keyed permutation: its documents are dealt into
blocks, the blocks are put in a hashed order anew for each pass, and so are the documents
in a block. The last pass takes documents in that order for as long as the tokens
before them are under what is left of the source's budget. Blocks hold a bounded
number of rows, so a source with a third of all rows is spread over many tasks.

Defined cases: a null source is a source of its own; a null text has no tokens; a source
without any token is read once; rows that agree in id, source and text are read together; of one
source, or of an empty table, everything is read once.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemill.llm.common import fresh, whole_text
from tidemill.sources.snapshots import freeze

SEED = 17
MAX_REPEATS = 2.0
BLOCK_ROWS = 4096  # aimed at; keyed hashes make blocks about as large
STEPS = 50


def word_count(text: Column) -> Column:
    """Runs of other than ASCII white space."""
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def source_shares(units: DataFrame) -> DataFrame:
    """One row per source: source, units, tokens, share of all tokens."""
    total = units.agg(F.sum("tokens")).first()[0]
    return (
        units.groupBy("source")
        .agg(F.count(F.lit(1)).alias("units"), F.sum("tokens").alias("tokens"))
        .withColumn("share", F.col("tokens") / F.lit(float(total or 1)))
    )


def bisect(target: float, value: Callable[[float], float]) -> float:
    """Where ``value``, which falls from 0 to 1, meets ``target``; an end if it does not."""
    low, high = 0.0, 1.0
    if value(low) <= target:
        return low
    if value(high) >= target:
        return high
    for _ in range(STEPS):
        middle = (low + high) / 2
        if value(middle) > target:
            low = middle
        else:
            high = middle
    return high


def exponent_for_repeats(shares: DataFrame, repeats: float) -> float:
    """The least exponent at which no source is read more than ``repeats`` times."""
    ends = shares.where("tokens > 0").agg(F.max("share"), F.min("share")).first()
    if ends[0] is None:
        return 1.0
    return bisect(repeats, lambda t: (ends[0] / ends[1]) ** (1 - t))


def exponent_for_entropy(shares: DataFrame, entropy: float) -> float:
    """The exponent at which the mixture has this entropy, in nats; an end if none has.

    Each pass over the sources tries seventeen exponents, four bisections at once.
    """
    some = shares.where("tokens > 0")
    low, high = 0.0, 1.0
    for _ in range(8):
        tried = [low + (high - low) * i / 16 for i in range(17)]
        sums = []
        for t in tried:
            power = F.pow("share", F.lit(t))
            sums += [F.sum(power), F.sum(power * F.log("share") * F.lit(t))]
        found = some.agg(*sums).first()
        if found[0] is None:
            return 1.0
        values = [math.log(z) - zl / z for z, zl in zip(found[::2], found[1::2], strict=True)]
        enough = [i for i, v in enumerate(values) if v >= entropy]
        if not enough:
            return low
        last = enough[-1]
        if last == 16:
            return high
        low, high = tried[last], tried[last + 1]
    return low


def mixture(shares: DataFrame, exponent: float) -> DataFrame:
    """Adds each source's weight and how many times its budget reads it."""
    power = F.when(F.col("tokens") > 0, F.pow("share", F.lit(exponent))).otherwise(F.lit(0.0))
    powered = shares.withColumn("power", power)
    some = F.when(F.col("power") > 0, F.col("tokens") / F.col("power"))
    powers, scale = powered.agg(F.sum("power"), F.max(some)).first()
    # budget = weight * powers * scale, so the source with the least demand is read once
    readings = F.round(F.lit(scale or 0.0) * F.col("power") / F.col("tokens"), 9)
    return powered.select(
        "source",
        "units",
        F.col("tokens").alias("source_tokens"),
        (F.col("power") / F.lit(powers or 1.0)).alias("weight"),
        F.when(F.col("tokens") > 0, F.greatest(F.lit(1.0), readings))
        .otherwise(F.lit(1.0))
        .alias("readings"),
    )


def text_key(text: Column) -> Column:
    """Tells texts of the same id apart."""
    return F.xxhash64(F.lit("text"), text)


def _keyed(*parts) -> Column:
    return F.xxhash64(*(p if isinstance(p, Column) else F.lit(p) for p in parts))


def mix(
    docs: DataFrame,
    *,
    max_repeats: float = MAX_REPEATS,
    entropy: float | None = None,
    tokens: Column | None = None,
    block_rows: int = BLOCK_ROWS,
    seed: int = SEED,
) -> DataFrame:
    """A row for each reading of each document.

    Columns: doc_id, source, text_key, copies (rows that agree in these three, read
    together), tokens of all of them, weight of the source, pass, block (its
    place among those of the source in that pass) and place (in the block).
    """
    count = word_count(whole_text()) if tokens is None else tokens
    units = freeze(
        docs.select("doc_id", "source", text_key(whole_text()).alias("text_key"), count.alias("n"))
        .groupBy("doc_id", "source", "text_key")
        .agg(F.count(F.lit(1)).alias("copies"), F.sum("n").alias("tokens")),
        "units",
    )
    shares = freeze(source_shares(units), "shares")
    if entropy is not None:
        exponent = exponent_for_entropy(shares, entropy)
    else:
        exponent = exponent_for_repeats(shares, max_repeats)
    budget = mixture(shares, exponent).select(
        F.col("source").alias("of"),
        "source_tokens",
        "weight",
        "readings",
        F.ceil(F.col("units") / F.lit(block_rows)).alias("blocks"),
    )
    key = (F.col("doc_id"), F.col("text_key"))
    dealt = (
        units.join(budget, F.col("source").eqNullSafe(F.col("of")))
        .drop("of")
        .withColumn("own", F.pmod(_keyed(seed, "dealt", *key), F.col("blocks")))
    )
    # the last pass may be read in part
    passes = F.sequence(F.lit(0), F.ceil("readings").cast("int") - 1)
    so_far = (Window.unboundedPreceding, 0)
    in_block = Window.partitionBy("source", "own", "pass").orderBy(
        _keyed(seed, F.col("pass"), *key), *key
    )
    read = dealt.withColumn("pass", F.explode(passes)).select(
        "*",
        F.row_number().over(in_block).alias("place"),
        (F.sum("tokens").over(in_block.rowsBetween(*so_far)) - F.col("tokens")).alias("before"),
    )
    in_source = Window.partitionBy("b_source", "b_pass").orderBy(
        _keyed(seed, F.col("b_pass"), F.col("b_own")), "b_own"
    )
    blocks = (
        dealt.groupBy("source", "own")
        .agg(F.sum("tokens").alias("size"), F.max("readings").alias("readings"))
        .select(
            F.col("source").alias("b_source"),
            F.col("own").alias("b_own"),
            F.explode(passes).alias("b_pass"),
            "size",
        )
        .select(
            "b_source",
            "b_own",
            "b_pass",
            F.row_number().over(in_source).alias("block"),
            (F.sum("size").over(in_source.rowsBetween(*so_far)) - F.col("size")).alias("ahead"),
        )
    )
    same = (
        F.col("source").eqNullSafe(F.col("b_source"))
        & (F.col("own") == F.col("b_own"))
        & (F.col("pass") == F.col("b_pass"))
    )
    left = (F.col("readings") - F.col("pass")) * F.col("source_tokens")
    whole = F.col("pass") + 1 <= F.col("readings")
    taken = whole | (F.col("ahead") + F.col("before") < left)
    return (
        read.join(blocks, same)
        .where(taken)
        .select(
            "doc_id",
            "source",
            "text_key",
            "copies",
            "tokens",
            "weight",
            "pass",
            "block",
            "place",
        )
    )


def mixed_documents(docs: DataFrame, **how) -> DataFrame:
    """The documents, all columns, each as often as the mixture reads it."""
    key, n, once = fresh(docs, "text_key"), fresh(docs, "readings"), fresh(docs, "once")
    r_id, r_source, r_key = (fresh(docs, f"read_{c}") for c in ("id", "source", "key"))
    again = (
        mix(docs, **how)
        .groupBy(
            F.col("doc_id").alias(r_id),
            F.col("source").alias(r_source),
            F.col("text_key").alias(r_key),
        )
        .agg(F.count(F.lit(1)).cast("int").alias(n))
        .where(F.col(n) > 1)
    )
    marked = docs.withColumn(key, text_key(whole_text()))
    same = (
        F.col("doc_id").eqNullSafe(F.col(r_id))
        & F.col("source").eqNullSafe(F.col(r_source))
        & (F.col(key) == F.col(r_key))
    )
    copies = F.array_repeat(F.lit(True), F.coalesce(F.col(n), F.lit(1)))
    return (
        marked.join(again, same, "left")
        .withColumn(once, F.explode(copies))
        .select(*(F.col(f"`{c}`") for c in docs.columns))
    )
