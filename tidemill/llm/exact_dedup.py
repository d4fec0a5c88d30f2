"""Exact deduplication that splits frequent texts from the rest.

Texts are equal when they agree after each run of white space becomes one space.
Their SHA-256 digests are written once; everything after that reads the digests.
A Misra-Gries summary names at most ``counters`` digests that may be frequent, a
second pass counts just those exactly, and the verified winners are broadcast, so
copies of a text that fills a third of the corpus are removed where they are read.
A digest outside the summary has at most ``rows / counters`` copies; those are
grouped and joined by an ordinary shuffle.

Defined cases: a null text is empty; equal texts of the same id keep one row, which
one of them is of no consequence; a null id comes after all others; an empty table
gives an empty result. Other columns of the input are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemill.llm.common import fresh, orderable, whole_text
from tidemill.sources.snapshots import freeze

COUNTERS = 1024  # of the summary; bounds what is broadcast
#: A single space stays as it is, so only what must change is replaced.
WHITE_SPACE = r"[\x20\x09-\x0D]{2,}|[\x09-\x0D]"


def text_digest(text: Column) -> Column:
    return F.sha2(F.regexp_replace(text, WHITE_SPACE, " "), 256)


def frequent_digests(digests: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """Up to ``counters`` digests, among them all with over ``rows / counters`` copies.

    Spark's ``freqItems`` is the Misra-Gries summary, kept per task and merged.
    """
    summary = digests.stat.freqItems(["text_sha256"], 1.0 / counters)
    return summary.select(F.explode("text_sha256_freqItems").alias("text_sha256"))


def _groups(digests: DataFrame) -> DataFrame:
    first = F.min(F.struct(F.isnull("doc_id").alias("no_id"), "doc_id", "row"))
    return digests.groupBy("text_sha256").agg(
        first.alias("first"), F.count(F.lit(1)).alias("group_size")
    )


def _digests_and_winners(docs: DataFrame, counters: int) -> tuple[DataFrame, DataFrame]:
    """All digests, and for the frequent ones their group: at most ``counters`` a task."""
    digests = freeze(
        docs.select(
            "doc_id",
            text_digest(whole_text()).alias("text_sha256"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "digests",
    )
    suspects = F.broadcast(frequent_digests(digests, counters))
    winners = _groups(digests.join(suspects, "text_sha256", "left_semi"))
    return digests, freeze(winners, "winners")


def exact_groups(docs: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    digests, winners = _digests_and_winners(docs, counters)
    frequent = digests.join(F.broadcast(winners), "text_sha256")
    rest = digests.join(F.broadcast(winners), "text_sha256", "left_anti")
    decided = frequent.unionByName(rest.join(_groups(rest), "text_sha256"))
    return decided.select(
        "doc_id",
        F.col("first.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("first.row")).alias("kept"),
        "text_sha256",
    )


def drop_exact_copies(docs: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """The documents, all columns, that ``exact_groups`` keeps.

    Copies of frequent texts go where they are read; the rest is shuffled once, by digest.
    """
    digest, place = fresh(docs, "text_sha256"), fresh(docs, "place")
    w_digest, w_id = fresh(docs, "winner_sha256"), fresh(docs, "winner_id")
    _, winners = _digests_and_winners(docs, counters)
    first = winners.select(
        F.col("text_sha256").alias(w_digest), F.col("first.doc_id").alias(w_id)
    )
    marked = docs.withColumns(
        {digest: text_digest(whole_text()), place: F.monotonically_increasing_id()}
    )
    known = marked.join(F.broadcast(first), F.col(digest) == F.col(w_digest), "left")
    may_stay = F.col(w_digest).isNull() | F.col("doc_id").eqNullSafe(F.col(w_id))
    # copies of one id go by their other columns, where those have an order, then by place
    others = [
        F.col(f"`{f.name}`")
        for f in docs.schema
        if f.name not in ("doc_id", "text") and orderable(f.dataType)
    ]
    copies = Window.partitionBy(digest).orderBy(F.asc_nulls_last("doc_id"), *others, place)
    number = fresh(docs, "number")
    return (
        known.where(may_stay)
        .withColumn(number, F.row_number().over(copies))
        .where(F.col(number) == 1)
        .select(*(F.col(f"`{c}`") for c in docs.columns))
    )
