"""Accuracy and loss of scored rows ``(scores, label)``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.functions.vectors import argmax, cross_entropy
from tidemill.functions.whole import div
from tidemill.operators.ordering import global_position, stored_position
from tidemill.sources.snapshots import freeze


def evaluate(
    scored: DataFrame,
    batch_size: int,
    *,
    position: str = "pos",
    scores: str = "scores",
    label: str = "label",
) -> DataFrame:
    """``batch_mean_loss`` and ``accuracy`` in one pass and one row."""
    return _over_batches(_batches(_marked(scored, position, scores, label), batch_size))


def evaluate_in_order(
    stored: DataFrame,
    key: str,
    batch_size: int,
    scoring: Callable[[DataFrame], DataFrame],
    *,
    scores: str = "scores",
    label: str = "label",
) -> DataFrame:
    """``evaluate`` with rows in the order of ``key``, a Parquet scan scored by ``scoring``.

    Where the files lie in that order nothing is sorted: a task adds up its own rows by batch
    and only the parts of batches that straddle two tasks meet. Whether they do is seen
    from the batches' smallest and largest keys, one row a batch; order inside a batch does not
    matter. If they do not, or keys are null or tie at a border, rows are sorted by the
    key, as a key, a loss and a hit.
    """
    marked = _marked(scoring(stored_position(stored, "pos")), "pos", scores, label, key)
    batches = freeze(_batches(marked, batch_size, key), "batches")
    if not _in_order(batches):
        narrow = freeze(marked.drop("pos"), "marked")
        batches = _batches(global_position(narrow, [key])[0], batch_size, key)
    return _over_batches(batches)


def _marked(scored: DataFrame, position: str, scores: str, label: str, *keys: str) -> DataFrame:
    """Loss and hit of each row beside its place."""
    return scored.select(
        F.col(position).alias("pos"),
        *keys,
        cross_entropy(F.col(scores), F.col(label)).alias("loss"),
        (argmax(F.col(scores)) == F.col(label)).cast("int").alias("hit"),
    )


def _batches(marked: DataFrame, batch_size: int, key: str | None = None) -> DataFrame:
    """One row a batch; with ``key`` its smallest and largest one and how many it has."""
    keys = [F.min(key).alias("low"), F.max(key).alias("high"), F.count(key).alias("keys")] if key else []
    return marked.groupBy(div(F.col("pos"), batch_size).alias("batch_idx")).agg(
        F.avg("loss").alias("batch_loss"),
        F.sum("hit").alias("hits"),
        F.count(F.lit(1)).alias("rows"),
        *keys,
    )


def _in_order(batches: DataFrame) -> bool:
    """Whether every batch's keys are all larger than those of the batch before."""
    before = batches.select((F.col("batch_idx") + 1).alias("batch_idx"), F.col("high").alias("bound"))
    wrong = (F.col("keys") < F.col("rows")) | (F.col("low") <= F.col("bound"))
    return batches.join(before, "batch_idx", "left").where(wrong).isEmpty()


def _over_batches(batches: DataFrame) -> DataFrame:
    return batches.agg(
        F.avg("batch_loss").alias("loss"),
        F.count(F.lit(1)).alias("batches"),
        F.sum("hits").alias("correct"),
        F.sum("rows").alias("total"),
    ).withColumn("percent", F.col("correct") * 100.0 / F.col("total"))


def predict(scored: DataFrame, scores: str = "scores") -> DataFrame:
    return scored.withColumn("predicted", argmax(F.col(scores)))


def accuracy(scored: DataFrame, scores: str = "scores", label: str = "label") -> DataFrame:
    """One row: ``correct``, ``total``, ``percent``."""
    hit = (argmax(F.col(scores)) == F.col(label)).cast("int")
    counted = scored.agg(F.sum(hit).alias("correct"), F.count(F.lit(1)).alias("total"))
    return counted.withColumn("percent", F.col("correct") * 100.0 / F.col("total"))


def batch_mean_loss(
    scored: DataFrame,
    batch_size: int,
    *,
    position: str = "pos",
    scores: str = "scores",
    label: str = "label",
) -> DataFrame:
    """One row: ``loss``, the mean of the batches' mean losses, and ``batches``.

    Batches are runs of ``batch_size`` positions. All weigh the same, so rows of
    a short last batch weigh more than others.
    """
    return (
        scored.select(
            div(F.col(position), batch_size).alias("batch_idx"),
            cross_entropy(F.col(scores), F.col(label)).alias("loss"),
        )
        .groupBy("batch_idx")
        .agg(F.avg("loss").alias("batch_loss"))
        .agg(F.avg("batch_loss").alias("loss"), F.count(F.lit(1)).alias("batches"))
    )
