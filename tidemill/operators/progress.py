"""Roll-ups of run logs and phase logs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.functions.whole import div

REPORT_EVERY = 20


def interval_rollup(
    log: DataFrame,
    every: int = REPORT_EVERY,
    *,
    batch_size: int,
    ranks: int,
    total_rows: int,
    steps: int,
    by: Sequence[str] = (),
) -> DataFrame:
    """One progress row whenever an epoch reaches a multiple of ``every`` iterations.

    Time is counted from the previous report, as far as it is in the log, and starts anew
    each epoch; steps after the last multiple are never reported. ``log`` needs
    ``epoch``, ``iteration`` (from 1), ``elapsed_time`` and ``loss``, and of several
    runs the columns ``by`` that tell them apart.
    """
    interval = div(F.col("iteration") - 1, every)
    return (
        log.groupBy(*by, "epoch", interval.alias("_interval"))
        .agg(
            F.max("iteration").alias("iteration"),
            F.max_by("loss", "iteration").alias("last_loss"),
            F.sum("elapsed_time").alias("interval_time"),
        )
        .where(F.col("iteration") == (F.col("_interval") + 1) * every)
        .select(
            *by,
            "epoch",
            "iteration",
            (F.col("iteration").cast("long") * F.lit(batch_size * ranks)).alias("rows_seen"),
            F.lit(total_rows).cast("long").alias("total_rows"),
            (F.col("iteration") * 100.0 / steps).alias("percent"),
            "last_loss",
            "interval_time",
        )
    )


def phase_rollup(phases: DataFrame) -> DataFrame:
    """Seconds of each phase and, on the row marked so, of all together."""
    return phases.rollup("phase").agg(
        F.grouping("phase").cast("int").alias("is_total"), F.sum("seconds").alias("seconds")
    )
