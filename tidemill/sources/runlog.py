"""Iteration logs: one row per step, one folder per run, one segment per writing.

A fit names its segments by the step they begin with and its saved state names the segments
that belong to it. A fit that dies between the two leaves a segment nobody named, and
going on it writes that segment again: no row is ever there twice.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.sources.snapshots import drop_frozen

RUN_FIELDS = ("epochs", "stop_iter", "nodes", "batch_size")
LOG = "epoch int, iteration long, elapsed_time double"
ALL_BATCHES = 0  # stands for no stop_iter in the name of a folder
_START = "start"


def _run_folder(root: str, run: dict[str, int | None]) -> str:
    named = {field: ALL_BATCHES if run[field] is None else run[field] for field in RUN_FIELDS}
    return "/".join([root, *(f"{field}={value}" for field, value in named.items())])


def start_log(spark: SparkSession, root: str, **run: int | None) -> None:
    """An empty log for a run, in place of any earlier log of the same run."""
    drop_frozen(spark, _run_folder(root, run))
    write_segment(spark.createDataFrame([], LOG), root, _START, **run)


def append_log(rows: DataFrame, root: str, **run: int | None) -> None:
    write_segment(rows, root, f"rows-{uuid.uuid4().hex}", **run)


def segment_from(step: int) -> str:
    """The name of the segment that begins with the step after ``step``."""
    return f"step-{step:012d}"


def write_segment(rows: DataFrame, root: str, segment: str, **run: int | None) -> None:
    """Writes one segment, in place of one of the same name."""
    out = rows.select(
        F.col("epoch").cast("int"),
        F.col("iteration").cast("long"),
        F.col("elapsed_time").cast("double"),
    )
    folder = f"{_run_folder(root, run)}/segment={segment}"
    out.write.mode("overwrite").option("header", True).csv(folder)


def read_log(spark: SparkSession, root: str, *, segments: Sequence[str] | None = None) -> DataFrame:
    """All runs under ``root``; what the folder names say becomes columns.

    Of a run that saves its state, ``segments`` are those the newest state names;
    others of that run are not committed.
    """
    fields = ", ".join(f"{field} int" for field in RUN_FIELDS)
    log = spark.read.schema(f"{LOG}, {fields}, segment string").option("header", True).csv(root)
    if segments is not None:
        log = log.where(F.col("segment").isin(list(segments)))
    return log.drop("segment")
