"""Batches in files by their numbers, with a manifest of what is where.

A size profile, rows and bytes per batch, sets the ranges: batches in a row share one until it
holds ``RANGE_BYTES``, and a batch that is larger has one of its own, cut into parts. Each
range has a folder, each part a file in it, sorted by batch. A step opens the folder of
its range alone, however many there are.
"""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RANGE_BYTES = 64 << 20
PART_BYTES = 32 << 20
MAPPED_BATCHES = 1_000_000  # up to this many are told to all tasks at once, 20 bytes each
RANGE = "batch_range"
MANIFEST = "range long, first_batch long, last_batch long, rows long, bytes long, parts int"


@dataclass(frozen=True)
class Range:
    """Batches from ``first_batch`` to ``last_batch``, both included."""

    range: int
    first_batch: int
    last_batch: int
    rows: int
    bytes: int
    parts: int


def plan_ranges(
    sizes: list[tuple[int, int]],
    row_bytes: int,
    *,
    range_bytes: int = RANGE_BYTES,
    part_bytes: int = PART_BYTES,
) -> list[Range]:
    """Ranges of the batches in ``sizes``, pairs of a batch and its rows."""
    ranges: list[Range] = []
    for batch, rows in sorted(sizes):
        size = rows * row_bytes
        last = ranges[-1] if ranges else None
        if last is not None and last.bytes + size <= range_bytes:
            ranges[-1] = Range(last.range, last.first_batch, batch, last.rows + rows, last.bytes + size, 1)
        else:
            ranges.append(Range(len(ranges), batch, batch, rows, size, 1))
    return [
        Range(r.range, r.first_batch, r.last_batch, r.rows, r.bytes, max(1, -(-r.bytes // part_bytes)))
        for r in ranges
    ]


class BatchLayout:
    """Where each batch is. What the driver holds is a row for each range."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, ranges: list[Range]) -> None:
        self._spark, self._path, self._schema = spark, path, schema
        self.ranges = ranges
        self.batches = ranges[-1].last_batch + 1 if ranges else 0

    def range_of(self, batch: int) -> Range | None:
        low, high = 0, len(self.ranges)
        while low < high:
            middle = (low + high) // 2
            if self.ranges[middle].last_batch < batch:
                low = middle + 1
            else:
                high = middle
        found = self.ranges[low] if low < len(self.ranges) else None
        return found if found is not None and found.first_batch <= batch else None

    def batch(self, batch: int) -> DataFrame:
        """The rows of one batch; none if no row has its number."""
        held = self.range_of(batch)
        if held is None:
            return self._spark.createDataFrame([], self._schema)
        folder = f"{self._path}/rows/{RANGE}={held.range}"
        return self._spark.read.schema(self._schema).parquet(folder).where(F.col("batch_idx") == batch)


def write_layout(
    shards: DataFrame,
    path: str,
    *,
    row_bytes: int,
    range_bytes: int = RANGE_BYTES,
    part_bytes: int = PART_BYTES,
    keep: bool = True,
) -> BatchLayout:
    """Lays out rows that have ``rank`` and ``batch_idx`` under ``path``.

    Writes the manifest as well, unless nobody will open the layout again. The profile is a row for each batch; each of them will be a job of the
    driver's, so it can hold them. Rows without a batch are left out.
    """
    spark = shards.sparkSession
    counted = shards.where(F.col("batch_idx").isNotNull()).groupBy("batch_idx").count()
    sizes = [(row["batch_idx"], row["count"]) for row in counted.collect()]
    ranges = plan_ranges(sizes, row_bytes, range_bytes=range_bytes, part_bytes=part_bytes)
    layout = BatchLayout(spark, path, shards.schema, ranges)
    if not ranges:
        return layout
    if len(ranges) == 1:
        placed = shards.withColumns({RANGE: F.lit(0).cast("long"), "_parts": F.lit(ranges[0].parts)})
    else:
        where = _batches_of(ranges, sizes)
        table = spark.createDataFrame(
            pa.table(
                {
                    "batch_idx": pa.array([b for _, b in where], pa.int64()),
                    RANGE: pa.array([r.range for r, _ in where], pa.int64()),
                    "_parts": pa.array([r.parts for r, _ in where], pa.int32()),
                }
            )
        )
        small = len(where) <= MAPPED_BATCHES
        placed = shards.join(F.broadcast(table) if small else table, "batch_idx")
    # rows of one rank may be many, and equal ones as well: a place tells them apart
    plain = [f.name for f in shards.schema if not isinstance(f.dataType, T.MapType)]
    apart = [c for c in ("pos_in_rank", "pos_in_batch") if c in shards.columns] or plain
    part = F.when(F.col("_parts") == 1, F.lit(0).cast("long")).otherwise(
        F.pmod(F.xxhash64("rank", *apart), F.col("_parts"))
    )
    (
        placed.withColumn("_part", part)
        .repartition(sum(r.parts for r in ranges), RANGE, "_part")
        .sortWithinPartitions(RANGE, "batch_idx", "rank")
        .select(*shards.columns, RANGE)
        .write.partitionBy(RANGE)
        .parquet(f"{path}/rows")
    )
    if keep:
        fields = [field.split() for field in MANIFEST.split(", ")]
        kinds = {"int": pa.int32(), "long": pa.int64()}
        manifest = {n: pa.array([getattr(r, n) for r in ranges], kinds[k]) for n, k in fields}
        spark.createDataFrame(pa.table(manifest)).coalesce(1).write.parquet(f"{path}/manifest")
    return layout


def _batches_of(ranges: list[Range], sizes: list[tuple[int, int]]) -> list[tuple[Range, int]]:
    found, at = [], 0
    for batch, _ in sorted(sizes):
        while ranges[at].last_batch < batch:
            at += 1
        found.append((ranges[at], batch))
    return found


def open_layout(spark: SparkSession, path: str, schema: T.StructType) -> BatchLayout:
    """A layout that was written before, by what its manifest says."""
    rows = spark.read.schema(MANIFEST).parquet(f"{path}/manifest").orderBy("range").collect()
    return BatchLayout(spark, path, schema, [Range(**row.asDict()) for row in rows])
