"""Global sorts and row positions that never pass all rows through one task."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tidemill.sources.files import read_csv, write_csv
from tidemill.sources.snapshots import freeze

HASH_DIGITS = 4  # positions in hash order: 16 ** 4 buckets
HOT_ROWS = 1_000_000  # a bucket or key up to this size is never split
_ROW_BITS = 33  # monotonically_increasing_id: partition number above, row number below


def global_sort(
    df: DataFrame, keys: Sequence[str], *, ascending: bool | Sequence[bool] = True
) -> DataFrame:
    """Sorts by ``keys``, nulls first on ascending keys and last on descending.

    Rows that tie on every key have no order among them, so ties are broken by
    the number of the input partition. That lets the range partitioner spread a
    hot key over many tasks, and since all of a task's ties move together a
    re-run task sends them where it sent them the first time.
    """
    up = [ascending] * len(keys) if isinstance(ascending, bool) else list(ascending)
    order = [
        F.col(k).asc_nulls_first() if a else F.col(k).desc_nulls_last()
        for k, a in zip(keys, up, strict=True)
    ]
    return df.withColumn("_origin", F.spark_partition_id()).orderBy(*order, "_origin").drop("_origin")


def with_order_id(df: DataFrame, name: str = "order_id") -> DataFrame:
    """A number that grows along the current order, with gaps between partitions."""
    return df.withColumn(name, F.monotonically_increasing_id())


def close_gaps(df: DataFrame, order_id: str = "order_id", position: str = "pos") -> tuple[DataFrame, int]:
    """Turns the order ids of a *frozen* table into positions 0, 1, 2, ...

    Also returns the number of rows. Only one count per sorted partition is
    looked at, so what is collected and broadcast is bounded by the number of
    partitions of the sort.
    """
    part = F.shiftright(F.col(order_id), _ROW_BITS)
    parts = _running_totals(df.groupBy(part.alias("_part")).count())
    row = F.col(order_id).bitwiseAND((1 << _ROW_BITS) - 1)
    placed = (
        df.withColumn("_part", part)
        .join(F.broadcast(parts.table(df.sparkSession)), "_part")
        .withColumn(position, F.col("_start") + row)
        .drop("_part", "_start")
    )
    return placed, parts.total


def stored_position(stored: DataFrame, position: str = "pos") -> DataFrame:
    """Adds each row's place in the files of a Parquet scan: files by name, rows as they lie.

    No row moves: a scan knows the place of a row in its file, so only one count per file is
    added up, which is what reaches the driver and is broadcast. ``stored`` is a scan, before
    any exchange. Files that Spark wrote have names in the order of its partitions.
    """
    spark = stored.sparkSession
    files = stored.groupBy(F.col("_metadata.file_path").alias("_file")).count().collect()
    starts, total = [], 0
    for file in sorted(files, key=lambda row: row["_file"]):
        starts.append((file["_file"], total))
        total += file["count"]
    numbered = stored.select(
        "*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row")
    )
    names, firsts = [name for name, _ in starts], [first for _, first in starts]
    table = spark.createDataFrame(
        pa.table({"_file": pa.array(names, pa.string()), "_start": pa.array(firsts, pa.int64())})
    )
    return (
        numbered.join(F.broadcast(table), "_file")
        .withColumn(position, F.col("_start") + F.col("_row"))
        .drop("_file", "_row", "_start")
    )


def global_position(
    df: DataFrame,
    keys: Sequence[str],
    *,
    position: str = "pos",
    ascending=True,
    path: str | None = None,
) -> tuple[DataFrame, int]:
    """Adds each row's position in the order of ``keys``, and counts the rows.

    One range exchange; the sorted rows are written once, because the bounds of
    a range exchange differ from run to run. They go to ``path`` if the caller
    wants to drop them later.
    """
    ordered = with_order_id(global_sort(df, keys, ascending=ascending), "_order_id")
    placed, total = close_gaps(freeze(ordered, "ordered", path), "_order_id", position)
    return placed.drop("_order_id"), total


def hash_position(
    df: DataFrame,
    digest: Column,
    tie: str,
    *,
    position: str = "pos",
    first: int | None = None,
    hot_rows: int = HOT_ROWS,
) -> tuple[DataFrame, int]:
    """Adds each row's position in the order of a hex digest, and counts the rows.

    Digests spread evenly over their leading digits, so the digits make buckets
    whose sizes are counted first (a narrow scan) and whose rows are numbered
    side by side: one exchange, nothing written. Where copies of one id make a
    bucket too big for a task, the general way above is taken instead, to the same
    positions: ties go by ``tie``, then by a hash over all columns.

    ``first`` keeps only that many positions; buckets beyond them are left out
    before the exchange. The count returned is always that of all rows.
    """
    keyed = df.withColumn("_digest", digest)
    bucket = F.substring("_digest", 1, HASH_DIGITS)
    sizes = keyed.groupBy(bucket.alias("_part")).count()
    buckets = _running_totals(sizes)
    total, largest = buckets.total, buckets.largest
    wanted = F.lit(True) if first is None else F.col(position) < first
    # rows that agree in all this are the same to any reader of the positions
    same = F.xxhash64(*(f.name for f in df.schema if not isinstance(f.dataType, T.MapType)))
    if largest > max(hot_rows, 4 * total // 16**HASH_DIGITS):
        keyed = keyed.withColumn("_same", same)
        placed, _ = global_position(keyed, ["_digest", tie, "_same"], position=position)
        return placed.where(wanted).drop("_digest", "_same"), total
    if first is not None:
        # buckets are in digest order: those that start in time are a prefix
        needed = [part for part, start in buckets.starts if start < first]
        keyed = keyed.where(bucket <= needed[-1] if needed else F.lit(False))
    within = Window.partitionBy("_part").orderBy("_digest", tie, same)
    placed = (
        keyed.withColumn("_part", bucket)
        .withColumn("_row", F.row_number().over(within))
        .join(F.broadcast(buckets.table(df.sparkSession)), "_part")
        .withColumn(position, F.col("_start") + F.col("_row") - 1)
        .where(wanted)
        .drop("_part", "_row", "_start", "_digest")
    )
    return placed, total


@dataclass
class _Totals:
    """Where each bucket starts, in bucket order; the callers bound their number."""

    starts: list[tuple]
    total: int
    largest: int
    key: T.StructField

    def table(self, spark: SparkSession) -> DataFrame:
        schema = T.StructType([self.key, T.StructField("_start", T.LongType())])
        if not self.starts:
            return spark.createDataFrame([], schema)
        keys, starts = zip(*self.starts, strict=True)
        arrow = pa.table({self.key.name: pa.array(keys), "_start": pa.array(starts)})
        return spark.createDataFrame(arrow)


def _running_totals(sizes: DataFrame) -> _Totals:
    counted = sorted(tuple(row) for row in sizes.collect())
    starts, total = [], 0
    for key, count in counted:
        starts.append((key, total))
        total += count
    largest = max((count for _, count in counted), default=0)
    return _Totals(starts, total, largest, sizes.schema[0])


def sort_csv(
    spark: SparkSession,
    src: str,
    dst: str,
    keys: Sequence[str],
    *,
    schema: T.StructType | str | None = None,
    ascending: bool | Sequence[bool] = True,
    single_file: bool = False,
    order_id: str | None = None,
) -> DataFrame:
    """Sorts CSV files into CSV files and returns the output, unread.

    Without a schema keys compare as strings, byte by byte; a schema gives a
    typed sort. Part files follow the order; ``order_id`` also writes it down.
    """
    ordered = global_sort(read_csv(spark, src, schema=schema), keys, ascending=ascending)
    if order_id is not None:
        ordered = with_order_id(ordered, order_id)
    write_csv(ordered, dst, mode="overwrite", single_file=single_file)
    return read_csv(spark, dst, schema=ordered.schema)
