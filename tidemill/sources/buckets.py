"""Bucketed tables that outlive the session which wrote them.

The files of a bucketed table are named by their bucket; the table's entry in the catalog, which
says so to the planner, may be gone with its session. Here a table is its folder, and an
entry is made for it whenever it is opened.
"""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def _name() -> str:
    return f"tidemill_{uuid.uuid4().hex}"


def write_bucketed(df: DataFrame, path: str, buckets: int, column: str) -> None:
    """Writes ``df`` in ``buckets`` by ``column``, each sorted by it.

    Rows that are hash-partitioned by the column into as many partitions are in place
    already, and each task writes the one file of its bucket.
    """
    name = _name()
    writer = df.write.format("parquet").bucketBy(buckets, column).sortBy(column)
    writer.option("path", path).mode("overwrite").saveAsTable(name)
    df.sparkSession.sql(f"DROP TABLE {name}")  # the entry; the files stay


def bucketed(
    spark: SparkSession, path: str, schema: T.StructType | str, buckets: int, column: str
) -> DataFrame:
    """The rows, known to be hash-partitioned by the column. The entry goes with the program."""
    name = _name()
    fields = schema if isinstance(schema, str) else ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" for f in schema
    )
    location = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE {name} ({fields}) USING parquet CLUSTERED BY ({column}) "
        f"SORTED BY ({column}) INTO {buckets} BUCKETS LOCATION '{location}'"
    )
    atexit.register(_forget, spark, name)
    return spark.table(name)


def _forget(spark: SparkSession, name: str) -> None:
    context = spark.sparkContext._jsc
    if context is not None and not context.sc().isStopped():
        spark.sql(f"DROP TABLE IF EXISTS {name}")
