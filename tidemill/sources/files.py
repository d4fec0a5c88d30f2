"""CSV and text scans and sinks. Every path may be a file or a folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemill.functions.hashing import hex_number, keyed_md5


def read_csv(spark: SparkSession, path: str, *, schema: StructType | str | None = None) -> DataFrame:
    """CSV with a header row. Without a schema every column is a string; an
    empty field is null either way."""
    reader = spark.read.option("header", True)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


def read_text(spark: SparkSession, path: str) -> DataFrame:
    """One row per line, column ``value``."""
    return spark.read.text(path)


def write_csv(
    df: DataFrame, path: str, *, mode: str = "errorifexists", single_file: bool = False
) -> None:
    """CSV with a header row; null becomes an empty field.

    ``single_file`` pulls the whole result through one task, so it is meant for
    small reports only. Part files are named in partition order otherwise.
    """
    out = df.coalesce(1) if single_file else df
    out.write.mode(mode).option("header", True).csv(path)


def read_labelled(
    spark: SparkSession, path: str, *, id_col: str, features: str, label: str
) -> DataFrame:
    """A labelled feature table as ``(id, features, label)``."""
    return spark.read.parquet(path).select(
        F.col(id_col).alias("id"),
        F.col(features).alias("features"),
        F.col(label).cast("int").alias("label"),
    )


def split_train_test(
    df: DataFrame, id_col: str = "id", *, seed: int, test_percent: int = 20
) -> DataFrame:
    """Adds ``split``. The side depends on the seed and the id alone, so both
    sides are disjoint and stable whatever the layout of the table."""
    bucket = hex_number(keyed_md5(seed, F.col(id_col)), 1, 8) % 100
    return df.withColumn("split", F.when(bucket < test_percent, "test").otherwise("train"))


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder, wherever Spark can reach it."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()).exists(found)
