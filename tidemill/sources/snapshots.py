"""Tables written to cut lineage, and numbered snapshots to restart from."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.session import new_folder

PUBLISHED = "step long, parts array<string>, segments array<string>"


def freeze(df: DataFrame, label: str, path: str | None = None) -> DataFrame:
    """Writes ``df`` to the shared folder and reads it back.

    The result has a plan of one scan and survives the loss of any executor.
    Partition numbers and sampled range bounds are fixed from here on. A caller
    that drops the table later names its path, one ``new_folder`` returned.
    """
    path = path or new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_frozen(spark: SparkSession, path: str) -> None:
    """Deletes a frozen table that nothing reads any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def publish(
    df: DataFrame, root: str, step: int, parts: Iterable[str] = (), segments: Iterable[str] = ()
) -> DataFrame:
    """Writes ``df`` as snapshot ``step`` of ``root`` and then announces it.

    The announcement is written only after all data files are committed, so a
    run that dies halfway leaves nothing that ``latest_step`` would pick up. It also
    names the ``segments`` of a log that belong to the snapshot: one commit for both.
    """
    spark = df.sparkSession
    path = f"{root}/data/step={step}"
    df.write.mode("overwrite").parquet(path)
    (
        spark.createDataFrame([(step, list(parts), list(segments))], PUBLISHED)
        .coalesce(1)
        .write.mode("append")
        .parquet(f"{root}/published")
    )
    return read_step(spark, root, step, df.schema)


def read_step(spark: SparkSession, root: str, step: int, schema=None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(f"{root}/data/step={step}")


def latest_step(
    spark: SparkSession, root: str, *, at_most: int | None = None, parts: Iterable[str] = ()
) -> int | None:
    """The highest announced step that holds all the named parts, if any."""
    try:
        steps = spark.read.schema(PUBLISHED).parquet(f"{root}/published")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    if at_most is not None:
        steps = steps.where(F.col("step") <= at_most)
    for part in parts:
        steps = steps.where(F.array_contains("parts", part))
    return steps.agg(F.max("step")).first()[0]


def named_segments(spark: SparkSession, root: str, step: int) -> list[str]:
    """The log segments that the announcement of a step names."""
    steps = spark.read.schema(PUBLISHED).parquet(f"{root}/published").where(F.col("step") == step)
    rows = steps.orderBy(F.size("segments").desc()).select("segments").take(1)
    return list(rows[0]["segments"] or []) if rows else []
