"""Link graphs held as text, one ``source target`` pair per line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.sources.files import read_text


def parse_edges(
    lines: DataFrame,
    column: str = "value",
    *,
    drop_comments: str | None = None,
    drop_incomplete: bool = False,
) -> DataFrame:
    """Splits lines on runs of whitespace and keeps the first two tokens.

    Nothing is trimmed or dropped unless asked for: a line that starts with a
    blank has an empty source, a one-token line has a null target, and comment
    lines are edges too. ``drop_comments`` names a comment prefix.
    """
    tokens: Column = F.split(F.col(column), r"\s+")
    kept = lines
    if drop_comments is not None:
        kept = kept.where(~F.col(column).startswith(drop_comments))
    edges = kept.select(
        F.get(tokens, F.lit(0)).alias("source"), F.get(tokens, F.lit(1)).alias("target")
    )
    if drop_incomplete:
        edges = edges.where((F.col("source") != "") & (F.col("target") != ""))
    return edges


def read_edges(
    spark: SparkSession,
    path: str,
    *,
    drop_comments: str | None = None,
    drop_incomplete: bool = False,
) -> DataFrame:
    return parse_edges(
        read_text(spark, path), drop_comments=drop_comments, drop_incomplete=drop_incomplete
    )
