"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.session import new_folder
from tidemill.sources.snapshots import drop_frozen, freeze


def connect(edges: DataFrame) -> DataFrame:
    """node, root: the smallest node of its component, for every node of ``edges`` (a, b).

    In each round the larger of two neighbouring roots is hung below the smallest root
    it has an edge to, chains of such hangings are shortened, and edges are drawn
    between roots again. Rounds are written out; only counts reach the driver.
    """
    spark = edges.sparkSession
    ends = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    roots = ends.select("node", F.col("node").alias("root"))
    open_edges, held, result = edges.select("a", "b"), [], None
    while True:
        ordered = open_edges.where("a != b").select(
            F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
        )
        path = new_folder(spark, "edges")
        ordered = freeze(ordered.distinct(), "edges", path)
        held.append(path)
        if ordered.isEmpty():
            break
        path = new_folder(spark, "hung")
        hung = ordered.groupBy("b").agg(F.min("a").alias("a"))
        up = hung.select(F.col("b").alias("below"), F.col("a").alias("above"))
        for _ in range(2):
            step = up.select(F.col("below").alias("s_below"), F.col("above").alias("s_above"))
            up = up.join(step, F.col("above") == F.col("s_below"), "left").select(
                "below", F.coalesce("s_above", "above").alias("above")
            )
        up = freeze(up, "hung", path)
        held.append(path)

        def moved(df: DataFrame, column: str, up: DataFrame = up) -> DataFrame:
            renamed = up.select(F.col("below").alias("m_below"), F.col("above").alias("m_above"))
            return df.join(renamed, F.col(column) == F.col("m_below"), "left").withColumn(
                column, F.coalesce("m_above", column)
            ).drop("m_below", "m_above")

        open_edges = moved(moved(ordered, "a"), "b")
        result = new_folder(spark, "roots")
        roots = freeze(moved(roots, "root"), "roots", result)
        held.append(result)
    for path in held:
        if path != result:
            drop_frozen(spark, path)
    return roots
