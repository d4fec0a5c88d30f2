"""What the plans must and must not hold."""

import re

import numpy as np
import pytest
from conftest import DATA
from pyspark import StorageLevel
from pyspark.sql import functions as F

from tidemill.operators.fitting import partial_gradients
from tidemill.operators.ordering import global_sort
from tidemill.operators.ranking import _next_ranks, lay_out, shuffling_into
from tidemill.operators.sampling import minibatch, shard_assign
from tidemill.plans.queries import activity_graph, supply_graph
from tidemill.session import new_folder
from tidemill.sources.layout import write_layout
from tidemill.sources.snapshots import freeze

SF_DIR = f"{DATA}/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def above_cache(text):
    """The plan without what is inside cached relations."""
    kept, depth = [], None
    for line in text.splitlines():
        indent = len(line) - len(line.lstrip(" :+-"))
        if depth is not None and indent > depth:
            continue
        depth = None
        if "InMemoryRelation" in line:
            depth = indent
        kept.append(line)
    return "\n".join(kept)


@pytest.fixture
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.set(key, "-1")
    yield
    spark.conf.unset(key)


@pytest.mark.parametrize("hot", [False, True])
@pytest.mark.parametrize("partitions", [4, 8, 16])
@pytest.mark.parametrize("weight", ["raw", "out_degree"])
def test_iterations_do_not_move_the_links(spark, no_broadcast, weight, partitions, hot):
    edges = supply_graph(spark, SF_DIR)
    if hot:  # half of all links from one source
        edges = edges.unionAll(edges.select(F.lit("hub"), "target"))
    links = lay_out(edges, weight=weight, num_partitions=partitions, heavy_rows=1 if hot else 10**9)
    assert (links.spread is not None) == hot
    for part in links.parts():
        part.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        with shuffling_into(spark, partitions):
            links.cold.count()
            first = _next_ranks(links, None, 0.85, "null")
            if hot:  # as in the loop: both parts read a table
                first = freeze(first, "test-ranks")
            second = _next_ranks(links, first, 0.85, "null")
            text = above_cache(plan(second))
        # partial sums only: one exchange on target for each iteration, and of the ranks
        # none, unless they come from a table
        found = re.findall(r"Exchange (\w+)\((\w+)#", text)
        targets = [f for f in found if f == ("hashpartitioning", "target")]
        assert len(targets) == (1 if hot else 2)
        assert len(found) - len(targets) == (1 if hot else 0)
        assert set(re.findall(r"Exchange hashpartitioning\(target#\w+, (\d+)\)", text)) == {str(partitions)}
        assert "SortMergeJoin" in text
        if not hot:  # the links are read in order: only the ranks are sorted
            assert len(re.findall(r"Sort \[", text)) == 1
    finally:
        for part in links.parts():
            part.unpersist()
        links.drop()


def test_spread_links_are_sized_like_the_rest(spark):
    links = lay_out(activity_graph(spark, SF_DIR), weight="out_degree", num_partitions=16, heavy_rows=1)
    read = spark.read.parquet(links.tables[-1])
    assert len(read.inputFiles()) > int(spark.conf.get("spark.sql.shuffle.partitions"))
    links.drop()


def test_links_are_laid_out_in_one_exchange(spark):
    links = lay_out(supply_graph(spark, SF_DIR), weight="out_degree")
    text = plan(links.cold)
    assert len(re.findall("Exchange ", text)) == 1
    assert "ReadSchema: struct<l_partkey:bigint,l_suppkey:bigint>" in text


def test_shards_move_rows_once(spark):
    table = spark.read.parquet(f"{SF_DIR}/embeddings.parquet")
    text = plan(minibatch(shard_assign(table, "vec_id", 4, 1), 64))
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 1
    assert "SinglePartition" not in text


def test_cut_off_is_applied_before_rows_move(spark):
    table = spark.read.parquet(f"{SF_DIR}/embeddings.parquet")
    text = plan(shard_assign(table, "vec_id", 4, 1, rows_per_rank=2))
    below = text[text.index("Exchange hashpartitioning") :]
    assert re.search(r"Filter .*<= ", below)


def test_a_step_reads_its_batch_from_the_files(spark):
    rows = spark.range(4000).select(
        F.lit(0).alias("rank"),
        (F.col("id") % 10).alias("batch_idx"),
        F.array(F.lit(1.0)).alias("features"),
        F.lit(0).alias("label"),
    )
    path = new_folder(spark, "test-shards")
    layout = write_layout(rows, path, row_bytes=8, range_bytes=2 * 400 * 8)
    text = plan(partial_gradients(layout.batch(3), np.zeros((2, 1))))
    laid = spark.read.parquet(f"{path}/rows")
    assert "EqualTo(batch_idx,3)" in text[text.index("PushedFilters") :]
    # files hold ranges of batches: most have none of a step's rows
    files = laid.withColumn("file", F.input_file_name()).groupBy("file").agg(
        F.min("batch_idx").alias("low"), F.max("batch_idx").alias("high")
    )
    with_batch = files.where("low <= 3 AND high >= 3").count()
    assert with_batch <= 2 < files.count()


def test_global_sort_is_by_range(spark):
    events = spark.read.parquet(f"{SF_DIR}/events.parquet").select("event_type", "ts")
    text = plan(global_sort(events, ["event_type", "ts"]))
    assert "Exchange rangepartitioning" in text
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string>" in text
