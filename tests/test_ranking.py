import math
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidemill.operators import ranking
from tidemill.operators.ranking import (
    init_ranks,
    lay_out,
    out_degree,
    pagerank,
    profile_links,
    rank_edges,
    rank_step,
)
from tidemill.session import new_folder
from tidemill.sources.links import parse_edges, read_edges
from tidemill.sources.snapshots import latest_step

LINES = ["# FromNodeId\tToNodeId", "a b", "b c", "c b", "d", "  x y", "", "a b"]
EDGES = [
    ("#", "FromNodeId"),
    ("a", "b"),
    ("b", "c"),
    ("c", "b"),
    ("d", None),
    ("", "x"),
    ("", None),
    ("a", "b"),
]
GOLDEN = {
    "raw": {
        1: {"FromNodeId": 1.0, "b": 2.7, "c": 1.0, "x": 1.0, None: 1.85},
        2: {"FromNodeId": None, "b": 1.0, "c": 2.445, "x": None, None: None},
        3: {"FromNodeId": None, "b": 2.22825, "c": 1.0, "x": None, None: None},
    },
    "out_degree": {
        1: {"FromNodeId": 1.0, "b": 1.85, "c": 1.0, "x": 0.575, None: 1.425},
        2: {"FromNodeId": None, "b": 1.0, "c": 1.7225, "x": None, None: None},
        3: {"FromNodeId": None, "b": 1.614125, "c": 1.0, "x": None, None: None},
    },
}


@pytest.fixture(scope="module")
def edges(spark):
    return spark.createDataFrame(EDGES, "source string, target string")


def as_dict(ranks):
    rows = ranks.collect()
    found = {row["source"]: row["rank"] for row in rows}
    assert len(found) == len(rows)
    return found


def assert_ranks(ranks, expected):
    found = as_dict(ranks)
    assert set(found) == set(expected)
    for page, rank in expected.items():
        if rank is None:
            assert found[page] is None, page
        else:
            assert found[page] == pytest.approx(rank, rel=1e-9), page


def brute_force(edges, weight, iters, damping=0.85):
    ranks = {s: 1.0 for s, _ in edges}
    degree = {}
    for s, _ in edges:
        degree[s] = degree.get(s, 0) + 1
    for _ in range(iters):
        sums = {}
        for s, t in edges:
            sums.setdefault(t, [])
            rank = None if s is None else ranks.get(s)
            if rank is not None:
                sums[t].append(rank if weight == "raw" else rank / degree[s])
        ranks = {
            t: math.fsum(v) * damping + 1 - damping if v else None for t, v in sums.items()
        }
    return ranks


def test_parsing_keeps_every_line(spark):
    lines = spark.createDataFrame([(line,) for line in LINES], "value string")
    found = [tuple(row) for row in parse_edges(lines).collect()]
    assert sorted(found, key=str) == sorted(EDGES, key=str)


def test_reading_a_folder_of_files(spark):
    path = new_folder(spark, "test-links")
    lines = spark.createDataFrame([(line,) for line in LINES], "value string")
    lines.repartition(3).write.text(path)
    assert sorted(map(tuple, read_edges(spark, path).collect()), key=str) == sorted(EDGES, key=str)
    kept = read_edges(spark, path, drop_comments="#", drop_incomplete=True)
    assert sorted(map(tuple, kept.collect())) == [("a", "b"), ("a", "b"), ("b", "c"), ("c", "b")]


def test_start(edges):
    assert as_dict(init_ranks(edges)) == dict.fromkeys(["#", "a", "b", "c", "d", ""], 1.0)
    assert as_dict(pagerank(edges, weight="raw", iters=0)) == as_dict(init_ranks(edges))


def test_out_degree_counts_repeats_and_dangling_links(edges):
    found = {row["source"]: row["n"] for row in out_degree(edges).collect()}
    assert found == {"#": 1, "a": 2, "b": 1, "c": 1, "d": 1, "": 2}


@pytest.mark.parametrize("weight", ["raw", "out_degree"])
@pytest.mark.parametrize("iters", [1, 2, 3])
def test_golden_ranks(edges, weight, iters):
    assert_ranks(pagerank(edges, weight=weight, iters=iters), GOLDEN[weight][iters])


@pytest.mark.parametrize("weight", ["raw", "out_degree"])
def test_single_steps_add_up(edges, weight):
    links, ranks = lay_out(edges, weight=weight), init_ranks(edges)
    for k in (1, 2, 3):
        ranks = rank_step(links, ranks)
        assert_ranks(ranks, GOLDEN[weight][k])


@pytest.mark.parametrize("weight,options", [
    ("raw", {"num_partitions": 1}),
    ("raw", {"num_partitions": 3}),
    ("out_degree", {"num_partitions": 8}),
    ("out_degree", {"cache": False}),
    ("raw", {"cache": False, "cut_every": 1}),
    ("out_degree", {"cut_every": 2}),
    ("raw", {"heavy_rows": 1, "num_partitions": 7}),
    ("out_degree", {"heavy_rows": 1, "cache": False, "num_partitions": 7}),
])
def test_layout_does_not_change_ranks(edges, weight, options):
    assert_ranks(pagerank(edges, weight=weight, iters=3, **options), GOLDEN[weight][3])


def hub_graph():
    """One page has half of the links, another of the rest has no name."""
    pages = [f"p{i}" for i in range(40)]
    links = [("hub", p) for p in pages * 5] + [(p, "hub") for p in pages]
    links += [(p, pages[(i * 7 + 3) % 40]) for i, p in enumerate(pages)] * 2
    return links + [(None, p) for p in pages] + [("p1", None)] * 30


@pytest.mark.parametrize("weight", ["raw", "out_degree"])
def test_heavy_source_is_spread(spark, weight):
    links = hub_graph()
    edges = spark.createDataFrame(links, "source string, target string")
    laid = lay_out(edges, weight=weight, heavy_rows=50)
    assert [r["source"] for r in laid.heavy.collect()] == ["hub"]
    cold = {row["source"] for row in laid.cold.select("source").distinct().collect()}
    assert cold == {f"p{i}" for i in range(40)}
    ranks = pagerank(edges, weight=weight, iters=4, heavy_rows=50)
    assert_ranks(ranks, brute_force(links, weight, 4))


def test_partitions_follow_the_links(spark, monkeypatch):
    links = [(f"p{i % 50}", f"p{i * 7 % 50}") for i in range(500)]
    edges = spark.createDataFrame(links, "source string, target string")
    cores = spark.sparkContext.defaultParallelism
    assert lay_out(edges, weight="raw").partitions == 8
    monkeypatch.setattr(ranking, "PARTITION_ROWS", 10)
    laid = lay_out(edges, weight="raw")
    assert laid.partitions == max(50, cores) == laid.cold.rdd.getNumPartitions()
    assert_ranks(pagerank(edges, weight="raw", iters=3), brute_force(links, "raw", 3))


def test_many_nameless_sources_are_spread(spark):
    links = [(None, f"p{i}") for i in range(300)] + [("p1", "p2"), ("p2", "p1")]
    edges = spark.createDataFrame(links, "source string, target string")
    laid = lay_out(edges, weight="out_degree", heavy_rows=10)
    assert laid.heavy.isEmpty() and laid.spread.count() == 300
    ranks = pagerank(edges, weight="out_degree", iters=2, heavy_rows=10)
    assert_ranks(ranks, brute_force(links, "out_degree", 2))


def test_teleport_ranks_pages_nobody_links_to(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c")], "source string, target string")
    found = as_dict(pagerank(edges, weight="out_degree", iters=3, missing="teleport"))
    assert found["b"] == pytest.approx(0.15 * 0.85 + 0.15)
    assert found["c"] == pytest.approx((0.15 * 0.85 + 0.15) * 0.85 + 0.15)


def test_weight_must_be_named(edges):
    with pytest.raises(TypeError):
        pagerank(edges)
    with pytest.raises(ValueError):
        pagerank(edges, weight="other")
    with pytest.raises(ValueError):
        pagerank(edges, weight="raw", missing="other").collect()


@pytest.mark.parametrize("stopped_after", [1, 2, 3])
def test_restart_goes_on_from_the_snapshot(spark, edges, monkeypatch, stopped_after):
    folder = new_folder(spark, "test-snapshots")
    pagerank(edges, weight="raw", iters=stopped_after, snapshot_dir=folder)
    steps = []
    step = ranking._next_ranks
    monkeypatch.setattr(ranking, "_next_ranks", lambda *a: steps.append(1) or step(*a))
    assert_ranks(pagerank(edges, weight="raw", iters=3, snapshot_dir=folder), GOLDEN["raw"][3])
    assert len(steps) == 3 - stopped_after


def test_a_run_that_dies_while_writing_leaves_no_snapshot(spark, edges, monkeypatch):
    folder = new_folder(spark, "test-snapshots")
    pagerank(edges, weight="raw", iters=1, snapshot_dir=folder)
    root = f"{folder}/raw-0.85-null-{profile_links(edges).fingerprint}"
    # data of a second step, never announced
    edges.write.parquet(f"{root}/data/step=2")
    assert latest_step(spark, root) == 1
    assert_ranks(
        pagerank(edges, weight="raw", iters=3, cut_every=1, snapshot_dir=folder), GOLDEN["raw"][3]
    )
    assert latest_step(spark, root) == 3
    assert latest_step(spark, root, at_most=2) == 2
    # another weighting of the same folder starts on its own
    ranks = pagerank(edges, weight="out_degree", iters=3, snapshot_dir=folder)
    assert_ranks(ranks, GOLDEN["out_degree"][3])


@pytest.mark.parametrize("cache", [True, False])
def test_only_the_last_cut_is_kept(spark, edges, monkeypatch, cache):
    made, dropped = [], []
    freeze, drop = ranking.freeze, ranking.drop_frozen
    monkeypatch.setattr(ranking, "freeze", lambda d, n, p: made.append(p) or freeze(d, n, p))
    monkeypatch.setattr(ranking, "drop_frozen", lambda s, p: dropped.append(p) or drop(s, p))
    ranks = pagerank(edges, weight="raw", iters=3, cut_every=1, cache=cache)
    assert len(made) == 3 and dropped == made[:-1]
    assert_ranks(ranks, GOLDEN["raw"][3])
    assert not any(Path(path).exists() for path in dropped) and Path(made[-1]).exists()


def test_nothing_stays_cached(spark, edges):
    pagerank(edges, weight="raw", iters=2, cache=True).collect()
    assert spark.sparkContext._jsc.getPersistentRDDs().isEmpty()


def test_other_edges_start_anew_in_the_same_folder(spark, edges):
    folder = new_folder(spark, "test-snapshots")
    pagerank(edges, weight="raw", iters=2, snapshot_dir=folder)
    other = spark.createDataFrame([("x", "y")], "source string, target string")
    assert [tuple(r) for r in pagerank(other, weight="raw", iters=2, snapshot_dir=folder).collect()] == [("y", None)]
    assert_ranks(pagerank(edges, weight="raw", iters=3, snapshot_dir=folder), GOLDEN["raw"][3])


@pytest.mark.parametrize("heavy_rows", [1, 10**9])
def test_steps_are_published_when_the_caller_says(spark, edges, heavy_rows):
    folder = new_folder(spark, "test-snapshots")
    options = {"num_partitions": 7, "heavy_rows": heavy_rows, "cut_every": 2, "snapshot_dir": folder}
    pagerank(edges, weight="raw", iters=5, **options)
    root = f"{folder}/raw-0.85-null-{profile_links(edges).fingerprint}"
    steps = spark.read.parquet(f"{root}/published").select("step").collect()
    assert sorted(r["step"] for r in steps) == [2, 4, 5]


@pytest.mark.parametrize("missing", ["null", "teleport"])
@pytest.mark.parametrize("weight", ["raw", "out_degree"])
def test_one_step_over_links_as_they_are(spark, weight, missing):
    """Links that come twice, a page without a rank, a link without a source and a hot source."""
    rows = [("a", "b"), ("a", "b"), ("a", "c"), ("b", "c"), ("c", "a"), ("d", "a"), (None, "b"), ("e", None)]
    edges = spark.createDataFrame(rows + [("hot", str(i % 7)) for i in range(500)], "source string, target string")
    ranks = init_ranks(edges).where("source != 'd'").withColumn("rank", F.length("source") * 0.5)
    laid = rank_step(lay_out(edges, weight=weight, heavy_rows=50), ranks, missing=missing)
    found = {r["source"]: r["rank"] for r in rank_edges(edges, ranks, weight=weight, missing=missing).collect()}
    assert found == pytest.approx({r["source"]: r["rank"] for r in laid.collect()})
    with pytest.raises(ValueError):
        rank_edges(edges, ranks, weight="other")


def some_links(spark):
    links = [(f"p{i % 50}", f"p{i * 7 % 50}") for i in range(500)]
    return links, spark.createDataFrame(links, "source string, target string")


@pytest.mark.parametrize("asked", [1, 3, 60])
def test_partitions_that_were_asked_for_are_cut_when_they_are_too_large(spark, monkeypatch, asked):
    links, edges = some_links(spark)
    assert lay_out(edges, weight="raw", num_partitions=asked).partitions == asked
    monkeypatch.setattr(ranking, "PARTITION_ROWS", 10)
    laid = lay_out(edges, weight="raw", num_partitions=asked)
    assert laid.partitions == {1: 50, 3: 51, 60: 60}[asked] == laid.cold.rdd.getNumPartitions()
    ranks = pagerank(edges, weight="raw", iters=3, num_partitions=asked, cache=False)
    assert_ranks(ranks, brute_force(links, "raw", 3))


def test_a_task_holds_a_million_links(spark):
    """Some 500 bytes each are held at once: 10 million were more than a task may take."""
    _, edges = some_links(spark)
    for total in (72_000_000, 432_000_000):
        many = ranking.Profile({0: total}, "")
        assert total / ranking._partitions_for(edges, many) <= 1_000_000


def test_a_single_step_keeps_no_links_in_memory(spark, monkeypatch):
    links, edges = some_links(spark)
    kept, persist = [], type(edges).persist
    monkeypatch.setattr(type(edges), "persist", lambda df, level: kept.append(1) or persist(df, level))
    assert_ranks(pagerank(edges, weight="raw", iters=1), brute_force(links, "raw", 1))
    assert not kept
    pagerank(edges, weight="raw", iters=2)
    assert kept
