"""Ranks to the last digit, layouts that outlive a run, and executors that do not."""

import os
import subprocess
import sys
from decimal import Decimal
from fractions import Fraction
from pathlib import Path

import pytest
from conftest import DATA, ROOT
from pyspark.sql import functions as F

from tidemill.operators import ranking
from tidemill.operators.ranking import LINK, lay_out, open_layout, pagerank, rank_step, save_layout
from tidemill.plans.queries import QUERIES, supply_graph
from tidemill.session import new_folder


@pytest.fixture(scope="module")
def edges(spark):
    links = spark.range(4000).select(
        F.concat(F.lit("p"), F.pmod(F.xxhash64("id"), F.lit(97))).alias("source"),
        F.concat(F.lit("p"), F.pmod(F.xxhash64(F.col("id") + 1), F.lit(89))).alias("target"),
    )
    hub = spark.range(600).select(F.lit("hub").alias("source"), F.concat(F.lit("p"), F.col("id") % 50).alias("target"))
    return links.unionAll(hub)


def by_fractions(pairs, weight, iters):
    out = {}
    for s, t in pairs:
        out.setdefault(s, []).append(t)
    ranks = {s: Fraction(1) for s in out}
    for _ in range(iters):
        sums = {}
        for s, targets in out.items():
            for t in targets:
                sums.setdefault(t, Fraction(0))
                if s in ranks:
                    sums[t] += ranks[s] / (1 if weight == "raw" else len(targets))
        ranks = {t: Fraction(15, 100) + Fraction(85, 100) * x for t, x in sums.items()}
    return ranks


def exact(ranks):
    return {r["source"]: r["rank"] for r in ranks.collect()}


@pytest.mark.parametrize("weight", ["raw", "out_degree"])
def test_exact_ranks_are_equal_whatever_the_partitions(spark, edges, weight):
    found = [
        exact(pagerank(e, weight=weight, iters=3, num_partitions=n, heavy_rows=h, exact=True))
        for e, n, h in ((edges, 3, 10**6), (edges.repartition(11), 8, 10**6), (edges.repartition(2, "target"), 16, 1))
    ]
    assert found[0] == found[1] == found[2]
    assert all(isinstance(r, Decimal) for r in found[0].values())
    expected = by_fractions([tuple(r) for r in edges.collect()], weight, 3)
    assert set(expected) == set(found[0])
    allowed = Fraction(0) if weight == "raw" else Fraction(1, 10**8)
    assert all(abs(Fraction(found[0][s]) - r) <= allowed for s, r in expected.items())


def test_exact_ranks_are_equal_after_a_restart(spark, edges):
    snapshots = new_folder(spark, "test-snapshots")
    options = {"weight": "out_degree", "exact": True, "snapshot_dir": snapshots}
    pagerank(edges, iters=2, num_partitions=4, **options)
    resumed = pagerank(edges.repartition(9), iters=4, num_partitions=7, **options)
    assert exact(resumed) == exact(pagerank(edges, weight="out_degree", iters=4, exact=True))


def test_exact_ranks_too_large_for_their_digits_are_an_error(spark):
    many = spark.range(2000).select(F.lit("a").alias("source"), F.lit("a").alias("target"))
    assert exact(pagerank(many, weight="raw", iters=4, exact=True))["a"] > 10**12
    with pytest.raises(Exception, match="(?i)overflow|out of range|precision|NUMERIC_VALUE"):
        exact(pagerank(many, weight="raw", iters=7, exact=True))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("heavy_rows", [10**6, 1])
def test_a_kept_layout_is_joined_without_an_exchange_of_links(spark, edges, heavy_rows, monkeypatch):
    snapshots = new_folder(spark, "test-snapshots")
    options = {"weight": "raw", "num_partitions": 16, "heavy_rows": heavy_rows, "snapshot_dir": snapshots}
    plain = pagerank(edges, weight="raw", iters=3)
    first = pagerank(edges, iters=1, **options)
    opened = []
    monkeypatch.setattr(ranking, "lay_out", lambda *a, **k: pytest.fail("laid out again"))
    monkeypatch.setattr(ranking, "open_layout", lambda *a: opened.append(open_layout(*a)) or opened[-1])
    second = pagerank(edges, iters=3, **options)
    (links,) = opened
    assert all("Exchange" not in plan_of(part) for part in links.parts())
    assert (links.spread is None) == (heavy_rows > 1)
    if links.spread is None:
        limit = "spark.sql.autoBroadcastJoinThreshold"
        usual = spark.conf.get(limit)
        spark.conf.set(limit, "-1")  # as with ranks too many to broadcast
        try:
            with ranking.shuffling_into(spark, 16):
                step = plan_of(rank_step(links, first))
        finally:
            spark.conf.set(limit, usual)
        assert step.count("Exchange hashpartitioning") == 2  # ranks to the links, sums to targets
        assert "SortMergeJoin" in step and "Bucketed: true" in step
    assert {r["source"]: round(r["rank"], 6) for r in second.collect()} == {
        r["source"]: round(r["rank"], 6) for r in plain.collect()
    }


def test_a_layout_that_was_not_announced_is_not_opened(spark, edges):
    folder = new_folder(spark, "test-layout")
    assert open_layout(spark, folder, LINK) is None
    links = lay_out(edges, weight="raw", num_partitions=3)
    kept = save_layout(links, folder)
    again = open_layout(spark, folder, LINK)
    rows = [sorted(map(tuple, x.cold.collect())) for x in (kept, again)]
    assert rows[0] == rows[1] and again.partitions == 3


SCRIPT = """
import glob, os, signal, sys
root, work, home = sys.argv[1:]
sys.path.insert(0, root)
from pyspark import TaskContext
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
spark = (SparkSession.builder.master("local-cluster[2,1,1024]")
    .config("spark.executor.memory", "700m").config("spark.ui.enabled", "false")
    .config("spark.driver.host", "127.0.0.1").config("spark.sql.shuffle.partitions", "4")
    .config("spark.checkpoint.dir", work + "/shared").config("spark.sql.warehouse.dir", work + "/warehouse")
    .config("spark.local.dir", work + "/local").config("spark.task.maxFailures", "8").getOrCreate())
spark.sparkContext.setLogLevel("OFF")
from tidemill.operators import ranking
edges = spark.range(3000).select(
    F.concat(F.lit("p"), F.pmod(F.xxhash64("id"), F.lit(97))).alias("source"),
    F.concat(F.lit("p"), F.pmod(F.xxhash64(F.col("id") + 1), F.lit(89))).alias("target"))
options = dict(weight="out_degree", iters=8, exact=True)
calm = sorted(map(tuple, ranking.pagerank(edges, **options).collect()))

def fault(step):
    def run(batches):
        marker = f"{work}/lost-{step}"
        if TaskContext.get().partitionId() == 0 and not os.path.exists(marker):
            open(marker, "w").close()
            pid = os.getppid()
            while "java" not in open(f"/proc/{pid}/comm").read():
                pid = int(open(f"/proc/{pid}/stat").read().rpartition(")")[2].split()[1])
            os.kill(pid, signal.SIGKILL)  # the executor, with its shuffle files and cached links
        yield from batches
    return run

plain, steps = ranking._next_ranks, iter(range(1, 99))
def faulty(*args):
    ranks, step = plain(*args), next(steps)
    return ranks.mapInArrow(fault(step), ranks.schema) if step in (2, 6) else ranks
ranking._next_ranks = faulty
stormy = sorted(map(tuple, ranking.pagerank(edges, **options).collect()))
lost = sorted(map(os.path.basename, glob.glob(work + "/lost-*")))
print("RESULT", calm == stormy, len(calm), lost)
spark.stop()
"""


def test_ranks_are_equal_when_executors_are_lost(tmp_path):
    """Two executors; one is killed a quarter through the run, another at three quarters."""
    import pyspark

    home = tmp_path / "home"
    (home / "work").mkdir(parents=True)
    for path in Path(pyspark.__file__).parent.iterdir():  # Spark's own, with another place for logs
        if path.name != "work":
            (home / path.name).symlink_to(path)
    env = {**os.environ, "SPARK_HOME": str(home), "SPARK_SCALA_VERSION": "2.13", "SPARK_LOCAL_IP": "127.0.0.1"}
    env |= {"PYSPARK_PYTHON": sys.executable, "PYTHONPATH": str(ROOT)}
    (tmp_path / "script.py").write_text(SCRIPT)
    run = subprocess.run(
        [sys.executable, str(tmp_path / "script.py"), str(ROOT), str(tmp_path), str(home)],
        env=env, capture_output=True, text=True, timeout=400,
    )
    result = [line for line in run.stdout.splitlines() if line.startswith("RESULT")]
    assert result == ["RESULT True 89 ['lost-2', 'lost-6']"], run.stdout[-2000:] + run.stderr[-3000:]


def test_the_exact_query_uses_as_many_tasks_as_its_links_need(spark, monkeypatch):
    laid, profiled, lay, profile = [], [], ranking.lay_out, ranking.profile_links
    monkeypatch.setattr(ranking, "PARTITION_ROWS", 1000)
    monkeypatch.setattr(ranking, "lay_out", lambda *a, **k: laid.append(lay(*a, **k)) or laid[-1])
    monkeypatch.setattr(ranking, "profile_links", lambda e: profiled.append(plan_of(e)) or profile(e))
    folder = f"{DATA}/sf0.001"
    ranks = exact(QUERIES["pagerank_exact"](spark, folder))
    total = supply_graph(spark, folder).count()
    assert [links.partitions % n for links, n in zip(laid, (5, 3), strict=True)] == [0, 0]
    assert all(total / links.partitions <= 1000 for links in laid)
    # neither a fixed number of tasks nor a sort of all that a task sends
    assert not any("RoundRobin" in text for text in profiled)
    assert {s: float(r) for s, r in ranks.items()} == pytest.approx(
        {r["source"]: r["rank"] for r in pagerank(supply_graph(spark, folder), weight="raw", iters=3).collect()}
    )


def test_exact_links_that_come_often_or_share_are_still_divided(spark):
    pairs = [("a", "b")] * 3 + [("a", "c"), ("b", "a"), ("c", "a"), ("c", "b")]
    edges = spark.createDataFrame(pairs, "source string, target string")
    for weight, allowed in (("raw", 0), ("out_degree", Fraction(1, 10**8))):
        found = exact(pagerank(edges, weight=weight, iters=3, exact=True))
        expected = by_fractions(pairs, weight, 3)
        assert all(abs(Fraction(found[s]) - r) <= allowed for s, r in expected.items())
