from pathlib import Path

import numpy as np
import pytest
from pyspark.errors import AnalysisException

from pyspark.sql import functions as F

from tidemill.__main__ import parse, stop_once
from tidemill.operators.progress import interval_rollup, phase_rollup
from tidemill.plans.jobs import fit_job, fit_progress, rank_job, sort_job
from tidemill.session import new_folder, shared_folder
from tidemill.sources.files import read_csv
from tidemill.sources.runlog import append_log, read_log, start_log
from tidemill.sources.state import State


@pytest.fixture
def links(tmp_path):
    (tmp_path / "links").mkdir()
    (tmp_path / "links" / "a.txt").write_text("a b\nb c\n")
    (tmp_path / "links" / "b.txt").write_text("c b\n")
    return str(tmp_path / "links")


def left_behind(spark):
    folder = Path(shared_folder(spark).removeprefix("file://"))
    return {p.name for p in folder.iterdir()} if folder.is_dir() else set()


@pytest.mark.parametrize("options", [{}, {"num_partitions": 3}, {"cache": False}])
def test_rank_job(spark, links, tmp_path, options):
    out, before = str(tmp_path / "out"), left_behind(spark)
    log = rank_job(spark, links, out, weight="raw", iters=2, **options)
    assert [name for name, _ in log.rows] == ["read", "compute", "write"]
    assert left_behind(spark) == before
    back = read_csv(spark, out)
    assert back.columns == ["source", "rank"]
    assert {r["source"]: float(r["rank"]) for r in back.collect()} == pytest.approx(
        {"b": 1.0, "c": 0.85 * 1.85 + 0.15}
    )
    totals = phase_rollup(log.table(spark)).collect()
    total = next(r["seconds"] for r in totals if r["is_total"])
    assert total == pytest.approx(sum(s for _, s in log.rows))
    with pytest.raises(AnalysisException):
        rank_job(spark, links, out, weight="raw", iters=1)


def test_sort_job(spark, tmp_path):
    (tmp_path / "x.csv").write_text("cca2,timestamp,v\nb,1,x\na,2,y\na,10,z\n")
    out = sort_job(spark, str(tmp_path / "x.csv"), str(tmp_path / "out"), single_file=True)
    assert [r["v"] for r in out.collect()] == ["z", "y", "x"]


def test_fit_job(spark):
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(3, 5)) * 3
    rows = []
    for i in range(300):
        label = i % 3
        rows.append((i, (centres[label] + rng.normal(size=5)).tolist(), label))
    data = spark.createDataFrame(rows, "id long, features array<double>, label int")
    root, states, model = (new_folder(spark, f"test-{x}") for x in ("runs", "state", "model"))
    before = left_behind(spark)
    options = {"log_root": root, "checkpoint_roots": [states], "model_out": model}
    stopped = fit_job(
        data.where("id < 240"),
        data.where("id >= 240"),
        3,
        5,
        nodes=4,
        epochs=2,
        stop_iter=3,
        total_batch_size=64,
        should_stop=lambda step: step == 4,
        **options,
    )
    assert stopped[1].count() == 4
    state, log, result = fit_job(
        data.where("id < 240"),
        data.where("id >= 240"),
        3,
        5,
        nodes=4,
        epochs=2,
        stop_iter=3,
        total_batch_size=64,
        save_every=1,
        **options,
    )
    new = {name.rsplit("-", 1)[0] for name in left_behind(spark) - before}
    assert new == {"test-runs", "test-state", "test-model"}
    assert State.from_table(spark.read.parquet(model), 3).step == 6
    row = result.first()
    assert row["total"] == 60 and row["percent"] > 80 and row["batches"] == 4
    assert log.count() == 2
    written = read_log(spark, root).collect()
    assert {(r["epochs"], r["stop_iter"], r["nodes"], r["batch_size"]) for r in written} == {(2, 3, 4, 16)}
    assert sorted((r["epoch"], r["iteration"]) for r in written) == [
        (e, i) for e in (0, 1) for i in (1, 2, 3)
    ]


def test_a_new_run_starts_its_log_anew(spark):
    root = new_folder(spark, "test-runs")
    run = {"epochs": 1, "stop_iter": 2, "nodes": 1, "batch_size": 8}
    rows = spark.createDataFrame([(0, 1, 0.5)], "epoch int, iteration int, elapsed_time double")
    for _ in range(2):
        start_log(spark, root, **run)
        append_log(rows, root, **run)
        append_log(rows, root, **run)
    start_log(spark, root, **{**run, "nodes": 2})
    assert read_log(spark, root).count() == 2


def test_progress_reports_full_intervals_only(spark):
    log = [(e, i, 1.0 * i, 10.0 - i) for e in (0, 1) for i in range(1, 46)]
    df = spark.createDataFrame(log, "epoch int, iteration int, elapsed_time double, loss double")
    rows = interval_rollup(df, batch_size=64, ranks=4, total_rows=50000, steps=45)
    found = [tuple(r) for r in rows.orderBy("epoch", "iteration").collect()]
    per_epoch = [
        (20, 5120, 50000, pytest.approx(2000 / 45), -10.0, 210.0),
        (40, 10240, 50000, pytest.approx(4000 / 45), -30.0, 610.0),
    ]
    assert found == [(e, *row) for e in (0, 1) for row in per_epoch]


def test_progress_of_a_resumed_and_of_a_long_run(spark):
    schema = "epoch int, iteration long, elapsed_time double, loss double"
    resumed = spark.createDataFrame([(0, i, 1.0, 1.0) for i in range(26, 41)], schema)
    options = {"batch_size": 64, "ranks": 4, "total_rows": 50000, "steps": 45}
    row = interval_rollup(resumed, **options).collect()
    assert [(r["iteration"], r["interval_time"]) for r in row] == [(40, 15.0)]
    far = spark.createDataFrame([(0, 10_000_000, 1.0, 1.0)], schema)
    assert interval_rollup(far, **options).first()["rows_seen"] == 2_560_000_000
    two = resumed.withColumn("run", F.lit("a")).unionAll(resumed.withColumn("run", F.lit("b")))
    assert interval_rollup(two, by=["run"], **options).count() == 2


def test_images_are_fitted_augmented_and_scored_as_they_are(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.integers(0, 255, 48).astype(float).tolist(), i % 2) for i in range(60)]
    data = spark.createDataFrame(rows, "id long, features array<double>, label int")
    state, log, result = fit_job(data, data, 2, 48, epochs=2, total_batch_size=30, image_shape=(3, 4, 4))
    assert log.count() == 4 and result.first()["total"] == 60
    progress = fit_progress(log, nodes=1, total_batch_size=30, total_rows=60)
    assert progress.count() == 0


def test_a_file_stops_a_fit(spark, tmp_path):
    ask = stop_once(spark, str(tmp_path / "stop"))
    assert not ask(0)
    (tmp_path / "stop").write_text("")
    assert ask(1)


def test_an_unnamed_phase_is_not_the_total(spark):
    df = spark.createDataFrame([(None, 1.0), ("a", 2.0)], "phase string, seconds double")
    assert {tuple(r) for r in phase_rollup(df).collect()} == {(None, 0, 1.0), ("a", 0, 2.0), (None, 1, 3.0)}


def test_arguments():
    args = parse(["rank", "in", "out", "4", "--weight", "raw", "--no-cache"])
    assert (args.num_partitions, args.iters, args.cache) == (4, 10, False)
    args = parse(["fit", "in", "--dim", "64"])
    assert (args.num_nodes, args.epoch, args.stop_iter, args.total_batch_size) == (4, 1, 40, 256)
    with pytest.raises(SystemExit):
        parse(["rank", "in", "out"])


def test_a_cluster_must_name_its_shared_folder():
    class Context:
        master = "spark://host:7077"
        applicationId = "app"

        def getCheckpointDir(self):
            return None

    class Conf:
        def __init__(self, value):
            self.value = value

        def get(self, key, default):
            assert key == "spark.checkpoint.dir"
            return self.value

    class Session:
        sparkContext = Context()
        conf = Conf(None)

    with pytest.raises(ValueError):
        shared_folder(Session())
    Session.conf = Conf("hdfs://nn/shared/")
    assert shared_folder(Session()) == "hdfs://nn/shared"
