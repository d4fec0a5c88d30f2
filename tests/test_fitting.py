import numpy as np
import pytest
from conftest import DATA
from pyspark.sql import functions as F

from tidemill.functions.vectors import cross_entropy
from tidemill.operators.evaluation import accuracy, batch_mean_loss, evaluate, evaluate_in_order
from tidemill.operators.fitting import (
    allreduce_mean,
    gather_mean,
    partial_gradients,
    rank_means,
    score,
    sgd_fit,
)
from tidemill.operators.ordering import stored_position
from tidemill.operators.sampling import minibatch, shard_assign
from tidemill.session import new_folder
from tidemill.sources.snapshots import latest_step, publish
from tidemill.sources.state import State, load_state, save_state

CLASSES, DIM = 4, 6


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(4)
    return rng.normal(size=(90, DIM)), rng.integers(0, CLASSES, 90)


@pytest.fixture(scope="module")
def table(spark, data):
    rows = [(i, x.tolist(), int(y)) for i, (x, y) in enumerate(zip(*data, strict=True))]
    return spark.createDataFrame(rows, "id long, features array<double>, label int")


def batch_gradient(x, y, w):
    z = x @ w.T
    z -= z.max(axis=1, keepdims=True)
    p = np.exp(z)
    p /= p.sum(axis=1, keepdims=True)
    loss = -np.log(p[range(len(y)), y]).mean()
    p[range(len(y)), y] -= 1
    return loss, p.T @ x / len(y)


def numpy_fit(batches, bias, epochs):
    """``batches[t][rank]`` are (x, y)."""
    w = np.zeros((CLASSES, DIM + bias))
    v = np.zeros_like(w)
    losses = []
    for _ in range(epochs):
        for ranks in batches:
            parts = [
                batch_gradient(np.hstack([x, np.ones((len(x), bias))]), y, w) for x, y in ranks
            ]
            losses.append(np.mean([p[0] for p in parts]))
            v = 0.9 * v + np.mean([p[1] for p in parts], axis=0) + 1e-4 * w
            w = w - 0.1 * v
    return w, losses


def rank_batches(shards, data):
    x, y = data
    rows = shards.select("id", "rank", "batch_idx").collect()
    steps = max(r["batch_idx"] for r in rows) + 1
    ranks = max(r["rank"] for r in rows) + 1
    out = []
    for t in range(steps):
        ids = [[r["id"] for r in rows if (r["rank"], r["batch_idx"]) == (k, t)] for k in range(ranks)]
        out.append([(x[i], y[i]) for i in ids])
    return out


@pytest.mark.parametrize("world,size,bias", [(1, 90, False), (4, 10, True), (7, 5, True)])
def test_fit_matches_numpy(table, data, world, size, bias):
    shards = minibatch(shard_assign(table, "id", world, 1), size)
    state, log = sgd_fit(shards, CLASSES, DIM, bias=bias, epochs=2)
    expected, losses = numpy_fit(rank_batches(shards, data), int(bias), 2)
    fitted = State.from_table(state, CLASSES)
    assert np.allclose(fitted.weights, expected, atol=1e-12)
    assert fitted.step == len(losses)
    rows = log.orderBy("epoch", "iteration").collect()
    assert np.allclose([r["loss"] for r in rows], losses)
    assert all(r["elapsed_time"] > 0 for r in rows)


def test_golden_losses(spark):
    rows = spark.read.parquet(f"{DATA}/sf0.01/embeddings.parquet").select(
        F.col("embedding").alias("features"), "label", F.lit(0).alias("rank"), F.lit(0).alias("batch_idx")
    )
    state, log = sgd_fit(rows, 10, 64, bias=False, epochs=3)
    losses = [r["loss"] for r in log.orderBy("epoch").collect()]
    assert losses == pytest.approx([2.302585093, 2.302393200, 2.302028730], abs=1e-9)
    assert np.abs(State.from_table(state, 10).weights).max() == pytest.approx(0.003262336, abs=1e-9)


def test_both_ways_to_average_agree_over_unequal_ranks(table, data):
    """Every rank weighs the same, however many rows it has."""
    x, y = data
    ranked = table.withColumn("rank", F.when(F.col("id") < 10, 0).when(F.col("id") < 70, 1).otherwise(2))
    w = np.random.default_rng(0).normal(size=(CLASSES, DIM))
    means = rank_means(partial_gradients(ranked.repartition(5), w))
    one = {r["pos"]: r["value"] for r in gather_mean(means).collect()}
    two = {r["pos"]: r["value"] for r in allreduce_mean(means, 3).collect()}
    parts = [batch_gradient(x[a:b], y[a:b], w) for a, b in ((0, 10), (10, 70), (70, 90))]
    expected = [np.mean([p[0] for p in parts]), *np.mean([p[1] for p in parts], axis=0).ravel()]
    assert np.allclose([one[i] for i in range(len(expected))], expected)
    assert np.allclose([two[i] for i in range(len(expected))], expected)


def test_stop_iter_limits_an_epoch(table):
    shards = minibatch(shard_assign(table, "id", 3, 1), 5)
    _, log = sgd_fit(shards, CLASSES, DIM, epochs=2, stop_iter=2)
    assert sorted((r["epoch"], r["iteration"]) for r in log.collect()) == [(0, 1), (0, 2), (1, 1), (1, 2)]


def test_stop_drops_the_step_and_a_later_run_goes_on(spark, table):
    shards = minibatch(shard_assign(table, "id", 3, 1), 10)
    whole, _ = sgd_fit(shards, CLASSES, DIM, epochs=2)
    root = new_folder(spark, "test-state")
    stopped, log = sgd_fit(
        shards, CLASSES, DIM, epochs=2, checkpoint_roots=[root], should_stop=lambda step: step == 4
    )
    assert State.from_table(stopped, CLASSES).step == 4 and log.count() == 4
    resumed, log = sgd_fit(shards, CLASSES, DIM, epochs=2, checkpoint_roots=[root])
    a, b = State.from_table(whole, CLASSES), State.from_table(resumed, CLASSES)
    assert a.step == b.step == 6 and log.count() == 2
    assert np.allclose(a.weights, b.weights, atol=1e-15)
    assert np.allclose(a.momentum, b.momentum, atol=1e-15)


def test_state_falls_back_in_order_and_needs_both_parts(spark):
    own, half, peer, later = (new_folder(spark, "test-state") for _ in range(4))
    ones = State(3, np.ones((2, 3)), np.zeros((2, 3)))
    publish(ones.table(spark).where("name = 'weights'"), half, 9, ["weights"])
    save_state(spark, peer, ones)
    save_state(spark, later, State(8, np.ones((2, 3)) * 2, np.zeros((2, 3))))
    found = load_state(spark, [own, half, peer, later], 2)
    assert found.step == 3 and np.array_equal(found.weights, ones.weights)
    assert load_state(spark, [own, half], 2) is None
    assert load_state(spark, [], 2) is None


def test_newest_state_of_a_root(spark):
    root = new_folder(spark, "test-state")
    for step in (2, 10, 9):
        save_state(spark, root, State(step, np.full((1, 2), float(step)), np.zeros((1, 2))))
    assert load_state(spark, [root], 1).step == 10


def test_nothing_to_fit(spark):
    empty = spark.createDataFrame([], "rank int, batch_idx long, features array<double>, label int")
    state, log = sgd_fit(empty, CLASSES, DIM)
    assert State.from_table(state, CLASSES).step == 0 and log.count() == 0


def test_wrong_width_is_an_error(table):
    with pytest.raises(Exception, match="features"):
        score(table, np.zeros((CLASSES, DIM + 1))).collect()


@pytest.mark.parametrize("bias", [False, True])
def test_scores(table, data, bias):
    w = np.random.default_rng(1).normal(size=(CLASSES, DIM + bias))
    rows = score(table, w, bias=bias).orderBy("id").collect()
    expected = data[0] @ w[:, :DIM].T + (w[:, DIM] if bias else 0)
    assert np.allclose([r["scores"] for r in rows], expected)


def test_short_last_batch_weighs_as_much(table, data):
    x, y = data
    w = np.random.default_rng(1).normal(size=(CLASSES, DIM))
    scored = score(table, w).withColumn("pos", F.col("id"))
    losses = [batch_gradient(x[i : i + 40], y[i : i + 40], w)[0] for i in (0, 40, 80)]
    row = batch_mean_loss(scored, 40).first()
    assert row["loss"] == pytest.approx(np.mean(losses)) and row["batches"] == 3
    hits = int(((x @ w.T).argmax(axis=1) == y).sum())
    both = evaluate(scored, 40).first().asDict()
    assert both == {
        "loss": pytest.approx(np.mean(losses)),
        "batches": 3,
        "correct": hits,
        "total": 90,
        "percent": pytest.approx(hits / 0.9),
    }
    assert accuracy(scored).first().asDict() == {k: both[k] for k in ("correct", "total", "percent")}


@pytest.mark.parametrize("layout", ["in order", "inside batches", "out of order", "ties", "null"])
def test_batches_of_stored_rows_need_no_sort(spark, table, data, tmp_path, layout, monkeypatch):
    """Many files; a batch lies across two of them, rows out of order are sorted."""
    x, y = data
    w = np.random.default_rng(1).normal(size=(CLASSES, DIM))
    ids = {
        "in order": F.col("id"),
        "inside batches": F.expr("id - id % 40 + 39 - id % 40"),
        "out of order": 89 - F.col("id"),
        "ties": F.expr("id div 3"),
        "null": F.expr("if(id = 0, null, id)"),
    }[layout]
    rows = table.repartitionByRange(7, "id").sortWithinPartitions("id").withColumn("key", ids)
    rows.write.parquet(str(tmp_path / "rows"))
    stored = spark.read.parquet(str(tmp_path / "rows"))
    if layout.startswith("in"):
        monkeypatch.setattr("tidemill.operators.evaluation.global_position", None)
    found = evaluate_in_order(stored, "key", 40, lambda df: score(df, w)).first()
    order = np.arange(90)[::-1] if layout == "out of order" else np.arange(90)
    losses = [batch_gradient(x[order[i : i + 40]], y[order[i : i + 40]], w)[0] for i in (0, 40, 80)]
    assert found["batches"] == 3 and found["total"] == 90
    assert found["correct"] == int(((x @ w.T).argmax(axis=1) == y).sum())
    if layout != "ties":  # whose order is any
        assert found["loss"] == pytest.approx(np.mean(losses))


def test_stored_positions_are_read_off_the_scan(spark, table, tmp_path):
    rows = table.select("id").repartitionByRange(5, "id").sortWithinPartitions("id")
    rows.write.parquet(str(tmp_path / "rows"))
    placed = stored_position(spark.read.parquet(str(tmp_path / "rows")))
    assert placed.where("pos != id").isEmpty() and placed.count() == 90
    plan = placed._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and "hashpartitioning" not in plan and "rangepartitioning" not in plan
    empty = spark.createDataFrame([], "id long")
    empty.write.parquet(str(tmp_path / "none"))
    assert stored_position(spark.read.parquet(str(tmp_path / "none"))).count() == 0


def test_golden_evaluation(spark):
    scored = spark.read.parquet(f"{DATA}/sf0.01/embeddings.parquet").select(
        F.slice("embedding", 1, 10).cast("array<double>").alias("scores"),
        "label",
        F.col("vec_id").alias("pos"),
    )
    assert accuracy(scored).first()["correct"] == 53
    assert batch_mean_loss(scored, 500).first()["loss"] == pytest.approx(2.308489503, abs=1e-9)


def test_rows_of_unequal_width_never_mix(spark):
    """Three values and one are four, as two rows of two would be."""
    rows = spark.createDataFrame(
        [(0, [1.0, 2.0, 3.0], 0), (0, [4.0], 1)], "rank int, features array<double>, label int"
    ).coalesce(1)
    with pytest.raises(Exception, match="row 0 of its batch has 3"):
        score(rows, np.zeros((2, 2))).collect()
    with pytest.raises(Exception, match="row 0 of its batch has 3"):
        partial_gradients(rows, np.zeros((2, 2))).collect()
    nulls = spark.createDataFrame([(0, [1.0, None], 0)], rows.schema)
    with pytest.raises(Exception, match="null"):
        score(nulls, np.zeros((2, 2))).collect()


@pytest.mark.parametrize("label", [-2, -1, 2, None])
def test_a_label_that_is_no_class_is_an_error(spark, label):
    rows = spark.createDataFrame(
        [(0, [1.0, 2.0], label)], "rank int, features array<double>, label int"
    )
    with pytest.raises(Exception, match="label"):
        partial_gradients(rows, np.zeros((2, 2))).collect()
    loss = cross_entropy(F.col("features"), F.col("label"))
    if label is None:
        assert rows.select(loss.alias("loss")).first()["loss"] is None
    else:
        with pytest.raises(Exception, match="no class"):
            rows.select(loss).collect()


def test_a_finished_fit_is_not_fitted_again(spark, table):
    shards = minibatch(shard_assign(table, "id", 3, 1), 10)
    root, saved = new_folder(spark, "test-state"), []
    options = {"epochs": 2, "checkpoint_roots": [root], "save_every": 2}

    def on_log(rows, anew):
        saved.append((anew, [(r["epoch"], r["iteration"]) for r in rows.collect()]))

    first, log = sgd_fit(shards, CLASSES, DIM, on_log=on_log, **options)
    assert log.count() == 6 and latest_step(spark, root) == 6
    assert [anew for anew, _ in saved][0] and not any(anew for anew, _ in saved[1:])
    assert [x for _, rows in saved for x in rows] == [(e, i) for e in (0, 1) for i in (1, 2, 3)]
    again, log = sgd_fit(shards, CLASSES, DIM, **options)
    assert log.count() == 0
    assert np.array_equal(State.from_table(first, CLASSES).weights, State.from_table(again, CLASSES).weights)


def test_rows_are_prepared_anew_each_epoch(spark, table, data):
    shards = minibatch(shard_assign(table, "id", 1, 1), 90)
    x, y = data

    def prepare(rows, epoch):
        return rows.withColumn("features", F.transform("features", lambda v: v * F.lit(epoch + 1.0)))

    state, log = sgd_fit(shards, CLASSES, DIM, bias=False, epochs=2, prepare=prepare)
    expected, losses = numpy_fit([[(x, y)], [(2 * x, y)]], 0, 1)
    assert np.allclose(State.from_table(state, CLASSES).weights, expected)
    assert np.allclose([r["loss"] for r in log.orderBy("epoch").collect()], losses)


def test_shards_of_each_epoch(spark, table, data):
    def shards(epoch):
        return minibatch(shard_assign(table, "id", 1, 1, epoch=epoch), 45)

    state, _ = sgd_fit(shards, CLASSES, DIM, epochs=2)
    batches = rank_batches(shards(0), data) + rank_batches(shards(1), data)
    expected, _ = numpy_fit(batches, 1, 1)
    assert np.allclose(State.from_table(state, CLASSES).weights, expected)
