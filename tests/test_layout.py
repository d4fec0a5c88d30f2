import os
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemill.functions.permute import halves, permuted
from tidemill.operators.fitting import (
    BLOCK,
    gather_mean,
    partial_gradients,
    rank_means,
    sgd_fit,
    step_mean,
)
from tidemill.operators.sampling import epoch_order, number_rows
from tidemill.session import new_folder
from tidemill.sources.layout import open_layout, plan_ranges, write_layout
from tidemill.sources.runlog import read_log, segment_from, start_log, write_segment
from tidemill.sources.snapshots import freeze, latest_step
from tidemill.sources.state import State, load_state

ROWS = "rank int, batch_idx long, features array<double>, label int"
RUN = {"epochs": 2, "stop_iter": None, "nodes": 1, "batch_size": 8}


# ---- layout


def test_ranges_hold_what_they_may():
    ranges = plan_ranges([(b, 10) for b in range(100)], 8, range_bytes=800, part_bytes=400)
    assert [(r.first_batch, r.last_batch) for r in ranges] == [(i, i + 9) for i in range(0, 100, 10)]
    assert {(r.rows, r.bytes, r.parts) for r in ranges} == {(100, 800, 2)}
    big = plan_ranges([(0, 1), (2, 1000), (3, 1), (4, 1)], 10, range_bytes=50, part_bytes=3000)
    assert [(r.first_batch, r.last_batch, r.parts) for r in big] == [(0, 0, 1), (2, 2, 4), (3, 4, 1)]
    assert plan_ranges([], 8) == []


def test_a_step_opens_its_own_range_alone(spark):
    """Ten thousand batches in two hundred ranges."""
    rows = spark.range(20_000).select(
        F.lit(0).alias("rank"), (F.col("id") % 10_000).alias("batch_idx"), "id"
    )
    path = new_folder(spark, "test-layout")
    layout = write_layout(rows, path, row_bytes=10, range_bytes=1000)
    assert layout.batches == 10_000 and len(layout.ranges) == 200
    again = open_layout(spark, path, rows.schema)
    assert again.ranges == layout.ranges
    for batch in (0, 4999, 5000, 9999):
        found = again.batch(batch)
        assert sorted(r["id"] for r in found.collect()) == [batch, batch + 10_000]
        folders = {os.path.dirname(f) for f in found.inputFiles()}
        assert [os.path.basename(f) for f in folders] == [f"batch_range={batch // 50}"]
        assert len(found.inputFiles()) == 1
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "EqualTo(batch_idx," in plan  # pushed into the file as well
    assert again.batch(10_000).count() == 0 and again.range_of(-1) is None


def test_a_large_batch_is_cut_in_parts_and_equal_rows_are_spread(spark):
    rows = spark.range(4000).select(
        F.lit(0).alias("rank"), F.lit(3).cast("long").alias("batch_idx"), F.col("id").alias("pos_in_rank"), F.lit(1).alias("same")
    )
    layout = write_layout(rows, new_folder(spark, "test-layout"), row_bytes=100, range_bytes=1000, part_bytes=50_000)
    assert layout.ranges[0].parts == 8 and layout.batches == 4
    assert layout.batch(3).count() == 4000 and layout.batch(1).count() == 0
    sizes = [r["count"] for r in layout.batch(3).groupBy(F.input_file_name()).count().collect()]
    assert len(sizes) > 3 and max(sizes) < 2000


def test_rows_without_a_batch_are_left_out(spark):
    rows = spark.createDataFrame([(0, None), (0, 1), (1, 1)], "rank int, batch_idx long")
    layout = write_layout(rows, new_folder(spark, "test-layout"), row_bytes=8)
    assert layout.batch(1).count() == 2 and layout.batches == 2
    assert write_layout(rows.limit(0), new_folder(spark, "test-layout"), row_bytes=8).batches == 0


# ---- log and state in one commit


class Died(Exception):
    pass


def test_a_fit_that_dies_between_log_and_state_has_no_row_twice(spark):
    rng = np.random.default_rng(2)
    rows = [(0, i // 10, rng.normal(size=3).tolist(), i % 2) for i in range(40)]
    shards = spark.createDataFrame(rows, ROWS)
    states, runs = new_folder(spark, "test-state"), new_folder(spark, "test-runs")

    def write(part, segment, anew):
        if anew:
            start_log(spark, runs, **RUN)
        write_segment(part, runs, segment, **RUN)

    def die(part, segment, anew):
        write(part, segment, anew)
        if segment == segment_from(4):
            raise Died

    options = {"epochs": 2, "checkpoint_roots": [states], "save_every": 2}
    with pytest.raises(Died):
        sgd_fit(shards, 2, 3, write_segment=die, **options)
    assert latest_step(spark, states) == 4
    assert read_log(spark, runs).count() == 6  # two rows of them are not committed
    named = load_state(spark, [states], 2).segments
    assert named == [segment_from(0), segment_from(2)]
    assert read_log(spark, runs, segments=named).count() == 4

    # it goes on, saving at other steps than it would have
    state, _ = sgd_fit(shards, 2, 3, write_segment=write, **{**options, "save_every": 3})
    named = load_state(spark, [states], 2).segments
    for log in (read_log(spark, runs), read_log(spark, runs, segments=named)):
        assert sorted((r["epoch"], r["iteration"]) for r in log.collect()) == [
            (e, i) for e in (0, 1) for i in (1, 2, 3, 4)
        ]
    whole, _ = sgd_fit(shards, 2, 3, epochs=2)
    assert np.array_equal(State.from_table(whole, 2).weights, State.from_table(state, 2).weights)


def test_a_run_over_all_batches_can_be_read_among_others(spark):
    root = new_folder(spark, "test-runs")
    row = spark.createDataFrame([(0, 1, 0.5)], "epoch int, iteration int, elapsed_time double")
    for stop_iter in (None, 40):
        start_log(spark, root, **{**RUN, "stop_iter": stop_iter})
        write_segment(row, root, segment_from(0), **{**RUN, "stop_iter": stop_iter})
    assert sorted(r["stop_iter"] for r in read_log(spark, root).collect()) == [0, 40]


# ---- gradients in blocks


def test_blocks_of_many_tasks_and_ranks(spark):
    rng = np.random.default_rng(3)
    dim = 2 * BLOCK // 3 + 5  # three classes: over two blocks
    x, y = rng.normal(size=(24, dim)), rng.integers(0, 3, 24)
    rows = [(i % 3, x[i].tolist(), int(y[i])) for i in range(24)]
    table = spark.createDataFrame(rows, "rank int, features array<double>, label int")
    partials = partial_gradients(table.repartition(8), np.zeros((3, dim)))
    assert {r["block"] for r in partials.select("block").collect()} == {0, 1, 2}
    one = {r["pos"]: r["value"] for r in gather_mean(rank_means(partials)).collect()}
    blocks = sorted(step_mean(partials).collect(), key=lambda r: r["block"])
    two = np.concatenate([r["numbers"] for r in blocks])
    error = np.full((24, 3), 1 / 3)
    error[np.arange(24), y] -= 1
    parts = [error[k::3].T @ x[k::3] / 8 for k in range(3)]
    expected = np.concatenate(([np.log(3)], np.mean(parts, axis=0).ravel()))
    assert len(one) == len(two) == len(expected)
    assert np.allclose([one[i] for i in range(len(expected))], expected)
    assert np.allclose(two, expected)


def test_sums_do_not_depend_on_the_order_of_partials(spark):
    rng = np.random.default_rng(3)
    rows = [(0, rng.normal(size=5).tolist(), int(i % 3)) for i in range(64)]
    table = spark.createDataFrame(rows, "rank int, features array<double>, label int")
    partials = partial_gradients(table.repartition(16), np.zeros((3, 5))).cache()
    found = [
        step_mean(partials.repartition(n)).collect()[0]["numbers"] for n in (1, 3, 7)
    ]
    assert found[0] == found[1] == found[2]
    partials.unpersist()


def test_a_model_a_million_wide(spark):
    wide = 1_000_000
    rows = spark.range(4).select(
        F.lit(0).alias("rank"),
        F.lit(0).cast("long").alias("batch_idx"),
        F.array_repeat(F.col("id") + 1.0, wide).alias("features"),
        (F.col("id") % 2).cast("int").alias("label"),
    )
    state, log = sgd_fit(rows, 2, wide, bias=False)
    fitted = State.from_table(state, 2)
    # softmax at zero weights: halves; class 0 has rows 1 and 3, class 1 rows 2 and 4
    expected = -0.1 * np.array([[(0.5 * 10 - 4) / 4], [(0.5 * 10 - 6) / 4]])
    assert fitted.weights.shape == (2, wide) and np.allclose(fitted.weights, expected)
    assert log.first()["loss"] == pytest.approx(np.log(2))


# ---- order without sorting


@pytest.mark.parametrize("total", [1, 2, 3, 5, 10, 64, 65, 1000, 4097])
def test_every_place_is_taken_once(total):
    for epoch in range(4):
        found = permuted(np.arange(total), total, 7, epoch)
        assert sorted(found.tolist()) == list(range(total))
    first, second = halves(total)
    assert 0 <= first * second - total < first


def test_large_totals_stay_in_range():
    total = 10**15 + 7
    found = permuted(np.arange(0, 10**15, 10**11), total, 1, 1)
    assert found.min() >= 0 and found.max() < total and len(set(found.tolist())) == len(found)


def test_orders_look_random():
    """Neighbours end up far apart, and a row's places in 400 epochs spread evenly."""
    n = 5000
    found = permuted(np.arange(n), n, 1, 0)
    assert np.abs(np.diff(found)).mean() == pytest.approx(n / 3, rel=0.05)
    assert abs(np.corrcoef(np.arange(n), found)[0, 1]) < 0.05
    places = np.array([permuted(np.array([0, 1, 4321]), n, 1, e) for e in range(400)])
    quarters = [Counter((places[:, k] * 4 // n).tolist()) for k in range(3)]
    assert all(60 < q[i] < 140 for q in quarters for i in range(4))


def test_an_epoch_is_an_order_of_the_numbered_rows(spark):
    ids = spark.range(500)
    numbered, total = number_rows(ids, "id", 3)
    assert sorted(r["row_number"] for r in numbered.collect()) == list(range(500)) and total == 500
    orders = [
        {r["id"]: r["pos_in_rank"] for r in epoch_order(numbered, total, 3, e).collect()} for e in (0, 1)
    ]
    assert orders[0] != orders[1] and all(sorted(o.values()) == list(range(500)) for o in orders)
    first = epoch_order(numbered, total, 3, 1, rows=20).collect()
    assert {r["id"]: r["pos_in_rank"] for r in first} == {i: p for i, p in orders[1].items() if p < 20}
    frozen = freeze(numbered, "test-numbered")
    plan = epoch_order(frozen, total, 3, 1)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan


def test_ties_go_the_same_way_however_many_they_are(spark):
    """Copies of an id that differ in another column get the same numbers on both paths."""
    rows = spark.range(300).select((F.col("id") % 3).alias("id"), F.col("id").alias("other"))
    few, _ = number_rows(rows, "id", 5)
    many, _ = number_rows(rows.repartition(7), "id", 5, hot_rows=10)
    assert sorted(map(tuple, few.collect())) == sorted(map(tuple, many.collect()))
