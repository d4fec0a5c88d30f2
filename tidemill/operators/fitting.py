"""Synchronous data-parallel SGD of a linear softmax classifier.

Each step is one Spark job over the rows of one batch. A task adds up the
gradient of its rows, Spark averages over rows and then over ranks, and the
driver sees ``classes * width`` numbers, whatever the size of the batch. Numbers travel
in blocks, so that a wide model is added up by many tasks and never a row a number.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.functions.batches import class_labels, equal_rows
from tidemill.session import new_folder
from tidemill.sources.layout import BatchLayout, write_layout
from tidemill.sources.runlog import segment_from
from tidemill.sources.snapshots import drop_frozen
from tidemill.sources.state import State, load_state, save_state

LEARNING_RATE = 0.1
MOMENTUM = 0.9
WEIGHT_DECAY = 1e-4
STOP_ITER = 40
BLOCK = 4096  # numbers in a block
FAN_IN = 64  # tasks whose blocks are added up at once
PARTIAL = "rank int, block int, part int, n long, numbers array<double>"
MEANS = "rank int, block int, numbers array<double>"
FIT_LOG = "epoch int, iteration long, elapsed_time double, loss double"


def score(
    df: DataFrame,
    weights: np.ndarray,
    *,
    bias: bool = False,
    features: str = "features",
    scores: str = "scores",
) -> DataFrame:
    """Adds the class scores ``W x (+ b)``; with ``bias`` the last column is b."""
    matrix = np.asarray(weights, dtype=np.float64)

    @F.arrow_udf("array<double>")
    def linear(rows):
        import numpy as np
        import pyarrow as pa

        classes, width = matrix.shape
        dim = width - bias
        x = equal_rows(rows, dim, "features").astype(np.float64)
        z = x.reshape(len(rows), dim) @ matrix[:, :dim].T
        if bias:
            z += matrix[:, dim]
        ends = np.arange(len(rows) + 1, dtype=np.int32) * classes
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(z.ravel()))

    return df.withColumn(scores, linear(F.col(features)))


def partial_gradients(rows: DataFrame, weights: np.ndarray, *, bias: bool = False) -> DataFrame:
    """Summed loss and gradient of the rows each task holds, per rank.

    ``rows`` has ``rank``, ``features`` and ``label``; a task returns the blocks of each
    rank it holds rows of: the loss, then the gradient row by row, ``BLOCK`` numbers each.
    ``part`` is the same for ``FAN_IN`` tasks in a row.
    """
    matrix = np.asarray(weights, dtype=np.float64)

    def add_up(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        width = matrix.shape[1]
        dim = width - bias
        sums = {}
        for batch in batches:
            count = batch.num_rows
            if count == 0:
                continue
            x = equal_rows(batch.column(1), dim, "features").astype(np.float64)
            x = x.reshape(count, dim)
            if bias:
                x = np.hstack([x, np.ones((count, 1))])
            label = class_labels(batch.column(2), matrix.shape[0])
            rank = batch.column(0).to_numpy(zero_copy_only=False)
            order = np.argsort(rank, kind="stable")
            x, label, rank = x[order], label[order], rank[order]
            z = x @ matrix.T
            z -= z.max(axis=1, keepdims=True)
            e = np.exp(z)
            total = e.sum(axis=1, keepdims=True)
            row = np.arange(count)
            loss = np.log(total[:, 0]) - z[row, label]
            error = e / total
            error[row, label] -= 1.0
            starts = np.flatnonzero(np.r_[True, rank[1:] != rank[:-1]])
            losses = np.add.reduceat(loss, starts)
            for r, start, end, summed in zip(
                rank[starts].tolist(), starts, [*starts[1:], count], losses, strict=True
            ):
                old = sums.get(r, (0, 0.0, 0.0))
                gradient = error[start:end].T @ x[start:end]
                sums[r] = (old[0] + int(end - start), old[1] + float(summed), old[2] + gradient)
        part = TaskContext.get().partitionId() // FAN_IN
        for r, (n, loss, gradient) in sums.items():
            numbers = np.concatenate(([loss], gradient.ravel()))
            ends = [*range(0, len(numbers), BLOCK), len(numbers)]
            blocks = len(ends) - 1
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([r] * blocks, pa.int32()),
                    pa.array(range(blocks), pa.int32()),
                    pa.array([part] * blocks, pa.int32()),
                    pa.array([n] * blocks, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(numbers)),
                ],
                names=["rank", "block", "part", "n", "numbers"],
            )

    columns = rows.select(F.col("rank").cast("int"), "features", F.col("label").cast("int"))
    return columns.mapInArrow(add_up, PARTIAL)


def _summed(rows):
    """The blocks of one group, number by number, whatever order they came in."""
    import numpy as np

    values = rows["numbers"].combine_chunks()
    width = len(values[0].values)
    return np.sort(values.flatten().to_numpy().reshape(-1, width), axis=0).sum(axis=0)


def _block_row(types: str, *values):
    """A table of one row; the last value is the block's numbers."""
    import pyarrow as pa

    kinds = {"int": pa.int32(), "long": pa.int64(), "array<double>": pa.list_(pa.float64())}
    fields = [field.split() for field in types.split(", ")]
    return pa.table({n: pa.array([v], kinds[k]) for (n, k), v in zip(fields, values, strict=True)})


def _fewer(partials: DataFrame, tasks: int | None) -> DataFrame:
    """First level of adding up: one row for ``FAN_IN`` tasks. None if so few take part."""
    if tasks is not None and tasks <= FAN_IN:
        return partials

    def add(key, rows):
        n = sum(rows["n"].to_pylist())
        return _block_row(PARTIAL, *(k.as_py() for k in key), n, _summed(rows))

    return partials.groupBy("rank", "block", "part").applyInArrow(add, PARTIAL)


def rank_means(partials: DataFrame, *, tasks: int | None = None) -> DataFrame:
    """Each rank's own batch mean in blocks, ``(rank, block, numbers)``: the loss, then the
    gradient row by row. ``tasks`` is how many gave partials, if that is known."""

    def mean(key, rows):
        n = sum(rows["n"].to_pylist())
        return _block_row(MEANS, *(k.as_py() for k in key), _summed(rows) / n)

    return _fewer(partials, tasks).groupBy("rank", "block").applyInArrow(mean, MEANS)


def _numbers(blocks: DataFrame) -> DataFrame:
    """One number a row, ``(pos, value)``, of blocks."""
    start = F.col("block").cast("long") * BLOCK
    exploded = blocks.select(start.alias("start"), F.posexplode("numbers").alias("at", "value"))
    return exploded.select((F.col("start") + F.col("at")).alias("pos"), "value")


def gather_mean(means: DataFrame) -> DataFrame:
    """Mean over ranks, as when one rank gathers, adds up, divides and scatters: ``(pos,
    value)``, position 0 being the loss."""

    def mean(key, rows):
        return _block_row(MEANS, 0, key[0].as_py(), _summed(rows) / rows.num_rows)

    return _numbers(means.groupBy("block").applyInArrow(mean, MEANS))


def allreduce_mean(means: DataFrame, world: int) -> DataFrame:
    """Mean over ranks, as when every rank divides by their number and all add up."""

    def add(key, rows):
        return _block_row(MEANS, 0, key[0].as_py(), _summed(rows))

    divided = means.withColumn("numbers", F.transform("numbers", lambda x: x / world))
    return _numbers(divided.groupBy("block").applyInArrow(add, MEANS))


def step_mean(partials: DataFrame, *, tasks: int | None = None) -> DataFrame:
    """The mean over ranks of their batch means, in blocks: ``rank_means`` and
    ``gather_mean`` in one exchange."""

    def mean(key, rows):
        ranks = rows["rank"].to_numpy()
        total = 0.0
        for rank in sorted(set(ranks.tolist())):
            own = rows.filter(ranks == rank)
            total = total + _summed(own) / sum(own["n"].to_pylist())
        return _block_row(MEANS, 0, key[0].as_py(), total / len(set(ranks.tolist())))

    return _fewer(partials, tasks).groupBy("block").applyInArrow(mean, MEANS)


def sgd_update(
    state: State,
    gradient: np.ndarray,
    *,
    lr: float = LEARNING_RATE,
    momentum: float = MOMENTUM,
    weight_decay: float = WEIGHT_DECAY,
) -> State:
    velocity = momentum * state.momentum + gradient + weight_decay * state.weights
    return State(state.step + 1, state.weights - lr * velocity, velocity, state.segments)


def sgd_fit(
    shards: DataFrame | Callable[[int], DataFrame],
    classes: int,
    dim: int,
    *,
    lr: float = LEARNING_RATE,
    momentum: float = MOMENTUM,
    weight_decay: float = WEIGHT_DECAY,
    bias: bool = True,
    epochs: int = 1,
    stop_iter: int | None = None,
    prepare: Callable[[DataFrame, int], DataFrame] | None = None,
    checkpoint_roots: Sequence[str] = (),
    save_every: int | None = None,
    should_stop: Callable[[int], bool] | None = None,
    on_log: Callable[[DataFrame, bool], None] | None = None,
    write_segment: Callable[[DataFrame, str, bool], None] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Fits ``shards`` (``rank, batch_idx, features, label``) from zero weights.

    Shards given as a function of the epoch are laid out anew for each. Each epoch takes
    all batches, or the first ``stop_iter``. ``prepare(rows, epoch)`` changes the
    rows of each batch when it is read, and may use their other columns.

    Returns the final state and a log with one row per step of this call. With
    ``checkpoint_roots`` the fit goes on from the first saved state it finds, and saves
    its own under the first root: every ``save_every`` steps, when it is told to stop
    and at the end. Before each saving ``on_log(rows, anew)`` gets the log of the
    steps since the last; ``anew`` says that they begin with the first step of all.
    ``write_segment(rows, name, anew)`` gets them under a name that depends on their first
    step alone; the state that is saved next names it, which commits both at once.
    ``should_stop(step)`` is asked after the gradient of step 0, 1, ... and before
    its update; on yes that step is dropped.
    """
    one_layout = isinstance(shards, DataFrame)
    spark = shards.sparkSession if one_layout else SparkSession.active()
    state = load_state(spark, checkpoint_roots, classes) or State.zero(classes, dim + bias)
    log, logged, saved = [], 0, state.step
    layout, laid_out, path = None, None, None

    def save() -> None:
        nonlocal logged, saved
        if logged < len(log) or not log:
            anew = logged == 0 and state.step == len(log)
            new = spark.createDataFrame(log[logged:], FIT_LOG)
            if write_segment is not None and (log or anew):
                name = segment_from(state.step - len(log) + logged)
                write_segment(new, name, anew)
                state.segments = [*(s for s in state.segments if s < name), name]
            if on_log is not None:
                on_log(new, anew)
        logged = len(log)
        if checkpoint_roots and state.step > saved:
            save_state(spark, checkpoint_roots[0], state)
            saved = state.step

    try:
        while True:
            batches = 0 if layout is None else layout.batches
            epoch = 0 if not batches else state.step // batches
            if layout is not None and state.step >= epochs * batches:
                break
            if layout is None or (laid_out != epoch and not one_layout):
                if path is not None:
                    drop_frozen(spark, path)
                path, first = new_folder(spark, "shards"), layout is None
                laid_out = epoch
                layout = _lay_out(shards if one_layout else shards(epoch), stop_iter, path, dim)
                if first:
                    continue
            started = time.perf_counter()
            batch_idx = state.step % batches
            batch = layout.batch(batch_idx)
            if prepare is not None:
                batch = prepare(batch, epoch)
            held = layout.range_of(batch_idx)
            partials = partial_gradients(batch, state.weights, bias=bias)
            if held is not None and held.parts == 1:
                partials = partials.coalesce(1)  # one file, one task: nothing to exchange
            means = step_mean(partials, tasks=None if held is None else held.parts).toArrow()
            numbers = np.zeros(1 + state.weights.size)  # as many numbers as the model has, and the loss
            for block, values in zip(means["block"].to_pylist(), means["numbers"], strict=True):
                found = values.values.to_numpy()
                numbers[block * BLOCK : block * BLOCK + len(found)] = found
            if should_stop is not None and should_stop(state.step):
                break
            gradient = numbers[1:].reshape(state.weights.shape)
            state = sgd_update(state, gradient, lr=lr, momentum=momentum, weight_decay=weight_decay)
            elapsed = time.perf_counter() - started
            log.append((epoch, batch_idx + 1, elapsed, float(numbers[0])))
            if save_every is not None and state.step % save_every == 0:
                save()
        save()
    finally:
        if path is not None:
            drop_frozen(spark, path)
    return state.table(spark), spark.createDataFrame(log, FIT_LOG)


def _lay_out(shards: DataFrame, stop_iter: int | None, path: str, dim: int) -> BatchLayout:
    """Writes the shards in the order of their batches, so that a step reads its own."""
    used = shards if stop_iter is None else shards.where(F.col("batch_idx") < stop_iter)
    return write_layout(used, path, row_bytes=8 * dim + 64, keep=False)
