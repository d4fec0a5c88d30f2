"""The whole jobs, as a user would submit them."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.functions.hashing import keyed_md5
from tidemill.functions.pixels import Shape, eval_pixels, train_pixels
from tidemill.operators.evaluation import evaluate
from tidemill.operators.fitting import STOP_ITER, score, sgd_fit
from tidemill.operators.ordering import global_position, sort_csv
from tidemill.operators.progress import interval_rollup
from tidemill.operators.ranking import ITERATIONS, pagerank
from tidemill.operators.sampling import (
    epoch_order,
    minibatch,
    number_rows,
    rank_batch_size,
    shard_assign,
)
from tidemill.sources.files import write_csv
from tidemill.sources.links import read_edges
from tidemill.sources.runlog import start_log, write_segment
from tidemill.session import new_folder
from tidemill.sources.snapshots import drop_frozen, freeze
from tidemill.sources.state import State

PHASES = "phase string, seconds double"
SORT_KEYS = ("cca2", "timestamp")
SEED = 2021
SAVE_EVERY = 20  # steps from one saved state and log segment to the next
TOTAL_BATCH_SIZE = 256


class PhaseLog:
    """Seconds by phase of a job that runs on the driver's clock."""

    def __init__(self) -> None:
        self.rows: list[tuple[str, float]] = []

    @contextmanager
    def phase(self, name: str):
        started = time.perf_counter()
        yield
        self.rows.append((name, time.perf_counter() - started))

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows, PHASES)


def sort_job(
    spark: SparkSession,
    src: str,
    dst: str,
    *,
    keys: Sequence[str] = SORT_KEYS,
    single_file: bool = False,
) -> DataFrame:
    """Sorts a CSV folder by two keys into another, replacing what is there."""
    return sort_csv(spark, src, dst, keys, single_file=single_file)


def rank_job(
    spark: SparkSession,
    src: str,
    dst: str,
    *,
    weight: str,
    iters: int = ITERATIONS,
    num_partitions: int | None = None,
    cache: bool = True,
    snapshot_dir: str | None = None,
    phases: PhaseLog | None = None,
) -> PhaseLog:
    """Ranks the pages of a text link graph and writes ``source,rank`` as CSV.

    Fails if ``dst`` exists. Ranks are materialised before the compute phase
    ends, so that its seconds and those of the write phase mean what they say.
    """
    log = phases or PhaseLog()
    folders = [new_folder(spark, label) for label in ("edges", "ranks")]
    with log.phase("read"):
        # ranking reads the edges more than once; the text is parsed once
        edges = freeze(read_edges(spark, src), "edges", folders[0])
    with log.phase("compute"):
        ranks = pagerank(
            edges,
            weight=weight,
            iters=iters,
            num_partitions=num_partitions,
            cache=cache,
            snapshot_dir=snapshot_dir,
            result_path=folders[1],
        )
    with log.phase("write"):
        write_csv(ranks, dst)
    for folder in folders:
        drop_frozen(spark, folder)
    return log


def fit_job(
    train: DataFrame,
    test: DataFrame,
    classes: int,
    dim: int,
    *,
    nodes: int = 1,
    epochs: int = 1,
    stop_iter: int | None = STOP_ITER,
    total_batch_size: int = TOTAL_BATCH_SIZE,
    seed: int = SEED,
    image_shape: Shape | None = None,
    log_root: str | None = None,
    checkpoint_roots: Sequence[str] = (),
    save_every: int | None = SAVE_EVERY,
    should_stop: Callable[[int], bool] | None = None,
    model_out: str | None = None,
    on_log: Callable[[DataFrame, bool], None] | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Shards ``train``, fits it and scores ``test`` (both ``id, features, label``).

    Returns the state, the iteration log of this call and one row ``loss, batches,
    correct, total, percent``. A fit that was told to stop is scored as far as it got.
    One node takes its rows in a new order each epoch; they are numbered once. With ``image_shape`` features
    are images: cropped and flipped anew each epoch to fit, standardised to score.
    The state is also written to ``model_out``, in place of what is there. The log grows by a
    segment at each saving, and ``on_log`` is told of the same rows.
    """
    spark = train.sparkSession
    batch_size = rank_batch_size(total_batch_size, nodes)
    used = None if stop_iter is None else batch_size * stop_iter

    numbered_at = new_folder(spark, "numbered")
    if nodes == 1:
        numbered, total = number_rows(train, "id", seed)
        numbered = freeze(numbered, "numbered", numbered_at)

    def batches(epoch: int) -> DataFrame:
        if nodes == 1:
            shards = epoch_order(numbered, total, seed, epoch, rows=used)
        else:
            shards = shard_assign(train, "id", nodes, seed, epoch=epoch, rows_per_rank=used)
        return minibatch(shards, batch_size, stop_iter=stop_iter)

    def augmented(rows: DataFrame, epoch: int) -> DataFrame:
        digest = keyed_md5(seed, epoch, F.col("id"))
        return rows.withColumn("features", train_pixels(F.col("features"), image_shape, digest))

    run = {"epochs": epochs, "stop_iter": stop_iter, "nodes": nodes, "batch_size": batch_size}

    def write_log(rows: DataFrame, segment: str, anew: bool) -> None:
        if anew:
            start_log(spark, log_root, **run)
        write_segment(rows, log_root, segment, **run)

    state, log = sgd_fit(
        batches if nodes == 1 else batches(0),
        classes,
        dim,
        epochs=epochs,
        stop_iter=stop_iter,
        prepare=None if image_shape is None else augmented,
        checkpoint_roots=checkpoint_roots,
        save_every=save_every,
        should_stop=should_stop,
        on_log=on_log,
        write_segment=None if log_root is None else write_log,
    )
    drop_frozen(spark, numbered_at)
    if model_out is not None:
        state.coalesce(1).write.mode("overwrite").parquet(model_out)
    if image_shape is not None:
        test = test.withColumn("features", eval_pixels(F.col("features"), image_shape))
    weights = State.from_table(state, classes).weights
    # scores are narrower than features, and sorting reads its input twice
    folders = [new_folder(spark, label) for label in ("scored", "ordered")]
    scored = score(test, weights, bias=True).select("id", "scores", "label")
    frozen = freeze(scored, "scored", folders[0])
    placed, _ = global_position(frozen, ["id"], path=folders[1])
    result = evaluate(placed, batch_size)
    result = spark.createDataFrame(result.collect(), result.schema)  # one row
    for folder in folders:
        drop_frozen(spark, folder)
    return state, log, result


def fit_progress(
    log: DataFrame, *, nodes: int, total_batch_size: int, total_rows: int
) -> DataFrame:
    """The progress rows of a fit, from its log."""
    batch_size = rank_batch_size(total_batch_size, nodes)
    steps = max(1, -(-total_rows // (batch_size * nodes)))
    return interval_rollup(
        log, batch_size=batch_size, ranks=nodes, total_rows=total_rows, steps=steps
    )
