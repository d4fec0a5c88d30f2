"""The registered queries, over whole tables.

Ranking runs on the *supply graph*: each lineitem links its part to its supplier
and back, so every vertex is both a source and a target and equal links occur.
The *page graph*, from urls to the addresses they link to, is one level deep.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.functions.hashing import keyed_md5
from tidemill.functions.pixels import (
    CHANNEL_MEANS,
    CHANNEL_STDS,
    PIXEL_MAX,
    eval_pixels,
    random_crop,
    random_flip,
    standardize,
    train_pixels,
)
from tidemill.functions.vectors import cross_entropy
from tidemill.functions.whole import div
from tidemill.operators.evaluation import accuracy, evaluate_in_order, predict
from tidemill.operators.fitting import (
    allreduce_mean,
    gather_mean,
    partial_gradients,
    rank_means,
    score,
    sgd_fit,
)
from tidemill.operators.ordering import close_gaps, global_position, sort_csv
from tidemill.operators.progress import interval_rollup, phase_rollup
from tidemill.operators.ranking import init_ranks, out_degree, pagerank, rank_edges
from tidemill.operators.sampling import (
    epoch_order,
    minibatch,
    number_rows,
    rank_batch_size,
    shard_assign,
)
from tidemill.session import new_folder
from tidemill.sources.files import read_csv, read_labelled, split_train_test, write_csv
from tidemill.sources.links import read_edges
from tidemill.sources.layout import open_layout, write_layout
from tidemill.sources.runlog import (
    RUN_FIELDS,
    append_log,
    read_log,
    segment_from,
    start_log,
    write_segment,
)
from tidemill.sources.snapshots import freeze
from tidemill.sources.state import load_state

Query = Callable[[SparkSession, str], DataFrame]

SEED = 2021
CLASSES = 10
DIM = 64
SHAPE = (4, 4, 4)
CROP_PAD = 1
# four channels: the fixed three and the first again
MEANS = [m / PIXEL_MAX for m in (*CHANNEL_MEANS, CHANNEL_MEANS[0])]
STDS = [s / PIXEL_MAX for s in (*CHANNEL_STDS, CHANNEL_STDS[0])]
WORLD = 4
TOTAL_BATCH_SIZE = 256
RUN = {"epochs": 1, "stop_iter": 40, "nodes": 4, "batch_size": 64}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(column: Column | str, digits: int) -> Column:
    return F.round(column, digits)


# ---- link graphs


def supply_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = F.concat(F.lit("P"), F.col("l_partkey").cast("string"))
    supplier = F.concat(F.lit("S"), F.col("l_suppkey").cast("string"))
    both_ways = F.array(
        F.struct(part.alias("source"), supplier.alias("target")),
        F.struct(supplier.alias("source"), part.alias("target")),
    )
    return table(spark, sf_dir, "lineitem").select(F.inline(both_ways))


def page_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    hrefs = F.regexp_extract_all(F.col("html"), F.lit('href="([^"]*)"'), F.lit(1))
    return table(spark, sf_dir, "pages").select(
        F.col("url").alias("source"), F.explode(hrefs).alias("target")
    )


def _lines(edges: DataFrame) -> DataFrame:
    return edges.select(F.concat_ws("\t", "source", "target").alias("value"))


def edge_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "links")
    _lines(supply_graph(spark, sf_dir)).write.text(path)
    return read_edges(spark, path)


def edge_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    comments = table(spark, sf_dir, "part").select(
        F.concat_ws(" ", F.lit("#"), "p_name").alias("value")
    )
    suppliers = table(spark, sf_dir, "supplier")
    lone = suppliers.select(F.concat(F.lit("S"), F.col("s_suppkey")).alias("value"))
    indented = suppliers.select(F.concat(F.lit("  S"), F.col("s_suppkey")).alias("value"))
    path = new_folder(spark, "links")
    lines = _lines(supply_graph(spark, sf_dir)).unionAll(comments).unionAll(lone).unionAll(indented)
    lines.write.text(path)
    return read_edges(spark, path, drop_comments="#", drop_incomplete=True)


def start_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return init_ranks(supply_graph(spark, sf_dir))


def link_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out_degree(supply_graph(spark, sf_dir))


def _rounded_ranks(ranks: DataFrame, digits: int) -> DataFrame:
    return ranks.select("source", rounded("rank", digits).alias("rank"))


def pagerank_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = supply_graph(spark, sf_dir)
    return _rounded_ranks(rank_edges(edges, init_ranks(edges), weight="raw"), 6)


def pagerank_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = supply_graph(spark, sf_dir)
    return _rounded_ranks(pagerank(edges, weight="raw", iters=3, cache=False), 6)


def pagerank_shared(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = pagerank(supply_graph(spark, sf_dir), weight="out_degree", iters=10)
    return _rounded_ranks(ranks, 9)


def pagerank_acyclic(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = page_graph(spark, sf_dir)
    runs = [
        pagerank(edges, weight="raw", iters=k).withColumn("iteration", F.lit(k)) for k in (1, 2)
    ]
    return runs[0].unionAll(runs[1]).select("iteration", "source", rounded("rank", 6).alias("rank"))


def pagerank_teleport(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = page_graph(spark, sf_dir)
    return _rounded_ranks(pagerank(edges, weight="out_degree", iters=3, missing="teleport"), 9)


def pagerank_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = supply_graph(spark, sf_dir)
    return _rounded_ranks(pagerank(edges, weight="raw", iters=3, num_partitions=3, cache=False), 6)


def pagerank_cached(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded_ranks(
        pagerank(supply_graph(spark, sf_dir), weight="raw", iters=3, cache=True), 6
    )


def activity_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users and the few kinds of events they cause, linked both ways: each kind
    is the source of a tenth of all links."""
    user = F.concat(F.lit("U"), F.col("user_id").cast("string"))
    both_ways = F.array(
        F.struct(user.alias("source"), F.col("event_type").alias("target")),
        F.struct(F.col("event_type").alias("source"), user.alias("target")),
    )
    return table(spark, sf_dir, "events").select(F.inline(both_ways))


def pagerank_skewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The kinds of events are heavier than a sixteenth, so they are spread."""
    edges = activity_graph(spark, sf_dir)
    ranks = pagerank(edges, weight="out_degree", iters=3, num_partitions=16, heavy_rows=1)
    return _rounded_ranks(ranks, 9)


def pagerank_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run that ends after two iterations, and one that picks up from there, while
    another graph has its snapshots in the same folder."""
    edges, snapshots = supply_graph(spark, sf_dir), new_folder(spark, "snapshots")
    pagerank(edges, weight="raw", iters=2, snapshot_dir=snapshots)
    pagerank(activity_graph(spark, sf_dir), weight="raw", iters=3, snapshot_dir=snapshots)
    return _rounded_ranks(pagerank(edges, weight="raw", iters=3, snapshot_dir=snapshots), 6)


def pagerank_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every digit of the ranks, from a run that is picked up by one with other partitions."""
    edges, snapshots = supply_graph(spark, sf_dir), new_folder(spark, "snapshots")
    options = {"weight": "raw", "exact": True, "snapshot_dir": snapshots}
    pagerank(edges, iters=1, num_partitions=5, **options)
    # by a column: as many partitions as the session has, and no task sorts what it sends
    ranks = pagerank(edges.repartition("target"), iters=3, num_partitions=3, **options)
    return ranks.select("source", F.col("rank").cast("string").alias("rank"))


def rank_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both graphs at once, so that there are ranks and nulls to write."""
    edges = supply_graph(spark, sf_dir).unionAll(page_graph(spark, sf_dir))
    path = new_folder(spark, "ranks-csv")
    write_csv(pagerank(edges, weight="raw", iters=2), path)
    return _rounded_ranks(read_csv(spark, path, schema="source string, rank double"), 6)


# ---- ordering


def csv_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    src, dst = new_folder(spark, "events-csv"), new_folder(spark, "sorted-csv")
    events = table(spark, sf_dir, "events")
    write_csv(events.select(*(F.col(c).cast("string") for c in events.columns)), src)
    ordered = sort_csv(spark, src, dst, ["event_type", "ts"], order_id="order_id")
    placed, _ = close_gaps(ordered)
    return placed.select(*events.columns, "pos")


# ---- sampling


def train_test_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_labelled(
        spark, f"{sf_dir}/embeddings.parquet", id_col="vec_id", features="embedding", label="label"
    )
    return split_train_test(rows, seed=SEED).select("id", "label", "split")


def shards_of_three_and_four(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = table(spark, sf_dir, "embeddings").select("vec_id")
    worlds = [shard_assign(ids, "vec_id", w, SEED).withColumn("world", F.lit(w)) for w in (3, 4)]
    return worlds[0].unionAll(worlds[1]).select("world", "vec_id", "rank", "pos_in_rank")


def epoch_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = table(spark, sf_dir, "embeddings").select("vec_id")
    epochs = [
        shard_assign(ids, "vec_id", 1, SEED, epoch=e).withColumn("epoch", F.lit(e)) for e in (0, 1)
    ]
    both = epochs[0].unionAll(epochs[1])
    return both.select("epoch", "vec_id", F.col("pos_in_rank").alias("pos"))


def epoch_permutation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two epochs' orders of rows that are numbered once."""
    ids = table(spark, sf_dir, "embeddings").select("vec_id")
    numbered, total = number_rows(ids, "vec_id", SEED)
    numbered = freeze(numbered, "numbered")
    epochs = [
        freeze(epoch_order(numbered, total, SEED, e).withColumn("epoch", F.lit(e)), "epoch")
        for e in (0, 1)
    ]
    both = epochs[0].unionAll(epochs[1])
    return both.select("epoch", "vec_id", F.col("pos_in_rank").alias("pos"))


def batch_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches laid out in ranges of a few; what two of them hold, read by the manifest."""
    path, size = new_folder(spark, "layout"), rank_batch_size(TOTAL_BATCH_SIZE, WORLD) // 8
    ids = table(spark, sf_dir, "embeddings").select("vec_id")
    shards = minibatch(shard_assign(ids, "vec_id", WORLD, SEED), size)
    rows = shards.select("vec_id", "rank", "batch_idx", "pos_in_batch")
    write_layout(rows, path, row_bytes=8, range_bytes=5 * WORLD * size * 8)
    layout = open_layout(spark, path, rows.schema)
    return layout.batch(0).unionAll(layout.batch(layout.batches - 1))


def _batches(spark: SparkSession, sf_dir: str, stop_iter: int | None = None) -> DataFrame:
    size = rank_batch_size(TOTAL_BATCH_SIZE, WORLD)
    ids = table(spark, sf_dir, "embeddings").select("vec_id")
    used = None if stop_iter is None else size * stop_iter
    shards = shard_assign(ids, "vec_id", WORLD, SEED, rows_per_rank=used)
    batches = minibatch(shards, size, stop_iter=stop_iter)
    return batches.select("vec_id", "rank", "batch_idx", "pos_in_batch")


def batch_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _batches(spark, sf_dir)


def batch_cutoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _batches(spark, sf_dir, stop_iter=1)


# ---- features


def _pixel_rows(spark: SparkSession, sf_dir: str, change: Callable[[Column], Column]) -> DataFrame:
    # the outer form: the other one filters by the array's size, computing it twice
    pixels = table(spark, sf_dir, "embeddings").select(
        "vec_id", F.posexplode_outer(change(F.col("embedding"))).alias("pos", "value")
    )
    return pixels.withColumn("value", rounded("value", 9))


def _digest() -> Column:
    return keyed_md5(SEED, 0, F.col("vec_id"))


def channel_standardize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pixel_rows(spark, sf_dir, lambda p: standardize(p, SHAPE, MEANS, STDS))


def crop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pixel_rows(spark, sf_dir, lambda p: random_crop(p, SHAPE, CROP_PAD, _digest()))


def mirror(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pixel_rows(spark, sf_dir, lambda p: random_flip(p, SHAPE, _digest()))


def augment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pixel_rows(
        spark,
        sf_dir,
        lambda p: train_pixels(p, SHAPE, _digest(), pad=CROP_PAD, means=MEANS, stds=STDS),
    )


def scale_and_standardize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pixel_rows(spark, sf_dir, lambda p: eval_pixels(p, SHAPE, means=MEANS, stds=STDS))


# ---- fitting


def _features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", F.col("embedding").alias("features"), "label"
    )


def sample_weights() -> np.ndarray:
    """Fixed values to score with: ((7 k + 3 d) mod 11 - 5) / 50."""
    k, d = np.indices((CLASSES, DIM))
    return ((7 * k + 3 * d) % 11 - 5) / 50.0


def softmax_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score(_features(spark, sf_dir), sample_weights())
    losses = scored.withColumn("loss", cross_entropy(F.col("scores"), F.col("label")))
    return (
        predict(losses)
        .select("vec_id", "predicted", "loss", F.posexplode_outer("scores").alias("class", "score"))
        .withColumn("score", rounded("score", 9))
        .withColumn("loss", rounded("loss", 9))
    )


def _shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_assign(_features(spark, sf_dir), "vec_id", WORLD, SEED)


def _by_weight(numbers: DataFrame, width: int = DIM) -> DataFrame:
    at = F.col("pos") - 1
    return numbers.where(F.col("pos") > 0).select(
        div(at, width).alias("class"),
        (at % width).cast("long").alias("dim"),
        rounded("value", 9).alias("value"),
    )


def _means(spark: SparkSession, sf_dir: str) -> DataFrame:
    zero = np.zeros((CLASSES, DIM))
    return rank_means(partial_gradients(_shards(spark, sf_dir), zero))


def gradient_rank_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _by_weight(gather_mean(_means(spark, sf_dir)))


def gradient_allreduce(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _by_weight(allreduce_mean(_means(spark, sf_dir), WORLD))


def _whole_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _features(spark, sf_dir).withColumn("rank", F.lit(0)).withColumn("batch_idx", F.lit(0))


def _fitted(state: DataFrame, width: int = DIM) -> DataFrame:
    weights = state.where(F.col("name") == "weights").select(
        (F.posexplode("values")).alias("at", "value")
    )
    return _by_weight(weights.select((F.col("at") + 1).alias("pos"), "value"), width)


def _fit(spark: SparkSession, sf_dir: str, **options) -> tuple[DataFrame, DataFrame]:
    rows = _whole_batch(spark, sf_dir)
    return sgd_fit(rows, CLASSES, DIM, bias=False, **{"epochs": 3, **options})


def fit_full_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fitted(_fit(spark, sf_dir)[0])


def fit_losses(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = _fit(spark, sf_dir)[1]
    return log.select("epoch", "iteration", rounded("loss", 9).alias("loss"))


def fit_minibatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches per rank and epoch, two epochs, with a bias."""
    shards = _shards(spark, sf_dir)
    shard_rows = shards.select("pos_in_rank").agg(F.max("pos_in_rank")).first()[0] + 1
    batches = minibatch(shards, -(-shard_rows // 2))
    return _fitted(sgd_fit(batches, CLASSES, DIM, bias=True, epochs=2)[0], DIM + 1)


def fit_augmented(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two epochs over images that are cropped and flipped anew in each."""

    def prepare(rows: DataFrame, epoch: int) -> DataFrame:
        digest = keyed_md5(SEED, epoch, F.col("vec_id"))
        pixels = train_pixels(
            F.col("features"), SHAPE, digest, pad=CROP_PAD, means=MEANS, stds=STDS
        )
        return rows.withColumn("features", pixels)

    return _fitted(_fit(spark, sf_dir, epochs=2, prepare=prepare)[0])


class _Died(Exception):
    pass


def fit_log_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log of a fit that died between writing its log and saving its state, and went
    on later, with its losses."""
    root, runs = new_folder(spark, "state"), new_folder(spark, "runs")
    told: list[DataFrame] = []

    def write(rows: DataFrame, segment: str, anew: bool) -> None:
        if anew:
            start_log(spark, runs, **RUN)
        write_segment(rows, runs, segment, **RUN)

    def die(rows: DataFrame, segment: str, anew: bool) -> None:
        write(rows, segment, anew)
        if segment == segment_from(1):
            raise _Died

    options = {
        "checkpoint_roots": [root],
        "save_every": 1,
        "on_log": lambda rows, anew: told.append(rows),
    }
    try:
        _fit(spark, sf_dir, write_segment=die, **options)
    except _Died:
        _fit(spark, sf_dir, write_segment=write, **options)
    losses = told[0]
    for rows in told[1:]:
        losses = losses.unionAll(rows)
    losses = losses.select("epoch", "iteration", rounded("loss", 9).alias("loss"))
    log = read_log(spark, runs, segments=load_state(spark, [root], CLASSES).segments)
    return log.select("epoch", "iteration").join(losses, ["epoch", "iteration"])


def checkpoint_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Told to stop during the third step, so two count; then one more."""
    root = new_folder(spark, "state")
    _fit(spark, sf_dir, checkpoint_roots=[root], should_stop=lambda step: step == 2)
    return _fitted(_fit(spark, sf_dir, checkpoint_roots=[root])[0])


def checkpoint_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Its own folder and the first peer's hold nothing, the second peer's does."""
    own, first, second = (new_folder(spark, "state") for _ in range(3))
    _fit(spark, sf_dir, checkpoint_roots=[second], should_stop=lambda step: step == 2)
    if load_state(spark, [own, first], CLASSES) is not None:
        raise AssertionError("new folders cannot hold a state")
    return _fitted(_fit(spark, sf_dir, checkpoint_roots=[own, first, second])[0])


# ---- evaluation


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(_features(spark, sf_dir), sample_weights()).select("vec_id", "scores", "label")


def _evaluated(spark: SparkSession, sf_dir: str) -> DataFrame:
    def scoring(rows: DataFrame) -> DataFrame:
        return score(rows, sample_weights(), features="embedding")

    stored = table(spark, sf_dir, "embeddings")
    return evaluate_in_order(stored, "vec_id", TOTAL_BATCH_SIZE, scoring)


def evaluated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loss and accuracy in one pass."""
    return _rounded_columns(_evaluated(spark, sf_dir), ["loss", "percent"], 6)


def eval_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = accuracy(_scored(spark, sf_dir))
    return counted.select("correct", "total", rounded("percent", 6).alias("percent"))


def eval_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _evaluated(spark, sf_dir).select(rounded("loss", 9).alias("loss"), "batches")


# ---- run logs


def _event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.lit(0).alias("epoch"),
        (F.col("event_id") + 1).alias("iteration"),
        F.col("value").alias("elapsed_time"),
        F.col("value").alias("loss"),
    )


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = new_folder(spark, "runs")
    start_log(spark, root, **RUN)
    append_log(_event_log(spark, sf_dir), root, **RUN)
    return read_log(spark, root).select(*RUN_FIELDS, "epoch", "iteration", "elapsed_time")


def run_log_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = _event_log(spark, sf_dir)
    steps = log.count()
    rows = interval_rollup(
        log,
        batch_size=RUN["batch_size"],
        ranks=RUN["nodes"],
        total_rows=steps * RUN["batch_size"] * RUN["nodes"],
        steps=steps,
    )
    return _rounded_columns(rows, ["percent", "last_loss", "interval_time"], 6)


def _rounded_columns(df: DataFrame, names: Sequence[str], digits: int) -> DataFrame:
    return df.withColumns({name: rounded(name, digits) for name in names})


def phases(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("phase"), F.col("value").alias("seconds")
    )
    return _rounded_columns(phase_rollup(log), ["seconds"], 6)


QUERIES: dict[str, Query] = {
    "edge_parse": edge_parse,
    "edge_clean": edge_clean,
    "init_ranks": start_ranks,
    "out_degree": link_counts,
    "pagerank_step": pagerank_step,
    "pagerank_raw": pagerank_raw,
    "pagerank": pagerank_shared,
    "pagerank_acyclic": pagerank_acyclic,
    "pagerank_teleport": pagerank_teleport,
    "pagerank_partitioned": pagerank_partitioned,
    "pagerank_cached": pagerank_cached,
    "pagerank_restart": pagerank_restart,
    "pagerank_skewed": pagerank_skewed,
    "pagerank_exact": pagerank_exact,
    "rank_csv_roundtrip": rank_csv_roundtrip,
    "csv_sort": csv_sort,
    "train_test_split": train_test_split,
    "shard_assign": shards_of_three_and_four,
    "epoch_shuffle": epoch_shuffle,
    "epoch_permutation": epoch_permutation,
    "minibatch": batch_numbers,
    "batch_cutoff": batch_cutoff,
    "batch_layout": batch_layout,
    "channel_standardize": channel_standardize,
    "random_crop": crop,
    "random_flip": mirror,
    "augment": augment,
    "eval_pixels": scale_and_standardize,
    "softmax_score": softmax_score,
    "gradient_rank_mean": gradient_rank_mean,
    "gradient_allreduce": gradient_allreduce,
    "sgd_fit": fit_full_batch,
    "sgd_losses": fit_losses,
    "sgd_minibatch": fit_minibatch,
    "sgd_augmented": fit_augmented,
    "fit_log_resume": fit_log_resume,
    "checkpoint_resume": checkpoint_resume,
    "checkpoint_fallback": checkpoint_fallback,
    "evaluate": evaluated,
    "eval_accuracy": eval_accuracy,
    "eval_loss": eval_loss,
    "run_log": run_log,
    "run_log_rollup": run_log_rollup,
    "phase_rollup": phases,
}
