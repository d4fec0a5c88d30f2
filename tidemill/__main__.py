"""``python -m tidemill sort|rank|fit ...``, also under ``spark-submit``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from tidemill.operators.fitting import STOP_ITER
from tidemill.operators.progress import phase_rollup
from tidemill.operators.ranking import ITERATIONS
from tidemill.plans.jobs import (
    SAVE_EVERY,
    SEED,
    SORT_KEYS,
    TOTAL_BATCH_SIZE,
    PhaseLog,
    fit_job,
    fit_progress,
    rank_job,
    sort_job,
)
from tidemill.sources.files import exists, read_labelled, split_train_test


def parse(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tidemill")
    jobs = parser.add_subparsers(dest="job", required=True)

    sort = jobs.add_parser("sort", help="sort CSV files by two keys")
    sort.add_argument("input")
    sort.add_argument("output")
    sort.add_argument("--keys", nargs="+", default=list(SORT_KEYS))
    sort.add_argument("--single-file", action="store_true", help="one part file, through one task")

    rank = jobs.add_parser("rank", help="rank the pages of a link graph")
    rank.add_argument("input")
    rank.add_argument("output")
    rank.add_argument("num_partitions", nargs="?", type=int)
    rank.add_argument("--weight", required=True, choices=["raw", "out_degree"])
    rank.add_argument("--iters", type=int, default=ITERATIONS)
    rank.add_argument("--cache", action=argparse.BooleanOptionalAction, default=True)
    rank.add_argument("--snapshot-dir")

    fit = jobs.add_parser("fit", help="fit a linear classifier to a feature table")
    fit.add_argument("input", help="parquet table")
    fit.add_argument("--id", default="id")
    fit.add_argument("--features", default="features")
    fit.add_argument("--label", default="label")
    fit.add_argument("--classes", type=int, default=10)
    fit.add_argument("--dim", type=int, required=True)
    fit.add_argument("--num-nodes", type=int, default=4)
    fit.add_argument("--epoch", type=int, default=1)
    fit.add_argument("--stop_iter", type=int, default=STOP_ITER)
    fit.add_argument("--total_batch_size", type=int, default=TOTAL_BATCH_SIZE)
    fit.add_argument("--log-root")
    fit.add_argument("--checkpoint-roots", nargs="*", default=[])
    fit.add_argument(
        "--save-every", type=int, default=SAVE_EVERY, help="steps from one saved state, log segment and report to the next"
    )
    fit.add_argument("--stop-file", help="the fit saves its state and ends once this file exists")
    fit.add_argument("--model-out", help="where the fitted state is written as parquet")
    fit.add_argument("--image-shape", nargs=3, type=int, metavar=("C", "H", "W"))
    return parser.parse_args(argv)


def stop_once(spark: SparkSession, path: str):
    """Asks, step by step, whether ``path`` exists."""
    return lambda step: exists(spark, path)


def main(argv: list[str] | None = None) -> None:
    args = parse(argv)
    phases = PhaseLog()
    with phases.phase("init"):
        spark = SparkSession.builder.appName(f"tidemill-{args.job}").getOrCreate()
    if args.job == "sort":
        sort_job(spark, args.input, args.output, keys=args.keys, single_file=args.single_file)
    elif args.job == "rank":
        rank_job(
            spark,
            args.input,
            args.output,
            weight=args.weight,
            iters=args.iters,
            num_partitions=args.num_partitions,
            cache=args.cache,
            snapshot_dir=args.snapshot_dir,
            phases=phases,
        )
        phase_rollup(phases.table(spark)).orderBy("is_total").show(truncate=False)
    else:
        table = read_labelled(
            spark, args.input, id_col=args.id, features=args.features, label=args.label
        )
        split = split_train_test(table, seed=SEED)
        train = split.where("split = 'train'")
        total_rows = train.count()

        def report(rows, anew: bool) -> None:
            """Steps and full intervals as they happen."""
            shown = rows.count()
            rows.orderBy("epoch", "iteration").show(shown, truncate=False)
            progress = fit_progress(
                rows, nodes=args.num_nodes, total_batch_size=args.total_batch_size, total_rows=total_rows
            )
            progress.orderBy("epoch", "iteration").show(shown, truncate=False)

        _, _, result = fit_job(
            train,
            split.where("split = 'test'"),
            args.classes,
            args.dim,
            nodes=args.num_nodes,
            epochs=args.epoch,
            stop_iter=args.stop_iter,
            total_batch_size=args.total_batch_size,
            log_root=args.log_root,
            image_shape=tuple(args.image_shape) if args.image_shape else None,
            checkpoint_roots=args.checkpoint_roots,
            save_every=args.save_every,
            should_stop=stop_once(spark, args.stop_file) if args.stop_file else None,
            model_out=args.model_out,
            on_log=report,
        )
        result.show()
    spark.stop()


if __name__ == "__main__":
    main()
