"""Seeded sharding of a table over ranks, and mini-batches within a rank."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.functions.hashing import keyed_md5
from tidemill.functions.permute import permute
from tidemill.functions.whole import div
from tidemill.operators.ordering import HOT_ROWS, hash_position


def shard_assign(
    df: DataFrame,
    id_col: str,
    world: int,
    seed: int,
    *,
    epoch: int = 0,
    rows_per_rank: int | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Deals the rows out to ``world`` ranks, adding ``rank`` and ``pos_in_rank``.

    Rows are shuffled by a keyed hash of their id, the order is wrapped around
    until its length is a multiple of ``world``, and slot i goes to rank
    i mod world, so all ranks get equally many rows. With ``world=1`` this is a
    plain epoch shuffle. A run that uses only ``rows_per_rank`` rows of each rank
    says so here, and the rest are not moved at all.
    """
    digest = keyed_md5(seed, epoch, F.col(id_col))
    first = None if rows_per_rank is None else rows_per_rank * world
    placed, total = hash_position(
        df, digest, id_col, position="_pos", first=first, hot_rows=hot_rows
    )
    if total == 0:
        slots = placed.withColumn("_slot", F.col("_pos"))
    else:
        last = -(-total // world) * world - 1
        wrapped = F.sequence(F.col("_pos"), F.lit(last).cast("long"), F.lit(total).cast("long"))
        slots = placed.withColumn("_slot", F.explode(wrapped))
        if first is not None:
            slots = slots.where(F.col("_slot") < first)
    return (
        slots.withColumn("rank", (F.col("_slot") % world).cast("int"))
        .withColumn("pos_in_rank", div(F.col("_slot"), world))
        .drop("_pos", "_slot")
    )


def number_rows(
    df: DataFrame, id_col: str, seed: int, *, number: str = "row_number", hot_rows: int = HOT_ROWS
) -> tuple[DataFrame, int]:
    """Adds a number from 0 to each row, in the order of a keyed hash, and counts the rows.

    Done once; ``epoch_order`` has an order of the numbers for every epoch.
    """
    digest = keyed_md5(seed, F.col(id_col))
    return hash_position(df, digest, id_col, position=number, hot_rows=hot_rows)


def epoch_order(
    numbered: DataFrame,
    total: int,
    seed: int,
    epoch: int,
    *,
    number: str = "row_number",
    rows: int | None = None,
) -> DataFrame:
    """The numbered rows as one rank's shard in a new order: ``rank`` 0 and ``pos_in_rank``.

    The order is arithmetic on the numbers, so an epoch costs no hashing, counting or
    sorting. ``rows`` keeps only that many from its beginning.
    """
    placed = numbered.withColumn("rank", F.lit(0)).withColumn(
        "pos_in_rank", permute(F.col(number), total, seed, epoch)
    )
    return placed if rows is None else placed.where(F.col("pos_in_rank") < rows)


def rank_batch_size(total_batch_size: int, world: int) -> int:
    return total_batch_size // world


def minibatch(shards: DataFrame, batch_size: int, *, stop_iter: int | None = None) -> DataFrame:
    """Numbers each rank's batches in ``batch_idx`` and their rows in
    ``pos_in_batch``; the last batch may be short. ``stop_iter`` keeps that many
    batches of each rank."""
    at = F.col("pos_in_rank")
    batches = shards.withColumns(
        {"batch_idx": div(at, batch_size), "pos_in_batch": at % batch_size}
    )
    return batches if stop_iter is None else batches.where(F.col("batch_idx") < stop_iter)
