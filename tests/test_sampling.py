import hashlib

import pytest
from pyspark.sql import functions as F

from tidemill.operators.sampling import minibatch, rank_batch_size, shard_assign
from tidemill.sources.files import split_train_test


def expected_shards(ids, world, seed, epoch=0):
    order = sorted(ids, key=lambda i: (hashlib.md5(f"{seed}:{epoch}:{i}".encode()).hexdigest(), i))
    slots = list(order)
    while len(slots) % world:
        slots += order[: min(len(order), -len(slots) % world)]
    return sorted((s % world, s // world, i) for s, i in enumerate(slots))


def rows(shards):
    return sorted((r["rank"], r["pos_in_rank"], r["id"]) for r in shards.collect())


@pytest.mark.parametrize("count,world", [(12, 4), (13, 4), (14, 4), (2, 7), (1, 3), (101, 3), (50, 1)])
def test_shards_match_brute_force(spark, count, world):
    assert rows(shard_assign(spark.range(count), "id", world, 2021)) == expected_shards(
        range(count), world, 2021
    )


def test_ranks_are_equal_and_cover_everything(spark):
    shards = shard_assign(spark.range(1001), "id", 8, 5)
    sizes = {r["count"] for r in shards.groupBy("rank").count().collect()}
    assert sizes == {126}
    assert shards.select("id").distinct().count() == 1001


def test_seed_and_epoch_change_the_order_and_repeat_it(spark):
    ids = spark.range(60)
    base = rows(shard_assign(ids, "id", 4, 1))
    assert rows(shard_assign(ids.repartition(5), "id", 4, 1)) == base
    assert rows(shard_assign(ids, "id", 4, 2)) != base
    assert rows(shard_assign(ids, "id", 4, 1, epoch=1)) != base


@pytest.mark.parametrize("world,size,stop", [(4, 5, 1), (4, 5, 3), (3, 10, 100), (5, 1, 2), (3, 7, 0)])
def test_unused_rows_can_be_left_out(spark, world, size, stop):
    ids = spark.range(100)
    all_batches = minibatch(shard_assign(ids, "id", world, 9), size, stop_iter=stop)
    used = shard_assign(ids, "id", world, 9, rows_per_rank=size * stop)
    assert rows(minibatch(used, size, stop_iter=stop)) == rows(all_batches)


def test_batches(spark):
    assert rank_batch_size(256, 4) == 64
    batches = minibatch(shard_assign(spark.range(30), "id", 3, 0), 4)
    for r in batches.collect():
        assert (r["batch_idx"], r["pos_in_batch"]) == divmod(r["pos_in_rank"], 4)
    sizes = batches.groupBy("rank", "batch_idx").count().collect()
    assert sorted((r["batch_idx"], r["count"]) for r in sizes) == sorted([(0, 4), (1, 4), (2, 2)] * 3)
    cut = minibatch(shard_assign(spark.range(30), "id", 3, 0), 4, stop_iter=2)
    assert cut.agg(F.max("batch_idx")).first()[0] == 1


def test_a_repeated_id_goes_to_all_ranks(spark):
    df = spark.range(400).select((F.col("id") * 0 + 1).alias("id"))
    shards = shard_assign(df, "id", 4, 3, hot_rows=20)
    assert {r["count"] for r in shards.groupBy("rank").count().collect()} == {100}
    assert shards.groupBy("rank", "pos_in_rank").count().where("count > 1").count() == 0


def test_split_is_stable(spark):
    df = spark.range(2000)
    split = {r["id"]: r["split"] for r in split_train_test(df, seed=3).collect()}
    again = {r["id"]: r["split"] for r in split_train_test(df.repartition(7), seed=3).collect()}
    assert split == again
    assert 0.15 < sum(s == "test" for s in split.values()) / 2000 < 0.25
