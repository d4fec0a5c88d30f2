import hashlib
import random
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tidemill.functions.hashing import keyed_md5
from tidemill.operators.ordering import (
    close_gaps,
    global_position,
    global_sort,
    hash_position,
    sort_csv,
)
from tidemill.session import new_folder
from tidemill.sources.files import read_csv, write_csv

CSV = 'cca2,timestamp\nUS,2018-1\n,2017-1\n"",2016-1\nUS,\nIN,2019-1\nUS,10\nus,1\n'
SORTED = [
    (None, "2016-1"),
    (None, "2017-1"),
    ("IN", "2019-1"),
    ("US", None),
    ("US", "10"),
    ("US", "2018-1"),
    ("us", "1"),
]


@pytest.fixture
def export(tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "export.csv").write_text(CSV)
    return str(tmp_path / "in"), str(tmp_path / "out")


def file_rows(folder):
    """Rows in file order, as written."""
    rows = []
    for part in sorted(Path(folder).glob("part-*")):
        header, *lines = part.read_text().splitlines()
        assert header.startswith("cca2,timestamp")
        rows += [tuple(f.strip('"') or None for f in line.split(",")[:2]) for line in lines]
    return rows


def test_golden_sort_into_one_file(spark, export):
    src, dst = export
    sort_csv(spark, src, dst, ["cca2", "timestamp"], single_file=True)
    assert file_rows(dst) == SORTED
    assert len(list(Path(dst).glob("part-*"))) == 1


def test_part_files_follow_the_order(spark, export):
    src, dst = export
    out = sort_csv(spark, src, dst, ["cca2", "timestamp"], order_id="order_id")
    assert file_rows(dst) == SORTED
    placed, total = close_gaps(out)
    assert total == len(SORTED)
    found = {row["pos"]: (row["cca2"], row["timestamp"]) for row in placed.collect()}
    assert [found[i] for i in range(total)] == SORTED


def test_sort_replaces_its_output(spark, export):
    src, dst = export
    for _ in range(2):
        sort_csv(spark, src, dst, ["cca2", "timestamp"])
    assert read_csv(spark, dst).count() == len(SORTED)


def test_typed_and_descending_sort(spark, tmp_path):
    (tmp_path / "n.csv").write_text("k,v\n9,a\n10,b\n,c\n100,d\n")
    src, dst = str(tmp_path / "n.csv"), str(tmp_path / "out")

    def order(**options):
        placed, _ = close_gaps(sort_csv(spark, src, dst, ["k"], order_id="order_id", **options))
        return [row["v"] for row in placed.orderBy("pos").collect()]

    assert order() == ["c", "b", "d", "a"]
    assert order(schema="k int, v string") == ["c", "a", "b", "d"]
    assert order(schema="k int, v string", ascending=False) == ["d", "b", "a", "c"]


def test_default_sink_refuses_an_existing_folder(spark, tmp_path):
    df = spark.createDataFrame([("a", 1.5), ("b", None)], "source string, rank double")
    path = str(tmp_path / "out")
    write_csv(df, path)
    with pytest.raises(AnalysisException):
        write_csv(df, path)
    back = read_csv(spark, path, schema="source string, rank double")
    assert {tuple(r) for r in back.collect()} == {("a", 1.5), ("b", None)}


def test_every_column_is_a_string(spark, export):
    assert [f.dataType.simpleString() for f in read_csv(spark, export[0]).schema] == ["string"] * 2


def test_positions_with_a_hot_key_and_copies(spark):
    """Two thirds of the rows tie, half of those are copies of each other."""
    random.seed(1)
    rows = [("hot", i % 2 * i) for i in range(2000)] + [(f"k{i}", i) for i in range(1000)]
    random.shuffle(rows)
    df = spark.createDataFrame(rows, "k string, v long").repartition(16)
    placed, total = global_position(df, ["k"])
    found = placed.orderBy("pos").collect()
    assert total == 3000
    assert [row["pos"] for row in found] == list(range(3000))
    assert [row["k"] for row in found] == sorted(k for k, _ in rows)
    assert sorted((r["k"], r["v"]) for r in found) == sorted(rows)


def test_a_hot_key_is_split_over_tasks(spark):
    df = spark.range(20000, numPartitions=16).select(F.lit("hot").alias("k"), "id")
    # adaptive coalescing may join small partitions again, so leave it out here
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tasks = global_sort(df, ["k"]).select(F.spark_partition_id().alias("task"))
        sizes = [row["count"] for row in tasks.groupBy("task").count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(sizes) == 20000
    assert max(sizes) <= 20000 // 4


@pytest.mark.parametrize("hot_rows", [10, 1_000_000])
def test_hash_positions_either_way(spark, hot_rows):
    df = spark.range(500).withColumn("x", F.col("id") * 2)
    placed, total = hash_position(df, keyed_md5(7, F.col("id")), "id", hot_rows=hot_rows)
    expected = sorted(range(500), key=lambda i: hashlib.md5(f"7:{i}".encode()).hexdigest())
    found = sorted((row["pos"], row["id"], row["x"]) for row in placed.collect())
    assert total == 500
    assert found == [(p, i, 2 * i) for p, i in enumerate(expected)]


def test_hash_positions_of_one_repeated_id(spark):
    df = spark.range(300).select(
        F.when(F.col("id") < 200, F.lit(1)).otherwise(F.col("id")).cast("long").alias("id")
    )
    placed, total = hash_position(df, keyed_md5(7, F.col("id")), "id", hot_rows=50)
    rows = placed.orderBy("pos").collect()
    assert total == 300 and [r["pos"] for r in rows] == list(range(300))
    ones = [r["pos"] for r in rows if r["id"] == 1]
    assert len(ones) == 200 and ones[-1] - ones[0] == 199
    few, total = hash_position(df, keyed_md5(7, F.col("id")), "id", hot_rows=50, first=40)
    assert total == 300 and sorted(r["pos"] for r in few.collect()) == list(range(40))


def test_first_positions_only(spark):
    df = spark.range(1000)
    everything, _ = hash_position(df, keyed_md5(3, F.col("id")), "id")
    few, total = hash_position(df, keyed_md5(3, F.col("id")), "id", first=70)
    assert total == 1000
    assert sorted(map(tuple, few.collect())) == sorted(
        map(tuple, everything.where("pos < 70").collect())
    )
    assert hash_position(df, keyed_md5(3, F.col("id")), "id", first=0)[0].count() == 0


def test_empty_tables(spark):
    empty = spark.range(0)
    assert hash_position(empty, keyed_md5(F.col("id")), "id")[1] == 0
    placed, total = global_position(empty, ["id"])
    assert total == 0 and placed.count() == 0


def test_working_folders_are_new(spark):
    assert new_folder(spark, "x") != new_folder(spark, "x")
