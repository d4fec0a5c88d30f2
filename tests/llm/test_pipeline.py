"""The pipeline stage by stage, and the registered queries."""

import hashlib
import re

import pytest
from compare import differences, duck, duck_rows, spark_rows
from conftest import DATA
from corpus import docs_of  # noqa: F401

import __spark_entry__ as entry_points
import corpus_pipeline
from tidemill.llm.common import DOCUMENT_COLUMNS
from tidemill.llm.mixing import mix
from tidemill.llm.queries import ORACLES, QUERIES
from tidemill.llm.toxicity import score_toxicity

SF_DIR = f"{DATA}/sf0.01"


def test_all_are_registered():
    numbers = sorted(int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES)
    assert numbers == list(range(1, 11))
    assert set(QUERIES) | {"pipeline"} <= set(entry_points.queries())
    assert set(ORACLES) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_matches_sql(spark, name):
    columns, mine = spark_rows(QUERIES[name](spark, SF_DIR))
    expected, theirs = duck_rows(duck(SF_DIR), ORACLES[name])
    assert columns == expected
    assert mine == theirs, differences(mine, theirs)


def normal(text):
    return hashlib.sha256(re.sub(r"[\x20\x09-\x0d]+", " ", text or "").encode()).hexdigest()


def shingles(text):
    words = re.sub("[A-Z]", lambda m: m[0].lower(), text or "").split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def test_each_stage_does_its_work_on_what_the_one_before_kept(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "exact dedup", "near dedup", "mixing", "packing"]

    def ids(df):
        return sorted(r["doc_id"] for r in df.select("doc_id").collect())

    mild = stages["toxicity"](spark, docs, SF_DIR)
    toxic = ids(score_toxicity(docs, labels).where("predicted = 1"))
    assert toxic and sorted([*ids(mild), *toxic]) == ids(docs)
    mild = spark.createDataFrame(mild.collect(), docs.schema)

    single = stages["exact dedup"](spark, mild, SF_DIR)
    texts = {r["doc_id"]: r["text"] for r in mild.collect()}
    first = {}
    for i in sorted(texts):
        first.setdefault(normal(texts[i]), i)
    assert ids(single) == sorted(first.values())
    single = spark.createDataFrame(single.collect(), docs.schema)

    apart = stages["near dedup"](spark, single, SF_DIR)
    sets = {i: shingles(texts[i]) for i in first.values()}
    root = {i: i for i in sets}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    having = {}
    for i, s in sets.items():
        near = {}
        for x in s:
            for j in having.setdefault(x, []):
                near[j] = near.get(j, 0) + 1
            having[x].append(i)
        for j, n in near.items():
            if 100 * n >= 80 * (len(s) + len(sets[j]) - n):
                root[max(top(i), top(j))] = min(top(i), top(j))
    assert ids(apart) == sorted(i for i in root if top(i) == i)
    apart = spark.createDataFrame(apart.collect(), docs.schema)

    mixed = stages["mixing"](spark, apart, SF_DIR)
    assert ids(mixed) == sorted(r["doc_id"] for r in mix(apart).collect())
    assert set(ids(mixed)) == set(ids(apart))
    for df in (single, apart, mixed):
        assert set(df.columns) == set(DOCUMENT_COLUMNS)

    packed = stages["packing"](spark, mixed, SF_DIR).collect()
    assert sorted(r["doc_id"] for r in packed if r["piece"] == 0) == ids(mixed)


def test_the_whole_run(spark):
    rows = corpus_pipeline.run(spark, f"{DATA}/sf0.001").collect()
    places = {}
    for r in rows:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for found in places.values():
        assert sum(n for _, n in found) <= 2048
        assert [o for o, _ in sorted(found)] == [sum(n for q, n in found if q < o) for o, _ in sorted(found)]


def test_a_pipeline_over_odd_rows(spark, docs_of, tmp_path):
    pairs = [(1, None), (2, ""), (None, "x y"), (4, "a b c d e f"), (4, "a b c d e f"), (5, "k " * 30000)]
    docs_of(pairs).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in rows} == {1, None, 4, 5}
    docs_of([]).write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
