"""Every registered query against its SQL."""

import subprocess
import sys

import pytest
from compare import differences, duck, duck_rows, spark_rows
from conftest import DATA, ROOT

import __spark_entry__ as entry_points
from tidemill.plans.oracles import ORACLES
from tidemill.plans.queries import QUERIES

SF_DIR = f"{DATA}/sf0.01"


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)


def check_plan(name, text):
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "BatchEvalPython" not in text  # no row-at-a-time Python
    assert text.count("ArrowEvalPython") <= 1  # and no array computed twice
    if "SinglePartition" in text:  # only to finish an aggregate without keys
        assert name in ("evaluate", "eval_accuracy", "eval_loss")
        assert "partial_" in text


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    check_plan(name, df._jdf.queryExecution().executedPlan().toString())
    columns, mine = spark_rows(df)
    expected, theirs = duck_rows(con, ORACLES[name])
    assert columns == expected
    assert mine == theirs, differences(mine, theirs)
    assert sum(mine.values()) > 0


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0


def test_entry_points_work_without_the_corpus_subpackage():
    """It may be left out, along with the pipeline at the top."""
    code = (
        "import sys; sys.modules['corpus_pipeline'] = None; sys.modules['tidemill.llm'] = None\n"
        "import __spark_entry__ as e\n"
        "from tidemill.plans.queries import QUERIES\n"
        "assert set(e.queries()) == set(QUERIES) and set(e.oracle_sql()) == set(QUERIES)"
    )
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)
