import pytest
from oracle_check import connect, differences

import __spark_entry__ as entry
from notewright.plans.oracles import ORACLES
from notewright.plans.queries import QUERIES
from notewright.session import scratch_path

SF = "/root/testdata/sf0.001"
# too few rows there for one cohort
EMPTY_AT_THIS_SCALE = {"cohort_stage3_her2_trastuzumab"}


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, con, name):
    found = differences(entry.queries()[name](spark, SF), con, entry.oracle_sql()[name])
    if name in EMPTY_AT_THIS_SCALE:
        found = [f for f in found if f != "no rows"]
    assert found == []


def test_entry(spark):
    assert entry.entry(spark).columns == ["icdo3_code", "stage_group", "notes"]


def test_scratch_lies_in_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a.startswith(shared) and a != b
