import pytest

import __spark_entry__ as entry
from oracle import compare, connect
from pricegrid.plans.oracles import ORACLES
from pricegrid.plans.queries import QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_a_twin():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.keys() <= entry.queries().keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, sf_dir, name):
    problem, count = compare(spark, con, sf_dir, QUERIES[name], ORACLES[name])
    assert not problem
    assert count


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["product", "vendor", "price", "valid_from", "valid_to"]
    assert df.limit(1).count() == 1


@pytest.mark.parametrize(
    "name",
    "merchant_rank price_history price_on_days price_asof price_stats product_category "
    "new_reports_only failed_download_pairing name_cluster".split(),
)
def test_no_cross_joins(spark, sf_dir, name):
    plan = entry.queries()[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_scans_are_pruned(spark, sf_dir):
    plan = entry.queries()["merchant_breakdown"](spark, sf_dir)._jdf.queryExecution().executedPlan()
    assert "ReadSchema: struct<l_partkey:bigint,l_suppkey:bigint,l_extendedprice:double,l_shipdate:timestamp_ntz>" in plan.toString()
