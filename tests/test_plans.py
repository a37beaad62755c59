"""Physical-plan properties the design relies on (checked on sf0.001)."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from contrail.plans.mart import FlightMart

from conftest import SF_SMALL


def _plan(spark, name):
    df = E.queries()[name](spark, SF_SMALL)
    return df._jdf.queryExecution().executedPlan().toString()


def test_date_range_reaches_the_scan(spark):
    p = _plan(spark, "k19_daily_running_total")
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(o_orderdate,1998-09-01", p)


def test_column_pruning(spark):
    p = _plan(spark, "k31_global_counts")
    li = re.search(r"ReadSchema: (struct<l_orderkey[^ ]*>)", p).group(1)
    assert "l_extendedprice" not in li and "l_partkey" not in li


def test_keep_first_limits_before_the_shuffle(spark):
    p = _plan(spark, "b10_keep_first")
    # a partial WindowGroupLimit below the exchange and a final one above it
    assert p.count("WindowGroupLimit") >= 2


def test_airline_reports_aggregate_before_the_dimension_join(spark):
    p = _plan(spark, "k04_top_airlines")
    lines = p.split("\n")
    join = next(i for i, ln in enumerate(lines) if "Join" in ln and "airline_id" in ln)
    # the fact side of the airline join is already an aggregate (one row per airline)
    below = "\n".join(lines[join:join + 6])
    assert "HashAggregate" in below


def test_no_python_udfs_in_plans(spark):
    for name in ("k10_model_environment", "o9_extract_code", "m14_profile_columns", "b15_canonical_keys"):
        p = _plan(spark, name)
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p


@pytest.mark.parametrize("name", ["k03_airline_size_class", "k04_top_airlines", "k06_codeshare",
                                  "k08_airline_quarter_matrix", "k11_schedule_deviation", "k13_punctuality_quartiles",
                                  "k20_share_system_alliance"])
def test_no_single_task_window_over_airlines(spark, name):
    """A window in one partition stands on a count by value or on a few limited rows."""
    lines = _plan(spark, name).split("\n")
    for i, line in enumerate(lines):
        if "SinglePartition" in line and any(re.search(r"\bWindow\b", x) for x in lines[max(0, i - 3):i]):
            below = "\n".join(lines[i + 1:i + 4])
            assert "HashAggregate" in below or "TakeOrderedAndProject" in "\n".join(lines[max(0, i - 3):i + 4]), below


@pytest.mark.parametrize("sf", ["0.001", "0.01", "0.1"])
def test_flight_id_is_unique(spark, sf):
    f = FlightMart(spark, f"/root/testdata/sf{sf}").flights().select("flight_id")
    r = f.agg(F.count("*").alias("n"), F.count_distinct("flight_id").alias("d")).first()
    assert r.n == r.d
