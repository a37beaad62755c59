"""Window / pivot patterns on planted ties, gaps and boundaries."""

from pyspark.sql import functions as F

from contrail.functions.numeric import half_up, pct
from contrail.operators.patterns import (banded, change_vs_previous, moving_avg, pivot_fixed, rank_in,
                                         running_total, share_of, top_n, vs_average, with_totals)


def test_rank_ties_and_top_n_tiebreak(df):
    d = df([("a", 10), ("b", 10), ("c", 5), ("d", 1)], "k string, n int")
    r = {x.k: (x.rk, x.dr) for x in rank_in(rank_in(d, "n", name="rk"), "n", kind="dense_rank", name="dr").collect()}
    assert r == {"a": (1, 1), "b": (1, 1), "c": (3, 2), "d": (4, 3)}
    top = [x.k for x in top_n(d, 3, "n", tie="k").orderBy("position").collect()]
    assert top == ["a", "b", "c"]
    nt = {x.k: x.q for x in rank_in(d, "n", kind="ntile:2", name="q", tie="k").collect()}
    assert nt == {"a": 1, "b": 1, "c": 2, "d": 2}


def test_share_sums_to_100_and_running_total(df):
    d = df([("x", 1, 3), ("x", 2, 5), ("y", 1, 2)], "g string, m int, n int")
    s = share_of(d, "n", "g", "pct", scale=None)
    tot = {r.g: r.s for r in s.groupBy("g").agg(F.sum("pct").alias("s")).collect()}
    assert all(abs(v - 100.0) < 1e-9 for v in tot.values())
    rt = running_total(d, "n", "g", "m", "run").filter("g = 'x'").orderBy("m").collect()
    assert [r.run for r in rt] == [3, 8]  # last row == group sum
    ma = moving_avg(df([("x", i, v) for i, v in enumerate([3, 6, 9, 12])], "g string, m int, n int"),
                    "n", "g", "m", 3, "ma").orderBy("m").collect()
    assert [r.ma for r in ma] == [3.0, 4.5, 6.0, 9.0]


def test_lag_gaps_year_boundary_zero_previous(df):
    rows = [("A", 2019, 3, 10), ("A", 2019, 4, 0), ("A", 2020, 1, 5), ("A", 2020, 3, 5),
            ("B", 2020, 2, 7), ("B", 2020, 4, 7)]
    d = df(rows, "a string, y int, q int, n int")
    across = change_vs_previous(d, "n", "a", ["y", "q"], "prev", "diff", "pct")
    got = {(r.a, r.y, r.q): (r.prev, r.diff, r.pct) for r in across.collect()}
    assert got[("A", 2019, 3)] == (None, None, None)
    assert got[("A", 2020, 1)] == (0, 5, None)          # previous value 0 -> no percentage
    assert got[("A", 2020, 3)] == (5, 0, 0.0)           # previous *row*, quarter 2 is missing
    within = change_vs_previous(d, "n", ["a", "y"], "q", "prev")
    assert {(r.a, r.y, r.q): r.prev for r in within.collect()}[("A", 2020, 1)] is None  # lag inside year


def test_bands_first_match_wins(df):
    d = df([(0.8,), (1.2,), (1.21,), (0.79,)], "r double")
    b = banded([(F.col("r").between(0.8, 1.2), "medium"), (F.col("r") > 1.2, "large")], "small")
    assert [r[0] for r in d.select(b).collect()] == ["medium", "medium", "large", "small"]
    p = df([(5.0,), (15.0,), (-0.1,), (15.01,)], "d double")
    arms = [(F.col("d") < 0, "early"), (F.col("d").between(0, 5), "on time"),
            (F.col("d").between(5, 15), "moderate")]
    assert [r[0] for r in p.select(banded(arms, "chronic")).collect()] == ["on time", "moderate", "early", "chronic"]


def test_pivot_fixed_absent_value(df):
    d = df([("A", 1, 3.0), ("A", 2, 5.0), ("B", 1, 1.0)], "k string, q int, v double")
    c = {r.k: (r.q1, r.q2, r.q3) for r in pivot_fixed(d, "k", "q", [1, 2, 3], "v", "count",
                                                       names=["q1", "q2", "q3"], fill=0).collect()}
    assert c == {"A": (1, 1, 0), "B": (1, 0, 0)}           # COUNT cells fill with 0
    s = {r.k: (r.q1, r.q3) for r in pivot_fixed(d, "k", "q", [1, 2, 3], "v", "sum",
                                                  names=["q1", "q2", "q3"]).collect()}
    assert s == {"A": (3.0, None), "B": (1.0, None)}      # SUM cells stay null


def test_half_up_and_true_average(df):
    d = df([(0.145,), (2.5,), (-0.145,)], "x double")
    assert [r[0] for r in d.select(half_up("x", 2)).collect()] == [0.15, 2.5, -0.15]
    avg = df([(1,), (2,), (2,)], "n int")  # 5/3: true average, not integer-truncated
    va = vs_average(avg, "n", avg_name="a", diff_name=None).first().a
    assert va == 1.6667
    one = with_totals(avg, avg.agg(F.sum("n").alias("t"))).select(pct("n", "t", 2).alias("p"))
    assert sorted(r.p for r in one.collect()) == [20.0, 40.0, 40.0]


def test_month_end_leap_day(df):
    import datetime as dt
    d = df([(dt.date(2020, 2, 29),), (dt.date(2020, 2, 28),), (dt.date(2019, 2, 28),)], "d date")
    got = [r[0] for r in d.select(F.col("d") == F.last_day("d")).collect()]
    assert got == [True, False, True]


def test_route_threshold_50_vs_51_and_risk_bands(df):
    from contrail.plans.reports import _risk, route_metrics
    rows = [("AAA", "BBB", False, 10)] * 50 + [("AAA", "CCC", i == 0, 20) for i in range(51)]
    f = df(rows, "origin_airport string, dest_airport string, cancelled boolean, dep_delay_minutes int")
    r = route_metrics(f, 50).withColumn("risk", _risk(F.col("__rate"), F.col("__delay"))).collect()
    assert [(x.dest_airport, x.total_flights, x.cancelled) for x in r] == [("CCC", 51, 1)]  # HAVING > 50
    assert r[0].risk == "Moderate risk"  # 1.96 % cancelled > 1.0, mean delay 20 > 15


def test_model_environment_joins_the_flights_once(spark):
    """The average, the value positions and the ranked rows read one written aggregate."""
    from conftest import SF_SMALL
    from contrail.plans import reports as K
    from contrail.plans.mart import FlightMart
    out = K.k10_model_environment(FlightMart(spark, SF_SMALL))
    assert out.count() > 0 and not any("lineitem" in f for f in out.inputFiles())
