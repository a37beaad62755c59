"""Report catalogue K1-K25: the five analysis "missions".

Every report aggregates the fact first and only then applies windows, so the
windows run over one row per airline / model / route / period.  Report
parameters are typed Python arguments bound into the plan as literals (never
string-formatted SQL).  Numeric outputs are kept numeric (rounded half-up);
the original text formatting (thousand separators, '%' suffix) is a
presentation concern and is not reproduced.

Averages are true averages (an integer-truncating ``AVG(int)`` is not
emulated), and every TOP-N / ROW_NUMBER carries a unique tie-breaker.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from contrail.functions.numeric import count_if, exact_sum, half_up, pct, ratio
from contrail.operators.patterns import (banded, change_vs_previous, rank_by_value, rank_in,
                                         running_total, share_of, share_of_total, top_n,
                                         with_average, with_totals)
from contrail.operators.quality import exact_percentiles, global_rank
from contrail.plans.mart import FlightMart

# Report thresholds and labels (fixed values of the report definitions).
SIZE_BANDS = (0.80, 1.20)
SHARE_BANDS = (20.0, 10.0)
CODESHARE_BANDS = (50.0, 20.0)
HUB_FACTOR = 1.5
COVERAGE_HIGH = 0.8
ENV_BANDS = (1.5, 1.0, 0.5)
PUNCTUALITY_BANDS = (0.0, 5.0, 15.0)
TAXI_LONG, TAXI_HIGH, TAXI_CRITICAL = 30, 45, 60
TREND_BAND = 0.10
MARKET_BANDS = (20.0, 10.0, 5.0)
ROUTE_MIN_FLIGHTS = 50
RISK_BANDS = ((5.0, 45.0), (2.5, 30.0), (1.0, 15.0))


def _day(s) -> _dt.date:
    return s if isinstance(s, _dt.date) else _dt.date.fromisoformat(str(s))


# ---------------------------------------------------------------- mission 1
def k01_heavy_models(m: FlightMart, min_engines: int = 2) -> DataFrame:
    """Models with more than ``min_engines`` engines and MTOW above the fleet
    average (scalar subquery -> one-row aggregate, broadcast cross join)."""
    mo = m.models()
    avg = mo.agg(F.avg("mtow").alias("fleet_avg_mtow"))
    return (with_totals(mo, avg)
            .filter((F.col("engines") > min_engines) & (F.col("mtow") > F.col("fleet_avg_mtow")))
            .select("model_id", "maker", "engines", "mtow",
                    half_up("fleet_avg_mtow", 4).alias("fleet_avg_mtow")))


def k02_missing_fuel(m: FlightMart) -> DataFrame:
    """Operated flights (not cancelled, not diverted) without fuel or CO2."""
    f = m.flights("airline")
    return (f.filter(~F.col("cancelled") & ~F.col("diverted")
                     & (F.col("fuel_burn").isNull() | F.col("co2").isNull()))
            .select("flight_id", "airline_name", "fuel_burn", "co2"))


def k02_missing_fuel_counts(m: FlightMart) -> DataFrame:
    d = k02_missing_fuel(m)
    return d.agg(F.count("*").alias("incomplete_flights"),
                 count_if(F.col("fuel_burn").isNull()).alias("missing_fuel"),
                 count_if(F.col("co2").isNull()).alias("missing_co2"))


def _per_airline(m: FlightMart, *extra_aggs, where=None) -> DataFrame:
    """Aggregate per airline *before* joining the airline dimension (eager
    aggregation): the fact is reduced map-side to one partial row per
    airline and task, so only those partials are shuffled and the dimension
    join sees one row per airline, whatever the size of either side.  Exact
    because every airline attribute depends on ``airline_id`` alone."""
    f = m.flights()
    if where is not None:
        f = f.filter(where)
    a = f.groupBy("airline_id").agg(F.count("*").alias("total_flights"), *extra_aggs)
    return a.join(m.airlines().select("airline_id", "airline_name", "airline_code"), "airline_id")


def k03_airline_size_class(m: FlightMart) -> DataFrame:
    c = _per_airline(m)
    lo, hi = SIZE_BANDS
    return (with_average(c, "total_flights")
            .select("airline_name", "total_flights",
                    half_up("__avg", 2).alias("avg_flights"),
                    banded([(F.col("total_flights").between(F.col("__avg") * lo, F.col("__avg") * hi),
                             "Medium operator"),
                            (F.col("total_flights") > F.col("__avg") * hi, "Large operator")],
                           "Small operator").alias("size_class")))


def k04_top_airlines(m: FlightMart, n: int = 3) -> DataFrame:
    """Top-N airlines by flights with share of system and distinct aircraft."""
    c = _per_airline(m, F.count_distinct("tail_id").alias("aircraft_used"))
    c = share_of_total(c, "total_flights", name="__share", scale=None)
    # nothing outside the first n can rank before one of them
    c = rank_in(c.orderBy(F.desc("total_flights"), "airline_name").limit(n), "total_flights", name="ranking")
    hi, mid = SHARE_BANDS
    out = c.select("ranking", "airline_name", "total_flights", "aircraft_used",
                   half_up("__share", 2).alias("share_pct"),
                   banded([(F.col("__share") >= hi, "High share"),
                           (F.col("__share") >= mid, "Medium share")], "Low share").alias("share_level"))
    return out


def k05_models_without_aircraft(m: FlightMart) -> DataFrame:
    """Catalogue models never flown, per maker (anti join)."""
    used = m.table("lineitem").select(F.col("l_partkey").alias("model_id")).distinct()
    return (m.models().join(used, "model_id", "left_anti")
            .groupBy("maker").agg(F.count("*").alias("unused_models")))


# ---------------------------------------------------------------- mission 2
def k06_codeshare(m: FlightMart) -> DataFrame:
    f = m.flights("airline", "dest")
    c = (f.groupBy("airline_name", "airline_code", "network_name", "network_id")
         .agg(F.count("*").alias("total_flights"),
              count_if(F.col("origin_airport_id") != F.col("dest_airport_id")).alias("codeshare_flights")))
    c = c.withColumn("own_flights", F.col("total_flights") - F.col("codeshare_flights"))
    c = rank_by_value(c, "codeshare_flights", name="codeshare_rank")
    c = with_average(c, "codeshare_flights")
    c = (c.withColumn("diff_vs_avg", half_up(F.col("codeshare_flights") - F.col("__avg"), 4))
         .withColumn("avg_codeshare", half_up("__avg", 4)).drop("__avg"))
    c = share_of_total(c, "codeshare_flights", name="network_share_pct")
    r = F.col("codeshare_flights").cast("double") * 100.0 / F.col("total_flights")
    hi, mid = CODESHARE_BANDS
    return c.withColumn("codeshare_category", banded(
        [(r > hi, "High code-share dependency"), (r > mid, "Moderate dependency")], "Own operation"))


def k07_state_connectivity(m: FlightMart) -> DataFrame:
    f = m.flights("airline", "dest")
    # flight_id is the fact key (asserted unique by the tests), so COUNT(DISTINCT flight_id) = COUNT(*).
    # Pre-aggregate to one row per (state, origin, destination) with map-side
    # partial counts; the distinct counts then expand only those few rows
    # instead of every flight.
    pairs = f.groupBy("origin_state", "origin_airport_id", "dest_airport_id").agg(F.count("*").alias("__n"))
    c = (pairs.groupBy("origin_state")
         .agg(F.sum("__n").cast("long").alias("total_flights"),
              F.count_distinct("origin_airport_id").alias("origin_airports"),
              F.count_distinct("dest_airport_id").alias("dest_airports"),
              F.count_distinct("origin_airport_id").alias("connected_cities")))
    c = rank_in(c, "total_flights", name="ranking")
    c = c.withColumn("__avg", F.avg("total_flights").over(Window.partitionBy()))
    c = share_of(c, "total_flights", name="share_pct")
    return c.select("origin_state", "total_flights", "origin_airports", "dest_airports",
                    "connected_cities", "ranking",
                    half_up("__avg", 4).alias("system_avg"),
                    half_up(F.col("total_flights") - F.col("__avg"), 4).alias("diff_vs_avg"),
                    "share_pct",
                    banded([(F.col("total_flights") > F.col("__avg") * HUB_FACTOR, "National hub"),
                            (F.col("total_flights") > F.col("__avg"), "Relevant node")],
                           "Basic connectivity").alias("connectivity"))


def k08_airline_quarter_matrix(m: FlightMart) -> DataFrame:
    """Airline x quarter flight matrix (conditional-sum pivot in one pass)."""
    q = [count_if(F.col("quarter") == i).alias(f"q{i}") for i in (1, 2, 3, 4)]
    c = _per_airline(m, *q)
    c = rank_by_value(c, "total_flights", name="ranking")
    c = with_average(c, "total_flights")
    c = share_of_total(c, "total_flights", name="share_pct")
    inactive = (F.col("q1") == 0) | (F.col("q2") == 0) | (F.col("q3") == 0) | (F.col("q4") == 0)
    return c.select("airline_name", "airline_code", "q1", "q2", "q3", "q4", "total_flights",
                    "ranking", half_up("__avg", 4).alias("market_avg"),
                    half_up(F.col("total_flights") - F.col("__avg"), 4).alias("diff_vs_avg"),
                    "share_pct",
                    F.when(inactive, "Inactive in some quarter").otherwise("Active all year")
                    .alias("operating_status"),
                    banded([(F.col("total_flights") > F.col("__avg") * HUB_FACTOR, "Leader"),
                            (F.col("total_flights") > F.col("__avg"), "Strong competitor")],
                           "Minor share").alias("category"))


def k09_continent_coverage(m: FlightMart) -> DataFrame:
    ap = m.airports()
    total = ap.groupBy("continent").agg(F.count_distinct("airport_id").alias("total_airports"))
    orig, dest = m.used_airports()
    used = (orig.select(F.col("origin_airport_id").alias("airport_id"))
            .union(dest.select(F.col("dest_airport_id").alias("airport_id"))).distinct())
    active = (ap.join(used, "airport_id", "left_semi").groupBy("continent")
              .agg(F.count_distinct("airport_id").alias("active_airports")))
    j = total.join(active, "continent")
    share = ratio("active_airports", "total_airports")
    return j.select("continent", "total_airports", "active_airports",
                    (F.col("total_airports") - F.col("active_airports")).alias("airports_without_flights"),
                    pct("active_airports", "total_airports").alias("coverage_pct"),
                    banded([(F.col("total_airports") == F.col("active_airports"), "Full coverage"),
                            (share >= COVERAGE_HIGH, "High coverage")], "Partial coverage")
                    .alias("coverage_state"))


def k10_model_environment(m: FlightMart) -> DataFrame:
    c = m.per_model([], [F.count("*").alias("total_flights"), F.avg("distance").alias("__dist"),
                         F.avg("fuel_burn").alias("__fuel"), F.avg("co2").alias("__co2"),
                         exact_sum("fuel_burn").alias("__fuel_tot"), exact_sum("co2").alias("__co2_tot")],
                    F.col("fuel_burn").isNotNull() & F.col("co2").isNotNull())
    # one row per model, and the model count grows with the catalogue: the
    # system average is a one-row aggregate and the rank comes from value
    # positions, so no step funnels all models through one task
    # the average, the value positions and the ranked rows all read them: the
    # flights are joined and aggregated once
    c = m.settled(c.withColumn("__co2r", half_up("__co2", 6)), "k10")
    c = with_totals(c, c.agg(F.avg("__co2r").alias("__sys")))
    c = global_rank(c, "__co2r", "impact_rank")
    hi, mid, lo = ENV_BANDS
    co2, sysavg = F.col("__co2r"), F.col("__sys")
    return c.select("model_id", "maker", "model_name", "engine_type", "total_flights",
                    half_up("__dist", 0).alias("avg_distance"),
                    half_up("__fuel", 2).alias("avg_fuel_lbs"),
                    half_up("__co2", 2).alias("avg_co2_lbs"),
                    half_up(sysavg, 2).alias("system_avg_co2"),
                    half_up(co2 - sysavg, 2).alias("diff_vs_system"),
                    half_up("__fuel_tot", 0).alias("total_fuel_lbs"),
                    half_up("__co2_tot", 0).alias("total_co2_lbs"),
                    "impact_rank",
                    banded([(co2 > sysavg * hi, "High impact"), (co2 > sysavg * mid, "Above average"),
                            (co2 > sysavg * lo, "Efficient")], "Very efficient").alias("env_category"))


# ---------------------------------------------------------------- mission 3
def k11_schedule_deviation(m: FlightMart) -> DataFrame:
    dev = F.col("actual_elapsed") - F.col("crs_elapsed")
    c = _per_airline(m, half_up(F.avg("crs_elapsed"), 2).alias("avg_scheduled_min"),
                     half_up(F.avg("actual_elapsed"), 2).alias("avg_actual_min"),
                     half_up(F.avg(dev), 2).alias("avg_deviation_min"),
                     half_up(F.avg(F.abs(dev)), 2).alias("avg_abs_deviation_min"),
                     where=~F.col("cancelled") & F.col("actual_elapsed").isNotNull()
                     & F.col("crs_elapsed").isNotNull())
    c = global_rank(c, "avg_deviation_min", "deviation_rank")
    d = F.col("avg_deviation_min")
    lo, on, mid = PUNCTUALITY_BANDS
    return c.select("deviation_rank", "airline_name", "airline_code", "total_flights",
                    "avg_scheduled_min", "avg_actual_min", "avg_deviation_min",
                    "avg_abs_deviation_min",
                    banded([(d < lo, "Early"), (d.between(lo, on), "On time"),
                            (d.between(on, mid), "Moderate delay")], "Chronic delay")
                    .alias("punctuality"))


def k12_long_taxi_out(m: FlightMart, min_taxi: int = TAXI_LONG) -> DataFrame:
    """Flights with long taxi-out that also ran over schedule.  The system
    average is taken over the filtered rows (literal report semantics); it is
    a one-row aggregate joined back, not an OVER () window on detail rows."""
    f = (m.flights("airline", "dest")
         .filter(~F.col("cancelled") & (F.col("taxi_out") > min_taxi)
                 & F.col("actual_elapsed").isNotNull() & F.col("crs_elapsed").isNotNull()
                 & (F.col("actual_elapsed") > F.col("crs_elapsed"))))
    tot = f.agg(F.avg(F.col("taxi_out").cast("double")).alias("__avg_taxi"))
    d = with_totals(f, tot).withColumn("__excess", F.col("actual_elapsed") - F.col("crs_elapsed"))
    t, x = F.col("taxi_out"), F.col("__excess")
    return d.select("flight_id", "flight_date", "airline_name", "airline_code",
                    F.col("origin_airport").alias("origin"), F.col("dest_airport").alias("destination"),
                    "taxi_out", half_up("__avg_taxi", 2).alias("taxi_out_system_avg"),
                    half_up(t - F.col("__avg_taxi"), 2).alias("taxi_out_excess"),
                    half_up("crs_elapsed", 0).alias("scheduled_min"),
                    half_up("actual_elapsed", 0).alias("actual_min"),
                    half_up(x, 2).alias("total_excess_min"),
                    half_up("fuel_burn", 0).alias("fuel_lbs"), half_up("co2", 2).alias("co2_lbs"),
                    banded([((t > TAXI_CRITICAL) & (x > TAXI_CRITICAL), "Critical"),
                            ((t > TAXI_HIGH) | (x > TAXI_HIGH), "High")], "Moderate")
                    .alias("severity"))


def k13_punctuality_quartiles(m: FlightMart) -> DataFrame:
    """Airlines classed by quartiles of their mean arrival delay.  Uses the
    intended delay chain (one delay row per flight), not a cartesian join."""
    c = _per_airline(m, half_up(F.avg("arr_delay"), 2).alias("avg_arr_delay"),
                     half_up(F.avg("dep_delay"), 2).alias("avg_dep_delay"),
                     count_if(F.col("arr_del15") == 1).alias("delayed_15"),
                     where=~F.col("cancelled"))
    c = c.withColumn("delayed_pct", pct("delayed_15", "total_flights"))
    names = ("q1_threshold", "median_threshold", "q3_threshold")
    q = exact_percentiles(c, "avg_arr_delay", (0.25, 0.5, 0.75), names=names)
    q = q.select(*[half_up(n, 2).alias(n) for n in names])
    c = with_totals(global_rank(c, "avg_arr_delay", "punctuality_rank", descending=False), q)
    a = F.col("avg_arr_delay")
    return c.select("punctuality_rank", "airline_name", "airline_code", "total_flights",
                    "avg_arr_delay", "avg_dep_delay", "delayed_15", "delayed_pct",
                    "q1_threshold", "median_threshold", "q3_threshold",
                    banded([(a <= F.col("q1_threshold"), "High punctuality"),
                            (a <= F.col("median_threshold"), "Medium-high punctuality"),
                            (a <= F.col("q3_threshold"), "Medium-low punctuality")], "Severe delay")
                    .alias("punctuality_class"))


def k14_month_end_close(m: FlightMart) -> DataFrame:
    f = m.flights().filter((F.col("flight_date") == F.last_day("flight_date"))
                           & F.col("fuel_burn").isNotNull())
    c = (f.groupBy("year", "month", "flight_date")
         .agg(F.count("*").alias("flights_on_close"),
              count_if(~F.col("cancelled")).alias("executed"),
              count_if(F.col("cancelled")).alias("cancelled"),
              exact_sum("fuel_burn").alias("fuel_lbs"), exact_sum("co2").alias("co2_lbs")))
    c = running_total(c, "flights_on_close", "year", "month", "ytd_flights")
    c = running_total(c, "co2_lbs", "year", "month", "__ytd_co2")
    c = c.withColumn("__avg", F.avg("flights_on_close").over(Window.partitionBy()))
    n, a = F.col("flights_on_close"), F.col("__avg")
    lo, hi = SIZE_BANDS
    return c.select("year", "month", F.col("flight_date").alias("close_date"), "flights_on_close",
                    "executed", "cancelled", half_up("fuel_lbs", 0).alias("fuel_lbs"),
                    half_up("co2_lbs", 0).alias("co2_lbs"), "ytd_flights",
                    half_up("__ytd_co2", 0).alias("ytd_co2_lbs"),
                    banded([(n > a * hi, "High close"), (n.between(a * lo, a * hi), "Normal close")],
                           "Low close").alias("close_category"))


def k15_quarter_over_quarter(m: FlightMart) -> DataFrame:
    c = m.per_airline(["year", "quarter"], [
        F.count("*").alias("total_flights"), exact_sum("fuel_burn").alias("fuel_lbs"),
        exact_sum("co2").alias("co2_lbs"), half_up(F.avg("distance"), 2).alias("avg_distance"),
        count_if(F.col("cancelled")).alias("cancelled")],
        where=F.col("fuel_burn").isNotNull() & F.col("co2").isNotNull())
    c = share_of(c, "total_flights", ["year", "airline_name"], "share_of_year_pct")
    c = share_of_total(c, "total_flights", ["year", "quarter"], "share_of_quarter_pct")
    c = change_vs_previous(c, "total_flights", ["year", "airline_name"], "quarter", "prev_flights")
    c = change_vs_previous(c, "co2_lbs", ["year", "airline_name"], "quarter", "__prev_co2")
    c = rank_by_value(c, "total_flights", ["year", "quarter"], name="rank_in_quarter")
    n, p, pc = F.col("total_flights"), F.col("prev_flights"), F.col("__prev_co2")
    s = F.col("share_of_quarter_pct")
    hi, mid, lo = MARKET_BANDS
    return c.select(
        "year", "quarter", "airline_name", "airline_code", "rank_in_quarter", "total_flights",
        "cancelled", half_up("fuel_lbs", 0).alias("fuel_lbs"), half_up("co2_lbs", 0).alias("co2_lbs"),
        "avg_distance", "share_of_year_pct", "share_of_quarter_pct", "prev_flights",
        half_up(ratio((n - p) * 100.0, p), 2).alias("flights_change_pct"),
        F.when(pc.isNull() | (pc == 0), F.lit(None))
         .otherwise(half_up(ratio((F.col("co2_lbs") - pc) * 100.0, pc), 2)).alias("co2_change_pct"),
        banded([(p.isNull(), "First quarter on record"), (n > p * (1 + TREND_BAND), "Growth"),
                (n.between(p * (1 - TREND_BAND), p * (1 + TREND_BAND)), "Stable")], "Decline")
        .alias("trend"),
        banded([(s >= hi, "Leader"), (s >= mid, "Strong competitor"), (s >= lo, "Active participant")],
               "Minor share").alias("market_position"))


# ---------------------------------------------------------------- mission 4
def k16_top_origin_airports(m: FlightMart, n: int = 3) -> DataFrame:
    # counts are additive: per-airline partial counts, then per origin airport
    c = (m.per_airline([], [F.count("*").alias("__n")])
         .groupBy("origin_state", "origin_airport_id", "origin_airport")
         .agg(F.sum("__n").cast("long").alias("total_flights")))
    return top_n(c, n, "total_flights", "origin_state", tie="origin_airport_id",
                 name="position_in_state")


def k17_rank_in_network(m: FlightMart) -> DataFrame:
    c = m.per_airline(["year", "quarter"], [F.count("*").alias("total_flights")]).select(
        "network_name", "airline_name", "airline_code", "year", "quarter", "total_flights")
    return rank_by_value(c, "total_flights", ["network_name", "year", "quarter"], name="position_in_network")


def k18_change_vs_previous_quarter(m: FlightMart) -> DataFrame:
    c = m.per_airline(["year", "quarter"], [F.count("*").alias("flights_this_quarter")]).select(
        "airline_name", "airline_code", "year", "quarter", "flights_this_quarter")
    c = change_vs_previous(c, "flights_this_quarter", "airline_name", ["year", "quarter"],
                           "flights_prev_quarter", "abs_change", "pct_change")
    n, p = F.col("flights_this_quarter"), F.col("flights_prev_quarter")
    return c.withColumn("trend", banded([(p.isNull(), "First quarter on record"),
                                         (n > p, "Grew"), (n < p, "Fell")], "Unchanged"))


def k19_daily_running_total(m: FlightMart, start="1998-09-01", end="1998-09-30") -> DataFrame:
    c = m.per_airline(["flight_date"], [F.count("*").alias("flights_of_day")],
                      where=F.col("flight_date").between(_day(start), _day(end))).select(
        "airline_name", "airline_code", "flight_date", "flights_of_day")
    return running_total(c, "flights_of_day", "airline_name", "flight_date", "month_to_date")


def k20_share_system_alliance(m: FlightMart) -> DataFrame:
    c = m.per_airline([], [F.count("*").alias("total_flights")]).select(
        "alliance_name", "airline_name", "airline_code", "total_flights")
    c = share_of_total(c, "total_flights", name="global_share_pct", total="system_total")
    c = share_of_total(c, "total_flights", "alliance_name", name="alliance_share_pct", total="alliance_total")
    c = rank_by_value(c, "total_flights", name="global_rank")
    return rank_by_value(c, "total_flights", "alliance_name", name="alliance_rank")


# ---------------------------------------------------------------- mission 5
def k21_quarterly_co2_matrix(m: FlightMart) -> DataFrame:
    qs = [half_up(exact_sum(F.when(F.col("quarter") == i, F.col("co2")).otherwise(F.lit(0.0))), 0)
          .alias(f"q{i}_co2_lbs") for i in (1, 2, 3, 4)]
    c = m.per_airline([], [*qs, half_up(exact_sum("co2"), 0).alias("total_co2_lbs")],
                      where=~F.col("cancelled") & F.col("co2").isNotNull())
    return c.select("airline_name", *[f"q{i}_co2_lbs" for i in (1, 2, 3, 4)], "total_co2_lbs")


def k22_ytd_delay(m: FlightMart, ref_date="2000-06-15", top: int | None = None) -> DataFrame:
    """Monthly delay minutes and their year-to-date running sum per airline,
    as of ``ref_date`` (its year, months up to its month).  The as-of bound
    is a date-range predicate, so it reaches the parquet scan; it keeps whole
    (airline, year) prefixes, so the running sums are unchanged by it."""
    ref = _day(ref_date)
    cond = ~F.col("cancelled")
    if ref_date is not None:
        cond = cond & (F.col("year") == ref.year) & (F.col("month") <= ref.month)
    c = m.per_airline(["year", "month"], [
        F.sum(F.col("dep_delay_minutes") + F.col("arr_delay_minutes")).cast("long").alias("delay_minutes")],
        where=cond).select("airline_name", "year", "month", "delay_minutes")
    c = running_total(c, "delay_minutes", ["airline_name", "year"], "month", "ytd_delay_minutes")
    if top:
        best = (c.groupBy("airline_name").agg(F.max("ytd_delay_minutes").alias("__m"))
                .orderBy(F.desc("__m"), "airline_name").limit(top).select("airline_name"))
        c = c.join(F.broadcast(best), "airline_name", "left_semi")
    return c


def k23_mtd_fuel(m: FlightMart, ref_date="2000-06-15") -> DataFrame:
    ref = _day(ref_date)
    f = m.flights().filter((F.col("fuel_burn") > 0) & ~F.col("cancelled"))
    if ref_date is not None:
        f = f.filter(F.col("flight_date").between(ref.replace(day=1), ref))
    c = f.groupBy("year", "month", "day_of_month").agg(exact_sum("fuel_burn").alias("daily_fuel_lbs"))
    c = running_total(c, "daily_fuel_lbs", ["year", "month"], "day_of_month", "mtd_fuel_lbs")
    return c.select("year", "month", "day_of_month", half_up("daily_fuel_lbs", 0).alias("daily_fuel_lbs"),
                    half_up("mtd_fuel_lbs", 0).alias("mtd_fuel_lbs"))


def _route_metrics(m: FlightMart, min_flights: int) -> DataFrame:
    return route_metrics(m.flights("airline", "dest"), min_flights)


def route_metrics(f: DataFrame, min_flights: int = ROUTE_MIN_FLIGHTS) -> DataFrame:
    """Per (origin, destination) route: flights, cancellations, mean delay
    and cancel rate, for routes with more than ``min_flights`` flights."""
    return (f.groupBy("origin_airport", "dest_airport")
            .agg(F.count("*").alias("total_flights"),
                 count_if(F.col("cancelled")).alias("cancelled"),
                 F.avg(F.col("dep_delay_minutes").cast("double")).alias("__delay"))
            .filter(F.col("total_flights") > min_flights)
            .withColumn("__rate", pct("cancelled", "total_flights", None)))


def _risk(rate, delay):
    arms = [((rate > r) | (delay > d), lbl) for (r, d), lbl in
            zip(RISK_BANDS, ("Critical risk", "High risk", "Moderate risk"))]
    return banded(arms, "Stable operation")


def k24_route_risk(m: FlightMart, min_flights: int = ROUTE_MIN_FLIGHTS) -> DataFrame:
    c = _route_metrics(m, min_flights)
    return c.select(F.concat_ws("-", "origin_airport", "dest_airport").alias("route"),
                    "total_flights", half_up("__rate", 2).alias("cancel_rate_pct"),
                    half_up("__delay", 1).alias("avg_delay_min"),
                    _risk(F.col("__rate"), F.col("__delay")).alias("risk_level"))


def k25_late_flights(m: FlightMart, airline_code: str = "7", month: int = 6,
                     tolerance: int = 100) -> DataFrame:
    f = (m.flights("airline", "dest")
         .filter((F.col("airline_code") == F.lit(airline_code)) & (F.col("month") == F.lit(month))
                 & (F.col("dep_delay_minutes") >= F.lit(tolerance)) & ~F.col("cancelled")))
    return f.select(F.col("flight_date"), "airline_name", F.col("tail_id").alias("model_id"),
                    F.concat(F.col("origin_airport"), F.lit(" -> "), F.col("dest_airport")).alias("route"),
                    F.col("dep_delay_minutes").alias("delay_minutes"),
                    F.coalesce(half_up("fuel_burn", 2), F.lit(0.0)).alias("fuel_lbs"))
