"""Ad-hoc question families (2.L) as parameterised operators.

One function per family, parameterised by measure / dimension / threshold /
N, instead of one function per phrasing.  ``measure_by`` is the common core:
filter -> group by dimensions -> aggregates -> optional top-N with a unique
tie-breaker.  Dimensions are looked up in :data:`DIM_CHAIN` so only the join
chain a dimension needs is added to the plan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contrail.functions.numeric import count_if, exact_sum, half_up, pct, ratio
from contrail.operators.patterns import (change_vs_previous, moving_avg, pivot_fixed, rank_in,
                                         running_total, share_of, top_n, with_totals)
from contrail.plans.mart import AIRLINE_ATTRS, AIRLINE_IDENTITY, FlightMart

# which join chain provides each dimension
DIM_CHAIN = {
    "airline_name": "airline", "airline_code": "airline", "network_name": "airline",
    "alliance_name": "airline", "origin_airport": "airline", "origin_state": "airline",
    "origin_continent": "airline", "dest_airport": "dest", "dest_state": "dest",
    "dest_continent": "dest", "maker": "model", "engine_type": "model", "model_id": "model",
    "model_name": "model",
}


def _chains(*cols) -> tuple[str, ...]:
    return tuple(sorted({DIM_CHAIN[c] for c in cols if c in DIM_CHAIN}))


def measure_by(m: FlightMart, aggs: dict[str, Column], dims: Sequence[str] = (),
               where: Column | None = None, top: int | None = None, order: str | None = None,
               ascending: bool = False, extra_chains: Sequence[str] = ()) -> DataFrame:
    chains = set(_chains(*dims)) | set(extra_chains)
    if chains == {"airline"} and any(d in AIRLINE_IDENTITY for d in dims) and \
            all(d in AIRLINE_ATTRS or d not in DIM_CHAIN for d in dims):
        # one group per airline (+ fact keys): aggregate before the airline join
        out = m.per_airline(dims, [c.alias(n) for n, c in aggs.items()], where).select(*dims, *aggs)
    else:
        f = m.flights(*sorted(chains))
        if where is not None:
            f = f.filter(where)
        out = f.groupBy(*dims).agg(*[c.alias(n) for n, c in aggs.items()])
    if top:
        o = F.col(order or next(iter(aggs)))
        o = o.asc_nulls_last() if ascending else o.desc_nulls_last()
        out = out.orderBy(o, *dims).limit(top)
    return out


def _operated() -> Column:
    return ~F.col("cancelled")


def _avg(c, n=4):
    return half_up(F.avg(F.col(c).cast("double")), n)


# -- L1 delay measures, global / by period -----------------------------------
def l01_delay_stats(m: FlightMart, by: Sequence[str] = ()) -> DataFrame:
    return measure_by(m, {"avg_dep_delay": _avg("dep_delay_minutes"),
                          "total_dep_delay": F.sum("dep_delay_minutes").cast("long"),
                          "max_dep_delay": F.max("dep_delay_minutes").cast("long"),
                          "min_dep_delay": F.min("dep_delay_minutes").cast("long")},
                      by, _operated())


def l01_delayed_counts(m: FlightMart, threshold: int = 60) -> DataFrame:
    return measure_by(m, {"flights": F.count("*"),
                          "over_threshold": count_if(F.col("dep_delay_minutes") > threshold),
                          "del15_flights": count_if(F.col("dep_del15") == 1),
                          "del15_pct": pct(count_if(F.col("dep_del15") == 1), F.count("*"))},
                      (), _operated())


# -- L2 delay by dimension ----------------------------------------------------
def l02_delay_by(m: FlightMart, dim: str, top: int | None = None) -> DataFrame:
    return measure_by(m, {"avg_dep_delay": _avg("dep_delay_minutes"),
                          "avg_arr_delay": _avg("arr_delay_minutes"), "flights": F.count("*")},
                      [dim], _operated(), top=top)


# -- L3 taxi measures -----------------------------------------------------------
def l03_taxi_by(m: FlightMart, dim: str, threshold: int = 30) -> DataFrame:
    return measure_by(m, {"avg_taxi_out": _avg("taxi_out"), "avg_taxi_in": _avg("taxi_in"),
                          "max_taxi_out": F.max("taxi_out").cast("long"),
                          "long_taxi_flights": count_if(F.col("taxi_out") > threshold)},
                      [dim], _operated())


def l03_top_taxi_flights(m: FlightMart, n: int = 10) -> DataFrame:
    f = m.flights().filter(_operated()).select(
        "flight_id", (F.col("taxi_out") + F.col("taxi_in")).cast("long").alias("total_taxi"))
    return f.orderBy(F.desc("total_taxi"), "flight_id").limit(n)


# -- L4 airline / fleet volume -------------------------------------------------
def l04_fleet_by_airline(m: FlightMart) -> DataFrame:
    return measure_by(m, {"flights": F.count("*"), "aircraft": F.count_distinct("tail_id"),
                          "makers": F.count_distinct("maker")},
                      ["airline_name"], extra_chains=["model"])


def l04_models_per_maker(m: FlightMart) -> DataFrame:
    return measure_by(m, {"models_flown": F.count_distinct("model_id"), "flights": F.count("*")},
                      ["maker"])


# -- L5 geography -----------------------------------------------------------------
def l05_flights_by_geo(m: FlightMart, dim: str = "dest_state") -> DataFrame:
    return measure_by(m, {"flights": F.count("*"), "cancelled": count_if(F.col("cancelled")),
                          "airlines": F.count_distinct("airline_id")}, [dim])


# -- L6 distance ---------------------------------------------------------------------
def l06_distance_by(m: FlightMart, dim: str = "year") -> DataFrame:
    return measure_by(m, {"total_distance": half_up(exact_sum("distance"), 2),
                          "avg_distance": _avg("distance", 2), "flights": F.count("*")}, [dim])


def l06_longest_routes(m: FlightMart, n: int = 10) -> DataFrame:
    return measure_by(m, {"avg_distance": _avg("distance", 2), "flights": F.count("*")},
                      ["origin_airport", "dest_airport"], top=n)


# -- L7 CO2 / fuel / cancellations ------------------------------------------------------
def l07_co2_by(m: FlightMart, dim: str = "airline_name") -> DataFrame:
    return measure_by(m, {"total_co2": half_up(exact_sum("co2"), 2), "avg_co2": _avg("co2", 4),
                          "max_co2": half_up(F.max("co2"), 4),
                          "co2_per_1000_mi": half_up(ratio(exact_sum("co2"), exact_sum("distance")) * 1000.0, 4)},
                      [dim], _operated() & F.col("co2").isNotNull())


def l07_cancel_rate_by(m: FlightMart, dim: str = "month") -> DataFrame:
    return measure_by(m, {"flights": F.count("*"), "cancelled": count_if(F.col("cancelled")),
                          "cancel_pct": pct(count_if(F.col("cancelled")), F.count("*"))}, [dim])


# -- L8 windows over a monthly aggregate ------------------------------------------------
def _monthly(m: FlightMart) -> DataFrame:
    return m.per_airline(["year", "month"], [F.count("*").alias("flights")]).select(
        "airline_name", "year", "month", "flights")


def l08_monthly_windows(m: FlightMart) -> DataFrame:
    """rank / dense_rank / ntile / running / lag diff / moving avg / share /
    % of max over the (airline, year, month) flight counts."""
    c = _monthly(m)
    c = rank_in(c, "flights", ["year", "month"], "rank", name="rank_in_month")
    c = rank_in(c, "flights", ["year", "month"], "dense_rank", name="dense_rank_in_month")
    c = rank_in(c, "flights", ["year", "month"], "ntile:4", name="quartile_in_month",
                tie="airline_name")
    c = running_total(c, "flights", ["airline_name", "year"], "month", "ytd_flights")
    c = change_vs_previous(c, "flights", ["airline_name", "year"], "month", "prev_month", "diff_vs_prev")
    c = moving_avg(c, "flights", ["airline_name", "year"], "month", 3, "__mavg")
    c = c.withColumn("moving_avg_3", half_up("__mavg", 4)).drop("__mavg")
    c = share_of(c, "flights", ["airline_name", "year"], "share_of_year_pct")
    mx = F.max("flights").over(Window.partitionBy("year", "month"))
    return c.withColumn("pct_of_max", half_up(F.col("flights").cast("double") * 100.0 / mx, 2))


def l08_top_per_group(m: FlightMart, n: int = 3, kind: str = "row_number") -> DataFrame:
    """Top-N airlines per year by flights (row_number / dense_rank)."""
    c = m.per_airline(["year"], [F.count("*").alias("flights")]).select("year", "airline_name", "flights")
    return top_n(c, n, "flights", "year", tie="airline_name", name="position", kind=kind)


def l08_running_sum_of_sum(m: FlightMart) -> DataFrame:
    """SUM(SUM(x)) OVER (ORDER BY month): running total over a grouped sum."""
    c = m.flights().filter(_operated()).groupBy("year", "month").agg(
        F.sum("dep_delay_minutes").cast("long").alias("delay_minutes"))
    return running_total(c, "delay_minutes", "year", "month", "running_delay_minutes")


# -- L9 / J pivots --------------------------------------------------------------------------
CONTINENTS = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")


def l09_pivot_count_by_continent(m: FlightMart) -> DataFrame:
    f = m.flights("airline", "dest")
    return pivot_fixed(f, "airline_name", "dest_continent", CONTINENTS, "flight_id", "count",
                       names=[c.lower().replace(" ", "_") for c in CONTINENTS], fill=0)


def l09_pivot_avg_delay_by_quarter(m: FlightMart) -> DataFrame:
    f = m.flights("airline").filter(_operated()).withColumn(
        "dep", F.col("dep_delay_minutes").cast("double"))
    p = pivot_fixed(f, "airline_name", "quarter", (1, 2, 3, 4), "dep", "avg",
                    names=["q1", "q2", "q3", "q4"])
    return p.select("airline_name", *[half_up(c, 4).alias(c) for c in ("q1", "q2", "q3", "q4")])


def l09_unpivot_quarters(m: FlightMart) -> DataFrame:
    """melt of the airline x quarter matrix back to long rows."""
    from contrail.plans.reports import k08_airline_quarter_matrix
    w = k08_airline_quarter_matrix(m).select("airline_name", "q1", "q2", "q3", "q4")
    return w.unpivot("airline_name", ["q1", "q2", "q3", "q4"], "quarter", "flights")


# -- L12 compositions ---------------------------------------------------------------------------
def l12_above_global_average(m: FlightMart) -> DataFrame:
    """Airlines whose mean delay exceeds the global mean (two aggregates,
    the global one broadcast as a single row)."""
    per = m.per_airline([], [F.avg("dep_delay_minutes").alias("__a")], _operated()).select(
        "airline_name", "__a")
    glob = m.flights().filter(_operated()).agg(F.avg("dep_delay_minutes").alias("__g"))
    return (with_totals(per, glob).filter(F.col("__a") > F.col("__g"))
            .select("airline_name", half_up("__a", 4).alias("avg_dep_delay"),
                    half_up("__g", 4).alias("global_avg")))


def l12_worst_month_per_airline(m: FlightMart) -> DataFrame:
    c = m.per_airline(["year", "month"], [half_up(F.avg("dep_delay_minutes"), 4).alias("avg_dep_delay")],
                      _operated()).select("airline_name", "year", "month", "avg_dep_delay")
    return top_n(c, 1, "avg_dep_delay", "airline_name", tie=["year", "month"], name="position")


def l12_airline_vs_network(m: FlightMart) -> DataFrame:
    """Two grouped aggregates joined (CTE x CTE): airline vs its network."""
    f = m.flights("airline").filter(_operated())
    a = f.groupBy("network_name", "airline_name").agg(F.avg("dep_delay_minutes").alias("__a"))
    n = f.groupBy("network_name").agg(F.avg("dep_delay_minutes").alias("__n"))
    return a.join(n, "network_name").select(
        "network_name", "airline_name", half_up("__a", 4).alias("airline_avg"),
        half_up("__n", 4).alias("network_avg"), half_up(F.col("__a") - F.col("__n"), 4).alias("diff"))


# -- L13 / L14 model, maker, city ----------------------------------------------------------------
def l13_by_maker(m: FlightMart, top: int = 5) -> DataFrame:
    return measure_by(m, {"flights": F.count("*"), "aircraft": F.count_distinct("model_id"),
                          "avg_co2": _avg("co2")}, ["maker"], top=top)


def l14_top_destinations(m: FlightMart, top: int = 10) -> DataFrame:
    return measure_by(m, {"flights": F.count("*"), "avg_arr_delay": _avg("arr_delay_minutes")},
                      ["dest_state", "dest_airport"], top=top)


# -- L15 extra patterns ---------------------------------------------------------------------------
def l15_delay_buckets(m: FlightMart) -> DataFrame:
    d = F.col("dep_delay_minutes")
    b = (F.when(d <= 0, "on time").when(d < 15, "minor").when(d < 60, "moderate")
         .when(d < 240, "major").otherwise("severe"))
    return m.flights().filter(_operated()).groupBy(b.alias("bucket")).agg(F.count("*").alias("flights"))


def l15_months_above_yearly_mean(m: FlightMart) -> DataFrame:
    c = m.flights().groupBy("year", "month").agg(F.count("*").alias("flights"))
    c = c.withColumn("__y", F.avg("flights").over(Window.partitionBy("year")))
    return c.filter(F.col("flights") > F.col("__y")).select(
        "year", "month", "flights", half_up("__y", 4).alias("yearly_mean"))


def l15_weekend_by_airline(m: FlightMart) -> DataFrame:
    return measure_by(m, {"weekend_flights": F.count("*")}, ["airline_name"],
                      F.col("day_of_week").isin(6, 7))


def l15_haul_buckets(m: FlightMart, long_haul: float = 50000.0) -> DataFrame:
    h = F.when(F.col("distance") >= long_haul, "long haul").otherwise("short haul")
    return (m.flights().groupBy(h.alias("haul"))
            .agg(F.count("*").alias("flights"), _avg("dep_delay_minutes").alias("avg_dep_delay")))


def l15_share_by_scalar(m: FlightMart) -> DataFrame:
    """Share of each continent in all flights via a scalar total."""
    f = m.flights("dest")
    per = f.groupBy("dest_continent").agg(F.count("*").alias("flights"))
    tot = f.agg(F.count("*").alias("__t"))
    return with_totals(per, tot).select("dest_continent", "flights",
                                        pct("flights", "__t").alias("share_pct"))


# -- further variants -------------------------------------------------------------------------------
def l04_fleet_by_month(m: FlightMart) -> DataFrame:
    """Distinct aircraft and airlines flying in each month of each year.

    One row for each (month, key) first, so that no distinct count expands the flights."""
    by = ["year", "month"]
    f = m.flights()
    tails = f.select(*by, "tail_id").distinct().groupBy(*by).agg(F.count("*").alias("aircraft"))
    lines = f.select(*by, "airline_id").distinct().groupBy(*by).agg(F.count("*").alias("airlines"))
    return tails.join(lines, by)


def l04_airline_makers(m: FlightMart) -> DataFrame:
    """Every maker that an airline flies, with its flights and aircraft."""
    per = m.flights().groupBy("airline_id", "tail_id").agg(F.count("*").alias("__n"))
    makers = m.models().select(F.col("model_id").alias("tail_id"), "maker")
    c = (per.join(makers, "tail_id").groupBy("airline_id", "maker")
         .agg(F.sum("__n").cast("long").alias("flights"), F.count("*").alias("aircraft")))
    return c.join(m.airlines().select("airline_id", "airline_name"), "airline_id").select(
        "airline_name", "maker", "flights", "aircraft")


def l05_flights_by_city_pair_state(m: FlightMart) -> DataFrame:
    """Flights and share of cancellations between origin and destination states."""
    return measure_by(m, {"flights": F.count("*"), "cancel_pct": pct(count_if(F.col("cancelled")), F.count("*"))},
                      ["origin_state", "dest_state"])


def l09_pivot_delay_by_weekday(m: FlightMart) -> DataFrame:
    """Mean departure delay of each airline on each weekday, a column a day."""
    days = [half_up(F.avg(F.when(F.col("day_of_week") == d, F.col("dep_delay_minutes").cast("double"))), 4)
            .alias(f"day{d}") for d in range(1, 8)]
    return m.per_airline([], days, _operated()).select("airline_name", *[f"day{d}" for d in range(1, 8)])


def l13_maker_ranking(m: FlightMart, by: str = "co2") -> DataFrame:
    """Makers by total CO2, total fuel or aircraft flown."""
    c = m.per_model([], [F.count("*").alias("__n"), exact_sum("co2").alias("__co2"), exact_sum("fuel_burn").alias("__fuel")])
    g = c.groupBy("maker").agg(F.sum("__n").cast("long").alias("flights"), F.count("*").alias("aircraft"),
                               half_up(F.sum(F.col("__co2").cast("decimal(28,6)")), 2).alias("co2"),
                               half_up(F.sum(F.col("__fuel").cast("decimal(28,6)")), 2).alias("fuel"))
    return rank_in(g, by, name="position")       # makers are a fixed catalogue of a few dozen


def l14_destination_ranking(m: FlightMart, by: str = "avg_arr_delay", n: int = 2) -> DataFrame:
    """The first destinations of each continent by CO2 or mean arrival delay."""
    c = measure_by(m, {"flights": F.count("*"), "avg_arr_delay": _avg("arr_delay_minutes"),
                       "co2": half_up(exact_sum("co2"), 2)}, ["dest_continent", "dest_airport"])
    return top_n(c, n, by, "dest_continent", tie="dest_airport", name="position")


def e09_mean_row_ratio(m: FlightMart) -> DataFrame:
    """The mean of each flight's own ratio (CO2 per distance), beside the ratio of the sums."""
    return m.per_airline([], [half_up(F.avg(ratio("co2", "distance")), 10).alias("mean_ratio"),
                              half_up(ratio(exact_sum("co2"), exact_sum("distance")), 10).alias("ratio_of_sums")],
                         F.col("co2").isNotNull()).select("airline_name", "mean_ratio", "ratio_of_sums")


def e11_null_as_zero(m: FlightMart) -> DataFrame:
    """Averages over all flights with a missing value as 0, and over known values."""
    return m.per_airline([], [half_up(F.avg(F.coalesce("fuel_burn", F.lit(0.0))), 6).alias("avg_null_as_zero"),
                              half_up(F.avg("fuel_burn"), 6).alias("avg_known"),
                              exact_sum(F.coalesce("fuel_burn", F.lit(0.0))).alias("sum_fuel")]).select(
        "airline_name", "avg_null_as_zero", "avg_known", "sum_fuel")


def d03_left_outer_ignoring_nulls(m: FlightMart) -> DataFrame:
    """D3: every airline, with aggregates of its diverted flights that skip the
    rows which the outer join filled with nulls."""
    f = m.flights().where("diverted").groupBy("airline_id").agg(
        F.count("*").alias("__n"), F.sum("arr_delay_minutes").alias("__delay"), F.max("distance").alias("__far"))
    c = m.airlines().join(f, "airline_id", "left")
    return c.groupBy("network_name").agg(
        F.count("*").alias("airlines"), F.count("__n").alias("airlines_with_diversions"),
        F.coalesce(F.sum("__n"), F.lit(0)).cast("long").alias("diverted"),
        half_up(ratio(F.sum("__delay"), F.sum("__n")), 4).alias("avg_delay"), half_up(F.max("__far"), 2).alias("longest"))
