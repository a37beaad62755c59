"""Dashboard KPIs, emissions panel, correction metrics and the figure
verification battery (K26-K37)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.functions.numeric import count_if, exact_sum, half_up
from contrail.functions.physics import CO2_FACTOR, fuel_estimate
from contrail.operators.patterns import with_totals
from contrail.plans.mart import FlightMart
from contrail.plans.reports import _risk, _route_metrics, ROUTE_MIN_FLIGHTS

ALL_MONTHS = (1, 12)
# An example selection (month range and airline multi-select) for the filtered variants.
SELECTED_MONTHS = (3, 8)
SELECTED_AIRLINES = tuple(f"Supplier#{i:09d}" for i in range(1, 11))
EXCLUDED_ENGINES = ("TURBOSHAFT", "PISTON", "UNKNOWN")


def _dash_where(months):
    return F.col("month").between(int(months[0]), int(months[1]))


def _dash(m: FlightMart, months, airlines) -> DataFrame:
    """Fact rows of the selected months and airlines.  The airline selection
    is a semi join against the airlines matching the name list: that side
    has at most len(airlines) rows (the parameter bounds it), so it is
    broadcast and the fact is never shuffled for it."""
    f = m.flights().filter(_dash_where(months))
    if airlines:
        sel = m.airlines().filter(F.col("airline_name").isin(list(airlines))).select("airline_id")
        f = f.join(F.broadcast(sel), "airline_id", "left_semi")
    return f


def k26_volume_kpi(m: FlightMart, months=ALL_MONTHS, airlines: Sequence[str] | None = None) -> DataFrame:
    return _dash(m, months, airlines).agg(F.count("*").alias("total_flights"),
                                          count_if(F.col("cancelled")).alias("cancelled"))


def k27_delay_kpi(m: FlightMart, months=ALL_MONTHS, airlines: Sequence[str] | None = None) -> DataFrame:
    f = _dash(m, months, airlines).filter(~F.col("cancelled"))
    return f.agg(half_up(F.avg("dep_delay_minutes"), 4).alias("avg_dep_delay_min"))


def k28_top_delay_airlines(m: FlightMart, months=ALL_MONTHS,
                           airlines: Sequence[str] | None = None, n: int = 10) -> DataFrame:
    f = _dash(m, months, airlines).filter(~F.col("cancelled"))
    c = (f.groupBy("airline_id").agg(half_up(F.avg("dep_delay_minutes"), 4).alias("avg_delay_min"))
         .join(m.airlines(), "airline_id").select("airline_name", "avg_delay_min"))
    return c.orderBy(F.desc("avg_delay_min"), "airline_name").limit(n)


def _valid():
    return ~F.col("cancelled") & (F.col("fuel_burn") > 0)


def _per_model_totals(m: FlightMart) -> DataFrame:
    """Per aircraft: flights and exact CO2 (decimal sums add up exactly when
    re-aggregated), then the catalogue attributes."""
    return m.per_model([], [F.count("*").alias("__n"),
                            F.sum((F.col("fuel_burn") * CO2_FACTOR).cast("decimal(28,2)")).alias("__co2")],
                       _valid())


def k29_emissions_panel(m: FlightMart) -> DataFrame:
    c = m.per_model([], [
        F.count("*").alias("total_flights"),
        half_up(exact_sum(F.col("fuel_burn") * CO2_FACTOR), 2).alias("co2_lbs"),
        half_up(F.avg("fuel_burn"), 4).alias("avg_fuel_lbs"),
        half_up(F.avg("distance"), 4).alias("avg_distance")], _valid())
    return c.select("model_id", "maker", "engines", "total_flights", "co2_lbs", "avg_fuel_lbs", "avg_distance")


def k29_fleet_totals(m: FlightMart) -> DataFrame:
    t = _per_model_totals(m)
    return t.agg(half_up(F.sum("__co2").cast("double"), 2).alias("fleet_co2_lbs"),
                 F.sum("__n").cast("long").alias("flights_analysed"),
                 F.count_distinct("maker").alias("active_makers"))


def k26_volume_kpi_selected(m: FlightMart) -> DataFrame:
    return k26_volume_kpi(m, SELECTED_MONTHS, SELECTED_AIRLINES)


def k27_delay_kpi_selected(m: FlightMart) -> DataFrame:
    return k27_delay_kpi(m, SELECTED_MONTHS, SELECTED_AIRLINES)


def k28_top_delay_airlines_selected(m: FlightMart) -> DataFrame:
    return k28_top_delay_airlines(m, SELECTED_MONTHS, SELECTED_AIRLINES)


def k30_fuel_before_after(m: FlightMart, min_n: int = 50) -> DataFrame:
    """Mean fuel per model in the stored data (before) and under the physical
    estimator (after), for models with at least ``min_n`` valid flights."""
    f = m.flights("model")
    after = f.withColumn("fuel_burn", fuel_estimate("mtow", "crs_elapsed", "engine_type", "cancelled"))

    def metrics(d, tag):
        return (d.filter(~F.col("cancelled") & (F.col("fuel_burn") > 0))
                .groupBy("model_id").agg(F.count("*").alias(f"flights_{tag}"),
                                         half_up(F.avg("fuel_burn"), 4).alias(f"avg_fuel_{tag}"))
                .filter(F.col(f"flights_{tag}") >= min_n))
    return metrics(f, "before").join(metrics(after, "after"), "model_id")


def k31_global_counts(m: FlightMart) -> DataFrame:
    return m.flights().agg(F.count("*").alias("total_flights"),
                           count_if(F.col("cancelled")).alias("cancelled"),
                           count_if(F.col("diverted")).alias("diverted"),
                           count_if(F.col("dep_del15") == 1).alias("dep_delayed_15"))


def k32_mean_delays(m: FlightMart) -> DataFrame:
    f = m.flights().filter(~F.col("cancelled"))
    return f.agg(half_up(F.avg(F.col("dep_delay_minutes").cast("double")), 4).alias("avg_dep_delay_min"),
                 half_up(F.avg(F.col("arr_delay_minutes").cast("double")), 4).alias("avg_arr_delay_min"))


def k33_catalogue_sizes(m: FlightMart) -> DataFrame:
    """Scalar-subquery counts side by side: each is a one-row aggregate,
    cross joined (E19)."""
    a = m.table("supplier").agg(F.count("*").alias("airlines"))
    mo = m.table("part").agg(F.count("*").alias("models"))
    orig, dest = m.used_airports()
    ap = orig.agg(F.count_distinct("origin_airport_id").alias("origin_airports")).crossJoin(
        dest.agg(F.count_distinct("dest_airport_id").alias("dest_airports")))
    return with_totals(with_totals(a, mo), ap)


def k34_emission_totals(m: FlightMart) -> DataFrame:
    t = _per_model_totals(m)
    return t.agg(half_up(F.sum("__co2").cast("double"), 2).alias("total_co2_lbs"),
                 F.sum("__n").cast("long").alias("valid_fuel_flights"),
                 F.count_distinct("maker").alias("active_makers"))


def k35_top_models_co2(m: FlightMart, n: int = 5) -> DataFrame:
    t = _per_model_totals(m).select("model_id", half_up(F.col("__co2").cast("double"), 2).alias("co2_lbs"))
    return t.orderBy(F.desc("co2_lbs"), "model_id").limit(n)


def k35_top_airlines_co2(m: FlightMart, n: int = 3) -> DataFrame:
    """Both CO2 definitions side by side: the stored co2 column and
    fuel x 3.16."""
    c = m.per_airline([], [half_up(exact_sum("co2"), 2).alias("co2_column"),
                           half_up(exact_sum(F.col("fuel_burn") * CO2_FACTOR), 2).alias("co2_fuel_x316")],
                      where=~F.col("cancelled") & (F.col("fuel_burn") > 0)
                      ).select("airline_name", "co2_column", "co2_fuel_x316")
    return c.orderBy(F.desc("co2_fuel_x316"), "airline_name").limit(n)


def k36_route_risk_distribution(m: FlightMart, min_flights: int = ROUTE_MIN_FLIGHTS) -> DataFrame:
    from pyspark.sql import Window
    c = _route_metrics(m, min_flights).withColumn("risk_level", _risk(F.col("__rate"), F.col("__delay")))
    d = c.groupBy("risk_level").agg(F.count("*").alias("routes"))
    return d.withColumn("evaluated_routes", F.sum("routes").over(Window.partitionBy()))


def k37_simulator_catalogue(m: FlightMart) -> DataFrame:
    mo = m.models()
    return (mo.filter((F.col("mtow") > 0) & F.col("engine_type").isNotNull()
                      & ~F.upper(F.col("engine_type")).isin(list(EXCLUDED_ENGINES)))
            .select("model_id", "maker", "engine_type", "engines", "mtow").distinct())
