"""Named views (U1) and parameterised procedures.

Views are DataFrame builders registered as temp views so SQL users can query
them.  Procedures are Python functions with typed arguments; the SQL form
binds values with ``spark.sql(text, args=...)`` named parameters, never by
formatting values into the statement text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.functions.numeric import count_if, exact_sum, half_up
from contrail.plans.mart import FlightMart


def v_flight_delay(m: FlightMart) -> DataFrame:
    return m.flights("airline").select("flight_id", "flight_date", "airline_name",
                                       "dep_delay", "arr_delay", "dep_del15", "arr_del15", "cancelled")


def v_airline_summary(m: FlightMart) -> DataFrame:
    return m.per_airline([], [
        F.count("*").alias("flights"), count_if(F.col("cancelled")).alias("cancelled"),
        half_up(F.avg(F.when(~F.col("cancelled"), F.col("dep_delay_minutes"))), 4).alias("avg_dep_delay")]
    ).select("airline_name", "airline_code", "flights", "cancelled", "avg_dep_delay")


def v_destination_geo(m: FlightMart) -> DataFrame:
    return m.flights("dest").select("flight_id", "dest_airport", "dest_state", "dest_continent")


def v_route_metrics(m: FlightMart) -> DataFrame:
    f = m.flights("airline", "dest")
    return f.groupBy("origin_airport", "dest_airport").agg(
        F.count("*").alias("flights"), half_up(F.avg("distance"), 2).alias("avg_distance"),
        half_up(F.avg("dep_delay_minutes"), 4).alias("avg_dep_delay"))


def v_taxi_per_flight(m: FlightMart) -> DataFrame:
    return m.flights().select("flight_id", "taxi_out", "taxi_in",
                              (F.col("taxi_out") + F.col("taxi_in")).alias("taxi_total"))


def v_co2_per_continent(m: FlightMart) -> DataFrame:
    f = m.flights("dest").filter(~F.col("cancelled") & F.col("co2").isNotNull())
    return f.groupBy("dest_continent").agg(half_up(exact_sum("co2"), 2).alias("total_co2"),
                                           F.count("*").alias("flights"))


VIEWS = {
    "v_flight_delay": v_flight_delay, "v_airline_summary": v_airline_summary,
    "v_destination_geo": v_destination_geo, "v_route_metrics": v_route_metrics,
    "v_taxi_per_flight": v_taxi_per_flight, "v_co2_per_continent": v_co2_per_continent,
}


def register_views(spark: SparkSession, sf_dir: str) -> list[str]:
    m = FlightMart(spark, sf_dir)
    for name, fn in VIEWS.items():
        fn(m).createOrReplaceTempView(name)
    return list(VIEWS)


# ------------------------------------------------------------------ procedures
def p_flights_to_continent(m: FlightMart, continent: str) -> DataFrame:
    f = m.flights("dest").filter(F.col("dest_continent") == F.lit(continent))
    return f.agg(F.count("*").alias("flights"))


def p_yearly_delay(m: FlightMart, year: int) -> DataFrame:
    f = m.flights().filter((F.col("year") == F.lit(year)) & ~F.col("cancelled"))
    return f.groupBy("month").agg(half_up(F.avg("dep_delay_minutes"), 4).alias("avg_dep_delay"))


def p_airline_summary(m: FlightMart, airline_code: str) -> DataFrame:
    return v_airline_summary(m).filter(F.col("airline_code") == F.lit(airline_code))


def p_delayed_over(m: FlightMart, minutes: int) -> DataFrame:
    return m.per_airline([], [F.count("*").alias("delayed_flights")],
                         ~F.col("cancelled") & (F.col("dep_delay_minutes") > F.lit(minutes))
                         ).select("airline_name", "delayed_flights")


def p_distance_group_metrics(m: FlightMart, group: int) -> DataFrame:
    f = m.flights().filter(F.col("distance_group") == F.lit(group))
    return f.agg(F.count("*").alias("flights"), half_up(F.avg("distance"), 2).alias("avg_distance"),
                 half_up(F.avg("dep_delay_minutes"), 4).alias("avg_dep_delay"))


def p_monthly_taxi(m: FlightMart, month: int) -> DataFrame:
    f = m.flights("airline").filter(F.col("month") == F.lit(month))
    return f.groupBy("origin_airport").agg(half_up(F.avg("taxi_out"), 4).alias("avg_taxi_out"),
                                           half_up(F.avg("taxi_in"), 4).alias("avg_taxi_in"))


def sql_late_flights(spark: SparkSession, sf_dir: str, airline_code: str = "7", month: int = 6,
                     tolerance: int = 100) -> DataFrame:
    """The late-flight list through Spark SQL with bound named parameters."""
    m = FlightMart(spark, sf_dir)
    m.flights("airline").createOrReplaceTempView("flight_airline")
    return spark.sql(
        "SELECT flight_id, airline_name, month, dep_delay_minutes FROM flight_airline "
        "WHERE airline_code = :code AND month = :month AND dep_delay_minutes >= :tol "
        "AND NOT cancelled",
        args={"code": airline_code, "month": month, "tol": tolerance})
