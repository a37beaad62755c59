"""The flight mart: one row per flight, dimensions joined per join chain.

The flight data itself is not available, so the flight roles are played by the
TPC-H-like test tables.  The mapping is fixed here and mirrored exactly by the
SQL oracle (``oracle_queries.py``):

==========================  ==================================================
flight role                 test-table stand-in
==========================  ==================================================
flight (VUELO+RESULTADO)    lineitem JOIN orders ON l_orderkey = o_orderkey
flight_id (natural id)      airline _ yyyyMMdd(flight_date) _ tail _ order _ yyyyMMdd(shipdate) _ line
flight_date / y / q / m / d o_orderdate
dep_delay (signed)          days between o_orderdate and l_shipdate
arr_delay (signed)          dep_delay - (int(l_quantity) - 25)
*_delay_minutes, *_del15    greatest(delay, 0), delay >= 15
cancelled / diverted        l_returnflag = 'R' / o_orderstatus = 'P'
fuel_burn                   0 if cancelled, null if l_discount = 0, l_quantity
co2                         0 if cancelled, null if l_tax = 0, l_quantity*3.16
distance, distance_group    l_extendedprice, floor(l_extendedprice / 10000)
crs_elapsed                 l_extendedprice / 500
actual_elapsed              l_extendedprice*(1-l_discount)*(1+l_tax)/500
                            + (l_linenumber - 3) * 10
taxi_out / taxi_in (int)    int(l_quantity) / l_linenumber
airline (operating)         supplier; network = supplier nation;
                            alliance = supplier region
aircraft tail = model       part: maker p_brand, model p_name, engine p_type,
                            engines p_size, MTOW p_retailprice
origin airport/state        supplier nation / its region (continent = region)
destination airport/state   customer nation / its region
code-share flight           supplier nation <> customer nation
==========================  ==================================================

Scale notes.  ``lineitem JOIN orders`` is the one fact-fact join; it
sort-merge joins on the order key (or runs shuffle-free when both sides are
bucketed by it, see ``sources.versioned.write_bucketed``).  Dimensions are
joined only when a report asks for their chain, so Catalyst never scans a
dimension a report does not use.  ``region`` and ``nation`` are fixed-size
(5 / 25 rows) and are broadcast explicitly; supplier, customer and part grow
with the data, so the join strategy for them is left to the planner's size
estimate and to AQE's runtime re-plan instead of a hint.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.functions.clean import natural_id
from contrail.session import checkpoint_dir
from contrail.sources.tables import table

CO2_PER_LB_FUEL = 3.16  # fixed value: lbs of CO2 per lb of jet fuel


def flights(spark: SparkSession, sf_dir: str, customers: DataFrame | None = None) -> DataFrame:
    """Fact rows with every flight measure; no dimension joined yet, or only ``customers`` (cust_id and others)."""
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus")
    if customers is not None:
        o = o.join(customers, F.col("o_custkey") == F.col("cust_id")).drop("cust_id")
    f = li.join(o, li.l_orderkey == o.o_orderkey, "inner")
    d = F.to_date("o_orderdate")
    dep = F.datediff(F.to_date("l_shipdate"), d)
    arr = dep - (F.col("l_quantity").cast("int") - F.lit(25))
    cancelled = F.col("l_returnflag") == "R"
    return f.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("tail_id"),
        F.col("l_suppkey").alias("airline_id"),
        F.col("o_custkey").alias("cust_id"),
        natural_id(["l_suppkey", F.date_format(d, "yyyyMMdd"), "l_partkey", "l_orderkey",
                    F.date_format("l_shipdate", "yyyyMMdd"), "l_linenumber"]).alias("flight_id"),
        d.alias("flight_date"),
        F.year(d).alias("year"), F.quarter(d).alias("quarter"),
        F.month(d).alias("month"), F.dayofmonth(d).alias("day_of_month"),
        (F.weekday(d) + 1).alias("day_of_week"),
        dep.alias("dep_delay"),
        F.greatest(dep, F.lit(0)).alias("dep_delay_minutes"),
        (dep >= 15).cast("int").alias("dep_del15"),
        arr.alias("arr_delay"),
        F.greatest(arr, F.lit(0)).alias("arr_delay_minutes"),
        (arr >= 15).cast("int").alias("arr_del15"),
        cancelled.alias("cancelled"),
        (F.col("o_orderstatus") == "P").alias("diverted"),
        F.when(cancelled, F.lit(0.0)).when(F.col("l_discount") == 0, F.lit(None))
         .otherwise(F.col("l_quantity")).alias("fuel_burn"),
        F.when(cancelled, F.lit(0.0)).when(F.col("l_tax") == 0, F.lit(None))
         .otherwise(F.col("l_quantity") * CO2_PER_LB_FUEL).alias("co2"),
        F.col("l_extendedprice").alias("distance"),
        F.floor(F.col("l_extendedprice") / 10000).cast("int").alias("distance_group"),
        (F.col("l_extendedprice") / 500).alias("crs_elapsed"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax")) / 500
         + (F.col("l_linenumber") - 3) * 10).alias("actual_elapsed"),
        F.col("l_quantity").cast("int").alias("taxi_out"),
        F.col("l_linenumber").alias("taxi_in"),
        *([c for c in customers.columns if c != "cust_id"] if customers is not None else []),
    )


def _geo(spark, sf_dir, prefix: str) -> DataFrame:
    """nation + region as an airport/state/continent dimension (30 rows max,
    fixed by the schema, so a broadcast is always safe)."""
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    g = n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey).select(
        F.col("n_nationkey").alias(f"{prefix}_airport_id"),
        F.col("n_name").alias(f"{prefix}_airport"),
        F.col("r_regionkey").alias(f"{prefix}_state_id"),
        F.col("r_name").alias(f"{prefix}_state"),
        F.col("r_name").alias(f"{prefix}_continent"))
    return F.broadcast(g)


def airlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AEROLINEA with its network (nation) and alliance (region)."""
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    nr = F.broadcast(n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey))
    return s.join(nr, s.s_nationkey == nr.n_nationkey).select(
        F.col("s_suppkey").alias("airline_id"),
        F.col("s_name").alias("airline_name"),
        F.col("s_suppkey").cast("string").alias("airline_code"),
        F.col("n_nationkey").alias("network_id"),
        F.col("n_name").alias("network_name"),
        F.col("r_name").alias("alliance_name"),
        F.col("n_nationkey").alias("origin_airport_id"),
        F.col("n_name").alias("origin_airport"),
        F.col("r_name").alias("origin_state"),
        F.col("r_name").alias("origin_continent"))


def destinations(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    g = _geo(spark, sf_dir, "dest")
    return c.join(g, c.c_nationkey == g.dest_airport_id).select(
        F.col("c_custkey").alias("cust_id"), "dest_airport_id", "dest_airport",
        "dest_state", "dest_continent")


def models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MODELO_DE_AVION (= AERONAVE here: one tail per model)."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("model_id"), F.col("p_brand").alias("maker"),
        F.col("p_name").alias("model_name"), F.col("p_type").alias("engine_type"),
        F.col("p_size").alias("engines"), F.col("p_retailprice").alias("mtow"))


AIRLINE_ATTRS = ("airline_name", "airline_code", "network_id", "network_name", "alliance_name",
                 "origin_airport_id", "origin_airport", "origin_state", "origin_continent")
# attributes that identify a single airline (grouping by them needs no re-aggregation)
AIRLINE_IDENTITY = ("airline_name", "airline_code")


class FlightMart:
    """Builds the flight fact with exactly the join chains a report needs."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return table(self.spark, self.sf_dir, name)

    def flights(self, *chains: str, dest_first: bool = False) -> DataFrame:
        """chains: any of 'airline' (incl. origin geography), 'dest', 'model'.  ``dest_first`` joins the
        customers to the orders before the flights: where they are too many for a broadcast, the orders
        are shuffled by customer and not the flights.

        The growing dimension (supplier / customer) is joined on its projected
        key columns alone and the fixed-size nation / region geography is
        attached afterwards as a broadcast.  Pre-joining the two would make the
        planner (no CBO) estimate the dimension as the product of both sizes
        and fall back to a sort-merge join even when the dimension is small."""
        customers = table(self.spark, self.sf_dir, "customer").select(
            F.col("c_custkey").alias("cust_id"), F.col("c_nationkey").alias("__c_nation"))
        dest_first = dest_first and "dest" in chains
        f = flights(self.spark, self.sf_dir, customers if dest_first else None)
        if "airline" in chains:
            s = table(self.spark, self.sf_dir, "supplier").select(
                F.col("s_suppkey").alias("airline_id"), F.col("s_name").alias("airline_name"),
                F.col("s_suppkey").cast("string").alias("airline_code"),
                F.col("s_nationkey").alias("__s_nation"))
            g = _geo(self.spark, self.sf_dir, "origin")
            f = (f.join(s, "airline_id").join(g, F.col("__s_nation") == F.col("origin_airport_id"))
                 .withColumn("network_id", F.col("origin_airport_id"))
                 .withColumn("network_name", F.col("origin_airport"))
                 .withColumn("alliance_name", F.col("origin_state"))
                 .drop("__s_nation", "origin_state_id"))
        if "dest" in chains:
            g = _geo(self.spark, self.sf_dir, "dest")
            f = ((f if dest_first else f.join(customers, "cust_id")).join(g, F.col("__c_nation") == F.col("dest_airport_id"))
                 .drop("__c_nation", "dest_state_id"))
        if "model" in chains:
            f = f.join(models(self.spark, self.sf_dir), F.col("tail_id") == F.col("model_id"))
        return f

    def airlines(self) -> DataFrame:
        return airlines(self.spark, self.sf_dir)

    def persisted(self, *chains: str) -> DataFrame:
        """The flight fact (with the given chains) kept across reports
        of one session (MEMORY_AND_DISK, so it spills instead of failing and
        is recomputed from lineage if an executor is lost).  Call
        ``unpersist()`` on it when the session's reports are done."""
        from pyspark import StorageLevel
        return self.flights(*chains).persist(StorageLevel.MEMORY_AND_DISK)

    def settled(self, df: DataFrame, name: str) -> DataFrame:
        """``df`` written once to a fresh folder below the shared one and read back, for an aggregate that
        several steps read: each of them would join and shuffle the flights again."""
        path = f"{checkpoint_dir(self.spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def per_airline(self, keys, aggs, where=None, chains=()) -> DataFrame:
        """Eager aggregation: group the fact by ``airline_id`` plus fact-side
        ``keys``, then attach the airline attributes.  Only per-(airline, key)
        partial aggregates are shuffled and joined, never the detail rows, so
        neither a large airline dimension nor a hot airline holding a third
        of the flights makes a task receive the raw fact.  Exact for any
        aggregate because every airline attribute depends on airline_id."""
        f = self.flights(*chains)
        if where is not None:
            f = f.filter(where)
        keys = [k for k in keys if k not in AIRLINE_ATTRS]
        a = f.groupBy("airline_id", *keys).agg(*aggs)
        return a.join(self.airlines(), "airline_id")

    def models(self) -> DataFrame:
        return models(self.spark, self.sf_dir)

    def per_model(self, keys, aggs, where=None) -> DataFrame:
        """Eager aggregation on the aircraft chain: group the fact by
        ``tail_id`` (+ fact keys), then inner-join the model catalogue, so the
        catalogue join sees one row per aircraft instead of every flight."""
        f = self.flights()
        if where is not None:
            f = f.filter(where)
        a = f.groupBy("tail_id", *keys).agg(*aggs)
        return a.join(self.models(), F.col("tail_id") == F.col("model_id")).drop("tail_id")

    def used_airports(self) -> tuple[DataFrame, DataFrame]:
        """Origin and destination airport rows actually used by flights,
        found from the distinct foreign keys of the fact (airline, customer)
        so the fact itself is never pushed through the dimension joins."""
        f = self.flights()
        orig = f.select("airline_id").distinct().join(self.airlines(), "airline_id") \
            .select("origin_airport_id", "origin_airport", "origin_state").distinct()
        dest = f.select("cust_id").distinct().join(destinations(self.spark, self.sf_dir), "cust_id") \
            .select("dest_airport_id", "dest_airport", "dest_state").distinct()
        return orig, dest

    def airports(self) -> DataFrame:
        """AEROPUERTO with its state / continent chain."""
        return _geo(self.spark, self.sf_dir, "a").select(
            F.col("a_airport_id").alias("airport_id"), F.col("a_airport").alias("airport"),
            F.col("a_state").alias("state"), F.col("a_continent").alias("continent"))
