"""ETL, key-repair and data-quality jobs run on the test tables (2.A-2.D, 2.M).

The raw flight CSV is not available, so each operator runs on the table that
plays its role (see ``plans/mart.py``): ``lineitem`` for de-duplication and
canonical keys, ``orders`` for text coercions, the flight mart for lookups,
audits and the staged correction.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.functions import clean as C
from contrail.functions.numeric import half_up
from contrail.functions.physics import co2_from_fuel, fuel_estimate
from contrail.operators import quality as Q
from contrail.operators.dedupe import dedupe_report, keep_first
from contrail.operators.keys import (coverage, key_set_compare, lookup, not_in, numeric_key,
                                    surrogate_collisions)
from contrail.operators.model import (apply_patch, backfill_first_valid, build_dimension,
                                      fk_null_audit, stack_roles)
from contrail.plans.mart import FlightMart
from contrail.sources.versioned import staged_upsert

DEDUPE_KEY = ["l_orderkey", "l_linenumber"]
DEDUPE_ORDER = ["l_partkey", "l_suppkey", "l_shipdate"]
CANON_SPEC = [("l_shipdate", "date"), ("l_linenumber", "int"), ("l_extendedprice", "float"),
              ("l_returnflag", "text"), ("l_quantity", "int")]
ROUTE_SPEC = [("origin_airport", "text"), ("dest_airport", "text"), ("distance_group", "int")]
# fixed value: priority code -> label (partial on purpose: unknown codes keep the code)
PRIORITY_LABELS = {"1": "urgent", "2": "high", "3": "medium"}


def b10_keep_first(m: FlightMart) -> DataFrame:
    li = m.table("lineitem")
    return keep_first(li, DEDUPE_KEY, DEDUPE_ORDER).select(
        *DEDUPE_KEY, "l_partkey", "l_suppkey", "l_quantity")


def b10_dedupe_report(m: FlightMart) -> DataFrame:
    return dedupe_report(m.table("lineitem"), DEDUPE_KEY)


def b15_canonical_keys(m: FlightMart) -> DataFrame:
    return m.table("lineitem").select("l_orderkey", "l_partkey", "l_suppkey",
                                      C.canonical_key(CANON_SPEC).alias("canon_key"))


def b_clean_orders(m: FlightMart) -> DataFrame:
    """Text coercions on order fields rendered as raw text: date text back to
    a date, float-looking ids to clean id text, codes trimmed / upper-cased,
    code -> label with fallback, numeric text back to numbers."""
    o = m.table("orders")
    return o.select(
        "o_orderkey",
        C.parse_date(F.date_format("o_orderdate", "dd/MM/yyyy")).alias("order_date"),
        C.float_id_text(F.col("o_custkey").cast("double").cast("string")).alias("cust_code"),
        C.norm_code(F.substring("o_orderpriority", 3, 20)).alias("priority"),
        C.relabel(F.substring("o_orderpriority", 1, 1), PRIORITY_LABELS).alias("priority_label"),
        C.safe_number(F.col("o_totalprice").cast("string")).alias("total_price"),
        C.to_bool(F.when(F.col("o_orderstatus") == "F", "True").otherwise("0")).alias("finished"))


def b25_quantile_trim(m: FlightMart, lo: float = 0.001, hi: float = 0.999) -> DataFrame:
    li = m.table("lineitem")
    b = Q.exact_percentiles(li, "l_extendedprice", [lo, hi], names=["__lo", "__hi"])
    k = li.crossJoin(F.broadcast(b)).filter(F.col("l_extendedprice").between(F.col("__lo"), F.col("__hi")))
    return k.groupBy(half_up("__lo", 4).alias("lower_bound"), half_up("__hi", 4).alias("upper_bound")) \
            .agg(F.count("*").alias("rows_kept"))


def _routes(m: FlightMart):
    f = m.flights("airline", "dest")
    dim = build_dimension(f, ["origin_airport", "dest_airport", "distance_group"],
                          key="route_id", key_spec=ROUTE_SPEC)
    return f, dim


def d13_route_lookup_coverage(m: FlightMart) -> DataFrame:
    f, dim = _routes(m)
    looked = lookup(f.select("flight_id", "origin_airport", "dest_airport", "distance_group"),
                    dim, ROUTE_SPEC, "route_id")
    cov = coverage(looked, "route_id", "route")
    return cov.crossJoin(surrogate_collisions(dim, ROUTE_SPEC)).crossJoin(
        fk_null_audit(looked, ["route_id"]).select("null_route_id"))


def d17_key_sets(m: FlightMart) -> DataFrame:
    a = key_set_compare(m.table("lineitem"), m.table("part"), "l_partkey", "p_partkey") \
        .withColumn("pair", F.lit("lineitem.l_partkey~part"))
    b = key_set_compare(m.table("orders"), m.table("customer"), "o_custkey", "c_custkey") \
        .withColumn("pair", F.lit("orders.o_custkey~customer"))
    return a.unionByName(b)


def h2_airport_roles(m: FlightMart) -> DataFrame:
    orig, dest = m.used_airports()
    return stack_roles({"origin": (orig, {"origin_airport_id": "airport_id", "origin_airport": "airport",
                                          "origin_state": "state"}),
                        "dest": (dest, {"dest_airport_id": "airport_id", "dest_airport": "airport",
                                        "dest_state": "state"})}, "airport_id")


def m4_first_destination(m: FlightMart) -> DataFrame:
    f = m.flights("dest").withColumn("__ord", F.struct("flight_date", "flight_id"))
    return backfill_first_valid(f, "airline_id", "dest_airport", "__ord")


def m7_coherence(m: FlightMart) -> DataFrame:
    return Q.coherence_rate(m.flights(), "actual_elapsed", "crs_elapsed", 1.5, ~F.col("cancelled"))


def m8_fuel_profile_by_maker(m: FlightMart) -> DataFrame:
    f = m.flights("model").filter(~F.col("cancelled") & (F.col("fuel_burn") > 0))
    return Q.group_profile(f, "maker", "fuel_burn", 50)


def m8_cv_of_model_means(m: FlightMart, min_n: int = 50) -> DataFrame:
    f = m.flights("model").filter(~F.col("cancelled") & (F.col("fuel_burn") > 0))
    est = m.flights("model").withColumn(
        "fuel_est", fuel_estimate("mtow", "crs_elapsed", "engine_type", "cancelled"))
    a = Q.cv_of_group_means(f, "model_id", "fuel_burn", min_n).withColumnsRenamed(
        {"groups": "groups_stored", "cv": "cv_stored"})
    b = Q.cv_of_group_means(est.filter(~F.col("cancelled")), "model_id", "fuel_est", min_n) \
        .withColumnsRenamed({"groups": "groups_physical", "cv": "cv_physical"})
    return a.crossJoin(b)


def m9_pearson(m: FlightMart, by=()) -> DataFrame:
    f = m.flights("model").filter(~F.col("cancelled"))
    return Q.corr_audit(f, "distance", "fuel_burn", by)


def m9_spearman(m: FlightMart, by=()) -> DataFrame:
    f = m.flights("model").filter(~F.col("cancelled"))
    return Q.corr_audit(f, "distance", "fuel_burn", by, "spearman")


def m10_signal_gate(m: FlightMart, min_n: int = 50) -> DataFrame:
    f = m.flights("model").filter(~F.col("cancelled") & (F.col("fuel_burn") > 0))
    c = Q.corr_audit(f, "distance", "fuel_burn")
    v = Q.cv_of_group_means(f, "model_id", "fuel_burn", min_n)
    return c.crossJoin(v).withColumn("has_signal", Q.signal_gate(F.col("pearson_corr"), F.col("cv")))


def m12_fd_audit(m: FlightMart) -> DataFrame:
    """Functional dependencies: model -> MTOW (must hold) and the
    non-unique line key -> part (does not hold)."""
    a = Q.fd_violations(m.flights("model"), ["model_id"], "mtow").agg(
        F.count("*").alias("model_mtow_violations"))
    b = Q.fd_violations(m.table("lineitem"), DEDUPE_KEY, "l_partkey").agg(
        F.count("*").alias("line_key_part_violations"))
    nonpos = m.flights().agg(F.count_if(F.col("distance") <= 0).alias("non_positive_distance"))
    return a.crossJoin(b).crossJoin(nonpos)


def m13_numeric_profile(m: FlightMart) -> DataFrame:
    return Q.numeric_profile(m.table("lineitem"), ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])


def m14_profile_columns(m: FlightMart) -> DataFrame:
    o = m.table("orders").select("o_orderstatus", "o_orderpriority",
                                 F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_day"),
                                 "o_totalprice")
    return Q.profile_columns(o)


def a11_staged_correction(m: FlightMart) -> DataFrame:
    """The physical fuel correction applied as a staged upsert on the flight
    results: new fuel / CO2 where the estimator has a value, old elsewhere."""
    f = m.flights("model")
    base = f.select("flight_id", "fuel_burn", "co2")
    est = fuel_estimate("mtow", "crs_elapsed", "engine_type", "cancelled")
    stage = f.select("flight_id", est.alias("fuel_burn_new"), co2_from_fuel(est).alias("co2_new"))
    out = staged_upsert(base, stage, "flight_id", ["fuel_burn", "co2"])
    return out.select("flight_id", half_up("fuel_burn", 4).alias("fuel_burn"),
                      half_up("co2", 4).alias("co2"))


def c5_not_in(m: FlightMart, min_balance: float = 9900.0) -> DataFrame:
    """Suppliers whose nation is NOT IN the nations of high-balance customers."""
    rich = m.table("customer").filter(F.col("c_acctbal") > min_balance)
    return not_in(m.table("supplier"), "s_nationkey", rich, "c_nationkey").select("s_suppkey", "s_name")


def c7_name_patterns(m: FlightMart) -> DataFrame:
    """LIKE prefix / suffix / contains / OR of LIKEs over model names."""
    p = m.table("part")
    n = F.col("p_name")
    return p.groupBy("p_type").agg(
        F.count_if(n.startswith("small")).alias("prefix_small"),
        F.count_if(n.endswith("widget")).alias("suffix_widget"),
        F.count_if(n.contains("red")).alias("contains_red"),
        F.count_if(n.like("a%") | n.like("b%")).alias("a_or_b"))


def d4_left_join_default(m: FlightMart, min_engines: int = 25) -> DataFrame:
    """Flights per maker of a restricted catalogue (left join, missing ->
    'Unlisted')."""
    listed = m.models().filter(F.col("engines") > min_engines).select(
        F.col("model_id").alias("tail_id"), "maker")
    f = m.flights().join(listed, "tail_id", "left")
    return f.groupBy(F.coalesce("maker", F.lit("Unlisted")).alias("maker")).agg(F.count("*").alias("flights"))


# fixed values: literal catalogue corrections (model id -> maker, MTOW)
PATCH = [(i, "PATCHED", 1000.0 + i) for i in range(16)]


def b17_patched_catalogue(m: FlightMart) -> DataFrame:
    patch = m.spark.createDataFrame(PATCH, "model_id bigint, maker string, mtow double")
    return apply_patch(m.models(), patch, "model_id", ["maker", "mtow"]).select("model_id", "maker", "mtow")


def d18_numeric_key_join(m: FlightMart) -> DataFrame:
    """Order customer keys rendered as '123.0' text joined to customer keys
    rendered as '123' (numeric normalisation on both sides)."""
    o = m.table("orders").select("o_orderkey", F.format_string("%.1f", F.col("o_custkey").cast("double")).alias("ck"))
    c = m.table("customer").select(F.col("c_custkey").cast("string").alias("ck2"), "c_mktsegment")
    j = o.join(c, numeric_key("ck") == numeric_key("ck2"))
    return j.groupBy("c_mktsegment").agg(F.count("*").alias("orders"))
