"""Readers, schema registry, NOT IN null semantics, patches and formatting."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from contrail.functions.numeric import formatted
from contrail.operators.keys import not_in, numeric_key
from contrail.operators.model import apply_patch, split_by_status
from contrail.sources import schemas
from contrail.sources.files import read_delimited, with_missing_columns


def test_not_in_null_semantics(df):
    left = df([(1,), (2,), (None,)], "k int")
    assert sorted(r.k for r in not_in(left, "k", df([(2,)], "k int"), "k").collect()) == [1]
    assert not_in(left, "k", df([(2,), (None,)], "k int"), "k").count() == 0   # null on the right
    empty = df([], "k int")
    assert not_in(left, "k", empty, "k").count() == 3                          # NOT IN () keeps all


def test_patch_numeric_key_and_split(df):
    cat = df([("A388", "AIRBUS", 0.0), ("B738", "BOEING", 174200.0)], "icao string, maker string, mtow double")
    patch = df([("A388", None, 1267658.0), ("A388", None, 1.0)], "icao string, maker string, mtow double")
    got = {r.icao: (r.maker, r.mtow) for r in apply_patch(cat, patch, "icao", ["maker", "mtow"]).collect()}
    assert got["B738"] == ("BOEING", 174200.0) and got["A388"][0] == "AIRBUS"
    d = df([("12.0",), ("12",), ("x",)], "s string")
    assert [r[0] for r in d.select(numeric_key("s")).collect()] == [12, 12, None]
    parts = split_by_status(df([(True,), (False,), (False,)], "cancelled boolean"))
    assert (parts["executed"].count(), parts["cancelled"].count()) == (2, 1)


def test_formatted_text(df):
    d = df([(1234.565,), (0.125,)], "x double")
    assert [r[0] for r in d.select(formatted("x", 2, " lbs")).collect()] == ["1,234.57 lbs", "0.13 lbs"]


def test_schema_registry_order_and_keys(df):
    order = schemas.load_order()
    assert len(order) == 18 and order.index("CONTINENTE") < order.index("WAC") < order.index("ESTADO")
    assert order.index("AEROPUERTO") < order.index("VUELO") < order.index("RESULTADO")
    cont = df([("Europa",), ("Europa",)], schemas.TABLES["CONTINENTE"][0])
    wac = df([("1", "Europa"), ("2", "Asia")], schemas.TABLES["WAC"][0])
    checks = schemas.check_keys({"CONTINENTE": cont, "WAC": wac})
    assert checks["CONTINENTE.pk"].count() == 1
    assert [r.Nombre_Continente for r in checks["WAC.fk.Nombre_Continente"].collect()] == ["Asia"]


def test_delimited_reader_and_missing_columns(spark, tmp_path):
    f = tmp_path / "flights.csv"
    f.write_text("FlightDate;Tail_Number;Cancelled\n01/02/2019; n123 ;1.0\nbad;;\n")
    s = T.StructType([T.StructField(c, T.StringType()) for c in ("FlightDate", "Tail_Number", "Cancelled")])
    d = read_delimited(spark, str(f), s, columns=["FlightDate", "Cancelled"])
    rows = d.collect()
    assert d.columns == ["FlightDate", "Cancelled"] and rows[0].Cancelled == "1.0" and rows[1].Cancelled is None
    want = T.StructType([T.StructField("FlightDate", T.StringType()), T.StructField("MTOW", T.DoubleType())])
    w = with_missing_columns(d, want)
    assert w.columns == ["FlightDate", "MTOW"] and w.first().MTOW is None
    assert dict(w.dtypes)["MTOW"] == "double"


def test_bucketed_fact_join_needs_no_shuffle(spark, tmp_path):
    from contrail.sources.versioned import write_bucketed
    from contrail.sources.tables import table
    db = f"bk_{abs(hash(str(tmp_path))) % 10**8}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{tmp_path}/{db}'")
    li = table(spark, "/root/testdata/sf0.001", "lineitem").select("l_orderkey", "l_quantity")
    o = table(spark, "/root/testdata/sf0.001", "orders").select("o_orderkey", "o_custkey")
    write_bucketed(li, f"{db}.li", "l_orderkey", 4)
    write_bucketed(o, f"{db}.o", "o_orderkey", 4)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        j = spark.table(f"{db}.li").join(spark.table(f"{db}.o"), F.col("l_orderkey") == F.col("o_orderkey"))
        plan = j._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert j.count() == li.count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_report_sink_persisted_mart_and_catalogue(spark, tmp_path):
    from contrail.plans.mart import FlightMart
    from contrail.sources.versioned import catalogue, write_json_report
    m = FlightMart(spark, "/root/testdata/sf0.001")
    f = m.persisted("airline")
    assert f.storageLevel.useDisk and f.storageLevel.useMemory
    assert f.count() == m.flights("airline").count()
    f.unpersist()
    rep = spark.createDataFrame([("gbt", 0.98), ("random_forest", 0.97)], "model string, r2 double")
    write_json_report(rep, str(tmp_path / "report"))
    back = spark.read.json(str(tmp_path / "report"))
    assert sorted((r.model, r.r2) for r in back.collect()) == [("gbt", 0.98), ("random_forest", 0.97)]
    rep.createOrReplaceTempView("model_report_view")
    names = {r.name for r in catalogue(spark).collect()}
    assert "model_report_view" in names
