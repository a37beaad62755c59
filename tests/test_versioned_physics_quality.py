"""Snapshots / upserts, the physical estimator and the quality audits."""

import math
import uuid

import pandas as pd
from pyspark.sql import functions as F

from contrail.functions import physics as PH
from contrail.operators import quality as Q
from contrail.session import checkpoint_dir
from contrail.sources import versioned as V


def _base(spark):
    return f"{checkpoint_dir(spark)}/tests/{uuid.uuid4().hex}"


def test_staged_upsert_null_new_and_missing_id(df):
    base = df([(1, 1.0, 2.0), (2, 5.0, 6.0)], "id int, a double, b double")
    stage = df([(1, None, 9.0), (2, None, None), (3, 7.0, 7.0)], "id int, a_new double, b_new double")
    out = {r.id: (r.a, r.b) for r in V.staged_upsert(base, stage, "id", ["a", "b"]).collect()}
    assert out == {1: (1.0, 9.0), 2: (5.0, 6.0)}  # null never erases, no insert
    again = V.staged_upsert(V.staged_upsert(base, stage, "id", ["a", "b"]), stage, "id", ["a", "b"])
    assert {r.id: (r.a, r.b) for r in again.collect()} == out  # idempotent


def test_snapshot_restore_roundtrip(spark, df):
    base = _base(spark)
    orig = df([(1, 10.0), (2, 20.0), (3, None)], "id int, fuel double")
    path, n = V.snapshot(orig, base, ts="20240101_0000")
    assert n == 3
    _, n2 = V.snapshot(df([(9, 9.0)], "id int, fuel double"), base, ts="20240101_0000")
    assert n2 == 3  # existing snapshot kept
    changed = df([(1, 11.0), (2, 22.0), (3, 33.0), (4, 44.0)], "id int, fuel double")
    r1 = V.restore_latest(spark, base, changed, "id", ["fuel"])
    got = {r.id: r.fuel for r in r1.collect()}
    assert got == {1: 10.0, 2: 20.0, 3: None, 4: 44.0}
    r2 = V.restore_latest(spark, base, r1, "id", ["fuel"])  # restoring twice changes nothing
    assert {r.id: r.fuel for r in r2.collect()} == got
    nothing = V.restore_latest(spark, base + "-none", changed, "id", ["fuel"])
    assert nothing.count() == 4


def test_load_if_empty(spark, df):
    p = _base(spark) + "/t"
    assert V.load_if_empty(df([(1,)], "x int"), p) is True
    assert V.load_if_empty(df([(2,), (3,)], "x int"), p) is False
    assert [r.x for r in spark.read.parquet(p).collect()] == [1]


def test_engine_factor_and_validity(df):
    d = df([("turboprop", 1000.0, 60.0, False), ("Mystery", 1000.0, 60.0, False), (None, 1000.0, 60.0, False),
            ("JET", 0.0, 60.0, False), ("JET", 1000.0, 0.0, False), ("JET", 1000.0, 60.0, True)],
           "eng string, mtow double, minutes double, cancelled boolean")
    got = [r[0] for r in d.select(PH.fuel_estimate("mtow", "minutes", "eng", "cancelled")).collect()]
    full = 1000.0 * (1.0 * 0.030 + 0.012)
    assert got[0] == 0.45 * full and got[1] == full and got[2] == full
    assert got[3] is None and got[4] is None and got[5] == 0.0


def test_noise_independent_of_partitioning(spark):
    ids = spark.range(0, 2000).select(F.concat(F.lit("F"), F.col("id").cast("string")).alias("fid"))
    a = {r.fid: r.n for r in ids.repartition(3).select("fid", PH.lognormal_noise("fid").alias("n")).collect()}
    b = {r.fid: r.n for r in ids.repartition(11).select("fid", PH.lognormal_noise("fid").alias("n")).collect()}
    assert a == b
    logs = [math.log(v) for v in a.values()]
    mean = sum(logs) / len(logs)
    sd = (sum((x - mean) ** 2 for x in logs) / len(logs)) ** 0.5
    assert abs(mean) < 0.01 and abs(sd - 0.10) < 0.01


def test_features_zero_divisors(df):
    d = df([(0.0, 0.0, 0.0, 1000.0, 6)], "minutes double, engines double, miles double, mtow double, month int")
    d = d.withColumn("effort", PH.effort("mtow", "miles"))
    r = PH.add_features(d).first()
    assert (r.speed_mi_per_min, r.weight_per_engine, r.minutes_per_mile, r.effort_per_minute) == (0.0, 1000.0, 0.0, 0.0)
    assert abs(r.month_cos + 1.0) < 1e-12


def test_corr_constant_is_null_and_spearman_matches_pandas(df):
    const = df([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0)], "x double, y double")
    assert Q.corr_audit(const, "x", "y").first().pearson_corr is None
    rows = [(g, float(x), float(y)) for g, x, y in
            [("a", 1, 2), ("a", 2, 2), ("a", 2, 3), ("a", 3, 1), ("a", 5, 5), ("b", 1, 1), ("b", 1, 1),
             ("b", 2, 3), ("b", 4, 2), ("b", 4, 2), ("b", 9, 8)]]
    d = df(rows, "g string, x double, y double")
    pdf = pd.DataFrame(rows, columns=["g", "x", "y"])
    want_all = pdf["x"].rank().corr(pdf["y"].rank())
    got_all = Q.corr_audit(d, "x", "y", method="spearman").first().spearman_corr
    assert abs(got_all - want_all) < 1e-6
    for g, part in pdf.groupby("g"):
        want = part["x"].rank().corr(part["y"].rank())
        got = Q.corr_audit(d, "x", "y", ["g"], "spearman").filter(F.col("g") == g).first().spearman_corr
        assert abs(got - want) < 1e-6


def test_profiles_and_audits(df):
    d = df([(1.0, "2020-01-01", "A", 1), (2.0, "2020-01-02", "A", 1), (2.0, "x", "B", 2), (None, None, "B", 3)],
           "v double, d string, c string, k int")
    p = {r.column: r for r in Q.numeric_profile(d, ["v"]).collect()}["v"]
    assert (p["count"], p["mean"], p["min"], p["median"], p["max"], p["distinct"]) == (3, 1.6667, 1.0, 2.0, 2.0, 2)
    prof = {r.column: r.kind for r in Q.profile_columns(d, ["d", "c", "v"]).collect()}
    assert prof == {"d": "category_small", "c": "category_small", "v": "numeric"}
    assert Q.fd_violations(d, ["c"], "k").count() == 1
    coh = Q.coherence_rate(df([(3.0, 1.0), (1.0, 1.0)], "a double, b double"), "a", "b").first()
    assert (coh.incoherent, coh.incoherent_pct) == (1, 50.0)
    cv = Q.cv_of_group_means(df([("a", 1.0), ("b", 3.0)], "k string, x double"), "k", "x", 1).first()
    assert abs(cv.cv - (2 ** 0.5 / 2.0)) < 1e-6


def test_exact_percentiles_match_numpy(spark):
    import numpy as np
    rows = [("hot", 7.0)] * 300 + [("hot", float(i % 37)) for i in range(600)] + \
           [("small", v) for v in (1.0, 2.0, 2.0, 10.0)] + [("one", 5.0)]
    d = spark.createDataFrame(rows, "g string, v double")
    got = {r.g: (r.p10, r.p50, r.p99) for r in
           Q.exact_percentiles(d, "v", [0.1, 0.5, 0.99], ["g"], ["p10", "p50", "p99"], buckets=8).collect()}
    for g in ("hot", "small", "one"):
        vals = np.array([v for k, v in rows if k == g])
        want = tuple(float(np.quantile(vals, p)) for p in (0.1, 0.5, 0.99))
        assert all(abs(a - b) < 1e-9 for a, b in zip(got[g], want)), (g, got[g], want)
    glob = Q.exact_percentiles(d, "v", [0.5], names=["m"], buckets=4).first().m
    assert abs(glob - float(np.quantile(np.array([v for _, v in rows]), 0.5))) < 1e-9


def test_global_rank_matches_window_rank(df):
    from pyspark.sql import Window
    rows = [(i, None if v is None else float(v)) for i, v in enumerate([5, 3, 5, 1, 9, 9, 9, 2, None])]
    d = df(rows, "id int, v double")
    got = {r.id: r.rank for r in Q.global_rank(d, "v", buckets=3).collect()}
    want = {r.id: r.rk for r in d.filter("v IS NOT NULL").withColumn(
        "rk", F.rank().over(Window.orderBy(F.desc("v")))).collect()}
    assert {k: v for k, v in got.items() if k != 8} == want and got[8] is None
    asc = {r.id: r.rank for r in Q.global_rank(d, "v", descending=False, buckets=2).collect()}
    assert asc[3] == 1 and asc[4] == 6 and asc[0] == 4
