"""Driver contract, oracle agreement on a sample, and partition-independence."""

import math
import re

import duckdb
import pytest

import __spark_entry__ as E
import oracle_queries
from contrail.sources.tables import TABLES

from conftest import SF_SMALL

SAMPLE = ["k04_top_airlines", "k08_airline_quarter_matrix", "k13_punctuality_quartiles",
          "k15_quarter_over_quarter", "k24_route_risk", "l08_monthly_windows", "l09_pivot_count_by_continent",
          "b10_keep_first", "b15_canonical_keys", "d13_route_lookup_coverage", "m9_spearman",
          "k03_airline_size_class", "k06_codeshare", "k07_state_connectivity", "k11_schedule_deviation",
          "k17_rank_in_network", "k20_share_system_alliance", "k26_volume_kpi", "a11_staged_correction",
          "l13_makers_by_co2", "e11_null_as_zero", "d03_left_outer_ignoring_nulls",
          "o4_stratified_split", "o6_integrity_gate", "o6_gate_on_drafts", "o8_problem_frequency", "o9_extract_code",
          "o11_rewritten_drafts", "o12_repaired_chains", "n9_baseline_metrics", "p2_stream_daily_totals"]


def _norm(v):
    if isinstance(v, float):
        return round(v, 9)
    return v


def _rows(rows, cols):
    return sorted((tuple("<null>" if r[c] is None else _norm(r[c]) for c in cols) for r in rows), key=repr)


def test_entry_runs(spark):
    d = E.entry(spark)
    rows = d.collect()
    assert len(rows) == 3 and d.columns == ["ranking", "airline_name", "total_flights", "aircraft_used",
                                            "share_pct", "share_level"]


def test_oracle_keys_subset_of_queries():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_optional_queries_come_and_go(monkeypatch):
    """Without the optional parts, or a library that they need, the rest is as it is; with them they are added."""
    def missing(name, load=E.importlib.import_module):
        if name.startswith("contrail.llm"):
            raise ImportError("no library of that name")
        return load(name)

    monkeypatch.setattr(E.importlib, "import_module", missing)
    bare, twins = set(E.queries()), set(E.oracle_sql())
    assert not any(re.match(r"op\d+_|pipeline", k) for k in bare | twins)
    monkeypatch.undo()
    assert bare <= set(E.queries())


@pytest.mark.parametrize("name", SAMPLE)
def test_matches_oracle_sf0001(spark, duck, name):
    sdf = E.queries()[name](spark, SF_SMALL)
    cols = sdf.columns
    rel = duck.sql(oracle_queries.all_queries()[name])
    assert sorted(rel.columns) == sorted(cols)
    orows = [dict(zip(rel.columns, r)) for r in rel.fetchall()]
    assert _rows(sdf.collect(), cols) == _rows(orows, cols)


@pytest.mark.parametrize("name", ["k06_codeshare", "k16_top_origin_airports", "l12_worst_month_per_airline",
                                  "o3_cap_per_family", "m9_spearman"])
def test_same_result_any_shuffle_partitions(spark, name):
    fn = E.queries()[name]
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        a = fn(spark, SF_SMALL)
        ra = _rows(a.collect(), a.columns)
        spark.conf.set("spark.sql.shuffle.partitions", "13")
        b = fn(spark, SF_SMALL)
        rb = _rows(b.collect(), b.columns)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert ra == rb


def test_ml_split_and_metrics(df):
    from contrail.operators import ml as ML
    d = df([(f"id{i}", float(i)) for i in range(1000)], "id string, y double")
    s = ML.hash_split(d, "id")
    n_train = s.filter("split = 'train'").count()
    assert 700 < n_train < 900
    assert sorted(r.id for r in ML.hash_split(d.repartition(7), "id").filter("split='train'").collect()) == \
        sorted(r.id for r in s.filter("split='train'").collect())
    m = ML.regression_metrics(df([(1.0, 2.0), (3.0, 3.0), (5.0, 4.0)], "y double, p double"), "y", "p").first()
    assert m.mae == round(2 / 3, 4) and m.rmse == round(math.sqrt(2 / 3), 4)
    assert m.r2 == round(1 - 2 / 8, 6)


@pytest.mark.parametrize("name", ["p2_stream_daily_totals", "k19_daily_running_total", "p1_stream_dedupe"])
def test_session_time_zone_does_not_matter(spark, duck, name):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        sdf = E.queries()[name](spark, SF_SMALL)
        cols = sdf.columns
        got = _rows(sdf.collect(), cols)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    rel = duck.sql(oracle_queries.all_queries()[name])
    assert got == _rows([dict(zip(rel.columns, r)) for r in rel.fetchall()], cols)
