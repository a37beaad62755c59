"""Cleaning functions, keep-first, canonical keys and lookups on planted rows."""

import datetime as dt

from pyspark.sql import functions as F

from contrail.functions import clean as C
from contrail.operators.dedupe import dedupe_report, keep_first
from contrail.operators.keys import coverage, key_set_compare, lookup, surrogate_collisions
from contrail.operators.model import (backfill_first_valid, build_dimension, check_fk, check_unique,
                                      fk_null_audit, filter_to_parents, stack_roles)


def test_parse_date_bad_values(df):
    d = df([("15/06/2019",), ("",), ("31/02/2019",), ("junk",), (None,)], "s string")
    got = [r[0] for r in d.select(C.parse_date("s")).collect()]
    assert got == [dt.date(2019, 6, 15), None, None, None, None]


def test_float_id_text(df):
    d = df([("19690.0",), (None,), ("-1",), ("-1.0",), ("abc",), (" 20304 ",)], "s string")
    got = [r[0] for r in d.select(C.float_id_text("s")).collect()]
    assert got == ["19690", None, None, None, None, "20304"]


def test_norm_code_and_relabel(df):
    d = df([(" wn ",), ("NAN",), ("zz",), (None,)], "s string")
    got = d.select(C.norm_code("s").alias("c")).select(
        "c", C.relabel("c", {"WN": "Southwest"}).alias("lab"),
        C.relabel("c", {"WN": "Southwest"}, null_code="NA").alias("lab_na")).collect()
    assert [tuple(r) for r in got] == [("WN", "Southwest", "Southwest"), (None, None, "NA"),
                                       ("ZZ", "ZZ", "ZZ"), (None, None, "NA")]


def test_to_bool_and_flag_fill(df):
    d = df([("True",), ("1",), ("1.0",), ("false",), (None,)], "s string")
    assert [r[0] for r in d.select(C.to_bool("s")).collect()] == [True, True, True, False, False]
    assert [r[0] for r in d.select(C.flag_fill(F.when(F.col("s") == "1", "1.0"))).collect()] == [0, 1, 0, 0, 0]


def test_cancelled_and_outlier(df):
    d = df([(True, 1200.0), (False, 500000.0), (False, 500001.0)], "cancelled boolean, fuel double")
    out = d.select(C.null_above(C.zero_if("cancelled", F.col("fuel")), 500000)).collect()
    assert [r[0] for r in out] == [0.0, 500000.0, None]


def test_safe_number_and_formatted(df):
    d = df([("12.5",), ("x",), ("1,234.5",)], "s string")
    assert [r[0] for r in d.select(C.safe_number("s")).collect()] == [12.5, None, None]
    assert [r[0] for r in d.select(C.parse_formatted_number("s")).collect()] == [12.5, None, 1234.5]


def test_natural_id_null_part(df):
    d = df([("WN", dt.date(2019, 1, 2), "N1", 800), ("WN", dt.date(2019, 1, 2), None, 800)],
           "c string, d date, t string, h int")
    got = [r[0] for r in d.select(C.natural_id(["c", "d", "t", "h"], date_col="d")).collect()]
    assert got == ["WN_20190102_N1_800", None]


def test_canonical_key_dtype_independent(df):
    d = df([(102, 3.14159, dt.date(2020, 2, 29), " ab "), (None, None, None, None)],
           "i int, f double, d date, t string")
    d2 = df([(102.0, 3.14159, dt.date(2020, 2, 29), "AB")], "i double, f double, d date, t string")
    spec = [("i", "int"), ("f", "float"), ("d", "date"), ("t", "text")]
    k1 = [r[0] for r in d.select(C.canonical_key(spec)).collect()]
    k2 = d2.select(C.canonical_key(spec)).first()[0]
    assert k1[0] == "102||3.14||2020-02-29||AB" == k2
    assert k1[1] == "<NA>||<NA>||<NA>||<NA>"


def test_keep_first_with_null_key(df):
    rows = [(1, "2019-01-01", "N1", 10.0), (2, "2019-01-01", "N1", 20.0),
            (3, "2019-01-01", None, 30.0), (4, "2019-01-01", None, 40.0), (5, "2019-01-02", "N1", 50.0)]
    d = df(rows, "ingest_seq int, day string, tail string, payload double")
    kept = {r.ingest_seq for r in keep_first(d, ["day", "tail"], ["ingest_seq"]).collect()}
    assert kept == {1, 3, 5}  # nulls in the key compare equal
    rep = dedupe_report(d, ["day", "tail"]).first()
    assert (rep.rows_in, rep.rows_kept, rep.rows_removed) == (5, 3, 2)
    # idempotent
    again = keep_first(keep_first(d, ["day", "tail"], ["ingest_seq"]), ["day", "tail"], ["ingest_seq"])
    assert again.count() == 3


def test_lookup_null_safe_and_no_fanout(df):
    fact = df([(1, 102, None), (2, 102, "X"), (3, 7, "Y")], "id int, a int, b string")
    # dimension has the composite key twice (duplicated) and 102.0 written as a double
    dim = df([(102.0, None, 10), (102.0, None, 11), (102.0, "X", 12)], "a double, b string, sk int")
    spec = [("a", "int"), ("b", "text")]
    out = lookup(fact, dim, spec, "sk").orderBy("id").collect()
    assert [(r.id, r.sk) for r in out] == [(1, 10), (2, 12), (3, None)]  # 1:1, min id wins
    cov = coverage(lookup(fact, dim, spec, "sk"), "sk").first()
    assert (cov.rows, cov.matched, cov.coverage_pct) == (3, 2, 66.6667)


def test_key_set_compare(df):
    left = df([(1,), (1,), (2,), (3,)], "k int")
    right = df([(2,), (3,), (4,)], "k int")
    r = key_set_compare(left, right, "k", "k").first()
    assert (r.only_left, r.only_right, r.common, r.row_coverage_pct) == (1, 1, 2, 50.0)


def test_dimension_and_fk_checks(df):
    fact = df([("A", "x", 1), ("A", "x", 2), ("B", None, 3), ("C", "y", 4)], "code string, name string, v int")
    dim = build_dimension(fact, ["code", "name"], key="sk", key_spec=[("code", "text")])
    assert sorted(r.code for r in dim.collect()) == ["A", "C"]
    assert surrogate_collisions(dim, [("code", "text")]).first()[0] == 0
    assert check_unique(fact, ["code"]).count() == 1
    orphans = check_fk(fact, dim, ["code"])
    assert [r.code for r in orphans.collect()] == ["B"]
    assert filter_to_parents(fact, dim, ["code"]).count() == 3
    assert fk_null_audit(fact, ["name"]).first()["null_name"] == 1


def test_stack_roles_priority_and_backfill(df):
    d = df([(1, "JFK", "NY", 2, "LAX", "CA"), (2, "LAX", "California", 1, "JFK", "New York")],
           "o_id int, o_code string, o_state string, d_id int, d_code string, d_state string")
    s = stack_roles({"origin": (d, {"o_id": "id", "o_code": "code", "o_state": "state"}),
                     "dest": (d, {"d_id": "id", "d_code": "code", "d_state": "state"})}, "id")
    assert {(r.id, r.state) for r in s.collect()} == {(1, "NY"), (2, "California")}
    f = df([("a", None, 1), ("a", "n1", 2), ("a", "n2", 3), ("b", "n9", 5)], "k string, v string, o int")
    assert {(r.k, r.v) for r in backfill_first_valid(f, "k", "v", "o").collect()} == {("a", "n1"), ("b", "n9")}


def test_ids_above_2_53_stay_apart(df):
    from contrail.functions import clean as C
    from contrail.operators.keys import numeric_key
    d = df([("9007199254740993.0",), ("9007199254740992",), ("x",), (None,)], "s string")
    got = [(r[0], r[1], r[2]) for r in d.select(numeric_key("s"), C.float_id_text("s"), C.canon("s", "int")).collect()]
    assert got == [(9007199254740993, "9007199254740993", "9007199254740993"),
                   (9007199254740992, "9007199254740992", "9007199254740992"), (None, None, "<NA>"), (None, None, "<NA>")]
