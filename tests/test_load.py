"""The load: dense keys, levels, rejects, lookups with gaps, the second load."""

import time

import pytest
from pyspark.sql import functions as F

from contrail.operators.keys import dense_keys, key_ids, lookup, with_ids
from contrail.plans import load as L
from contrail.plans.mart import FlightMart
from contrail.session import checkpoint_dir, freed_shuffles
from contrail.sources.schemas import TABLES
from conftest import SF_SMALL

SPEC = [("a", "text"), ("b", "int")]


def numbered(spark, rows, parts, path, known=None):
    d = spark.createDataFrame(rows, "a string, b double").repartition(parts)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        return dense_keys(d, SPEC, "id", path, known)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_dense_keys_are_gapless_and_stable(spark, tmp_path):
    rows = [(f"k{i % 97}", float(i % 5)) for i in range(900)] + [(None, 1.0), (None, None), (" k1 ", 1.0), ("K1", 1.0)]
    got = {}
    for parts in (3, 13):
        made = numbered(spark, rows, parts, str(tmp_path / f"p{parts}")).collect()
        assert sorted(r.id for r in made) == list(range(1, len(made) + 1))
        got[parts] = {(r.a and r.a.strip().upper(), r.b): r.id for r in made}
        assert len(got[parts]) == len(made)                     # ' k1 ' and 'K1' are one key, nulls are keys
    assert got[3] == got[13]
    again = numbered(spark, rows[:5], 2, str(tmp_path / "p3")).count()      # the same folder: taken as it is
    assert again == len(got[3])


def test_a_second_load_keeps_keys_and_appends(spark, tmp_path):
    first = numbered(spark, [("b", 1.0), ("d", 1.0)], 2, str(tmp_path / "one"))
    rows = [("a", 1.0), ("b", 1.0), ("c", 1.0), ("d", 1.0), ("b", 1.0)]
    both = {r.a: r.id for r in numbered(spark, rows, 3, str(tmp_path / "two"), known=first).collect()}
    assert both == {"b": 1, "d": 2, "a": 3, "c": 4}
    same = numbered(spark, rows[:0], 3, str(tmp_path / "three"), known=first)
    assert {r.a: r.id for r in same.collect()} == {"b": 1, "d": 2}
    assert numbered(spark, [], 3, str(tmp_path / "four")).count() == 0


def test_lookup_with_gaps_and_nulls(spark, tmp_path):
    dim = numbered(spark, [("x", 1.0), (None, 2.0)], 2, str(tmp_path / "dim"))
    fact = spark.createDataFrame([(1, " X", 1.0), (2, None, 2.0), (3, "y", 1.0), (4, None, None)], "n int, a string, b double")
    got = {r.n: r.id for r in lookup(fact, dim, SPEC, "id").collect()}
    assert got[1] and got[2] and got[1] != got[2] and got[3] is None and got[4] is None


def test_ids_by_raw_keys_are_those_of_the_lookup(spark, tmp_path):
    """Odd writings of a key, nulls, and keys that the dimension lacks; key texts once a distinct key."""
    dim = numbered(spark, [("x", 1.0), (None, 2.0), ("z", None), ("w", 0.0)], 2, str(tmp_path / "dim"))
    rows = [(i, a, b) for i, (a, b) in enumerate([(" X", 1.0), ("x", 1.0), (None, 2.0), ("y", 1.0), (None, None), ("Z ", None),
                                                  ("w", -0.0), ("w", float("nan")), ("nan", 2.0)] * 3)]
    fact = spark.createDataFrame(rows, "n int, a string, b double")
    want = {r.n: r.id for r in lookup(fact, dim, SPEC, "id").collect()}
    key_ids(fact.select("a", "b").distinct(), dim, SPEC, "id").write.parquet(str(tmp_path / "ids"))
    ids = spark.read.parquet(str(tmp_path / "ids"))
    got = with_ids(fact, ids, SPEC, "id")
    assert got.columns == [*fact.columns, "id"] and got.count() == len(rows)
    assert {r.n: r.id for r in got.collect()} == want and sum(v is not None for v in want.values()) >= 15
    assert "decimal" not in got._jdf.queryExecution().toString()


def test_levels_put_parents_first():
    seen = set()
    for names in L.levels():
        for n in names:
            assert all(p in seen for _, p, _ in TABLES[n][2])
        seen |= set(names)
    assert seen == set(TABLES) and len(L.levels()) == 7


@pytest.fixture(scope="module")
def loaded(spark):
    return L.Load(FlightMart(spark, SF_SMALL)).run()


def test_load_keeps_every_row_or_says_why(spark, loaded):
    flights = loaded.landed().count()
    by = {r.table_name + "/" + r.reason: r.rows for r in L.m3_facts(loaded.m).collect()}
    assert sum(v for k, v in by.items() if k.startswith("VUELO/")) == flights
    assert by["VUELO/no AERONAVE Tail_Number"] > 0 and by["RESULTADO/loaded"] == by["VUELO/loaded"] > 0
    report = {r.table_name: r for r in L.a8_key_report(loaded.m).collect()}
    assert set(report) == set(TABLES)
    assert all(r.repeated_keys == 0 and r.orphans == 0 for r in report.values())
    assert report["AERONAVE"].rejected > 0 and report["RUTA"].rejected == 0


def test_rows_of_the_load_are_written_once_and_narrow(spark, loaded):
    """Columns that others tell aren't stored, the rows with ids hold what is read of them, raw keys come once."""
    stored = spark.read.parquet(f"{loaded.base}/_wide")
    assert loaded.landed().columns == L.wide_flights(loaded.m).columns and len(stored.columns) < len(loaded.landed().columns) / 2 + 3
    assert loaded.landed().exceptAll(L.wide_flights(loaded.m)).count() == 0 == L.wide_flights(loaded.m).exceptAll(loaded.landed()).count()
    keyed = loaded.keyed()
    assert keyed.count() == stored.count() and "OriginCityName" not in keyed.columns
    for name in L.LOOKUPS:
        cols = [c for c, _ in L.SURROGATES[name][1]]
        raw, source = loaded.raw_keys(name), keyed if name in L.LOOKUPS[4:] else loaded.landed()
        assert raw.count() == source.select(*cols).distinct().count()
        assert raw.filter("flown").count() == source.filter("NOT Cancelled").select(*cols).distinct().count()
    plain = keyed
    for name in L.LOOKUPS[4:]:
        key, spec = L.SURROGATES[name]
        plain = lookup(plain, loaded.read(name), spec, key)
    ids = ["ID_Vuelo", "ID_CR", "ID_Programacion"]
    fast = loaded.with_id(loaded.with_id(keyed, "PROGRAMACION"), "CRONOMETRIA_REAL")
    assert fast.select(*ids).exceptAll(plain.select(*ids)).count() == 0


def test_a_stopped_load_goes_on(spark, loaded, monkeypatch):
    """What is there is not written again; a missing table is."""
    offered = []
    monkeypatch.setattr(L.Load, "offered", lambda self, name, made=L.Load.offered: offered.append(name) or made(self, name))
    other = L.Load(loaded.m)
    other.run()
    assert offered == []
    assert other.base.startswith(checkpoint_dir(spark).rstrip("/"))


def test_lookups_leave_gaps(spark, loaded):
    got = {r.lookup: r.coverage_pct for r in L.d13_six_lookups(loaded.m).collect()}
    assert list(got) and set(got) == set(L.LOOKUPS) and got["CRONOMETRIA_REAL"] < 100.0
    hops = L.d14_tail_model(loaded.m).first()
    assert hops.flights > hops.with_aircraft > hops.with_model > 0


def test_cities_keep_known_states(spark, loaded):
    rows = L.m5_city_state(loaded.m).collect()
    assert all(r.state_before in (None, r.state_after) for r in rows)
    assert any(r.state_before is None and r.state_after for r in rows)
    assert loaded.read("CIUDAD").filter(F.col("ID_Estado").isNull()).count() > 0       # the version is a table of its own


def test_a_correction_rewrites_only_touched_buckets_and_comes_back(spark, tmp_path):
    from contrail.sources import versioned as V
    rows = [(i, float(i), None if i % 7 == 0 else 1.0) for i in range(600)]
    path = str(tmp_path / "table")
    V.write_keyed(spark.createDataFrame(rows, "id long, x double, y double"), path, "id")
    stage = spark.createDataFrame([(5, 50.0, None), (5, 40.0, None), (7, 70.0, 7.0), (9, None, None), (9999, 1.0, 1.0)],
                                  "id long, x_new double, y_new double")
    files = {f: f.stat().st_mtime_ns for f in (tmp_path / "table").rglob("*.parquet")}
    touched = V.correct_keyed(spark, path, stage, "id", ["x", "y"], "t1")
    now = spark.read.parquet(path)
    got = {r.id: (r.x, r.y) for r in now.collect()}
    want = {i: (x, y) for i, x, y in rows} | {5: (50.0, 1.0), 7: (70.0, 7.0)}
    assert got == want and now.count() == 600
    left = {f.parent.name for f in (tmp_path / "table").rglob("*.parquet") if f in files and f.stat().st_mtime_ns == files[f]}
    assert left == {f.parent.name for f in files} - {f"bucket={b}" for b in touched}
    # run again as a whole: the same snapshot, the same result
    V.correct_keyed(spark, path, stage, "id", ["x", "y"], "t1")
    assert {r.id: (r.x, r.y) for r in spark.read.parquet(path).collect()} == want
    V.correct_keyed(spark, path, spark.createDataFrame([(11, 0.5, 0.5)], stage.schema), "id", ["x", "y"], "t2")
    assert V.restore_keyed(spark, path, "id", ["x", "y"], "t1") == touched
    back = {r.id: (r.x, r.y) for r in spark.read.parquet(path).collect()}
    assert back == {i: (x, y) for i, x, y in rows} | {11: (0.5, 0.5)}
    V.restore_keyed(spark, path, "id", ["x", "y"])                       # the newest: t2
    assert {r.id: (r.x, r.y) for r in spark.read.parquet(path).collect()} == {i: (x, y) for i, x, y in rows}
    assert V.restore_keyed(spark, str(tmp_path / "other"), "id", ["x"]) == []
    assert V.correct_keyed(spark, path, stage.limit(0), "id", ["x", "y"], "t3") == []


def test_the_registered_correction_reports_what_it_changed(spark, loaded):
    r = L.a10_restored(loaded.m).first()
    assert r.rows == loaded.read("RESULTADO").count() and r.differing == 0 and r.corrected > 0 and 0 < r.buckets < 256


def test_dense_keys_tell_whether_any_row_of_the_key_holds(spark, tmp_path):
    """``any_of`` follows the key as the kept row writes it, and is no part of the choice of that row."""
    rows = [("a", 2.0, False), ("a", 1.0, True), ("b", 1.0, False), ("b", 3.0, None), (" c", 5.0, False), ("c", 1.0, True),
            (None, 1.0, True)]
    d = spark.createDataFrame(rows, "a string, x double, there boolean").repartition(3)
    got = {r.a: (r.x, r.there) for r in dense_keys(d, [("a", "text")], "id", str(tmp_path / "k"), any_of=["there"]).collect()}
    assert got["a"] == (1.0, True) and got["b"][0] == 1.0 and got["b"][1] is not True
    assert got[" c"] == (5.0, False) and got[None] == (1.0, True)
    with pytest.raises(ValueError):
        dense_keys(d.select("x", "a", "there"), [("a", "text")], "id", str(tmp_path / "l"), any_of=["there"])


def test_keys_and_lookups_are_found_once_a_group_of_flights(spark, loaded):
    """Before, each flight was joined with four dimensions and written for it, and again for the other two."""
    from contrail.sources.versioned import exists
    assert not exists(spark, f"{loaded.base}/_keyed")
    w = loaded.with_id(loaded.with_id(loaded.keyed(), "PROGRAMACION"), "CRONOMETRIA_REAL")
    every = w.count()
    for name, (told, parents) in L.TOLD_BY.items():
        groups = loaded.looked_up(name)
        assert groups.count() == loaded.landed().select(*told).distinct().count() and groups.agg(F.sum("flights")).first()[0] == every
        for t in (*parents, name):
            key = L.SURROGATES[t][0]
            assert groups.filter(F.col(key).isNotNull()).agg(F.sum("flights")).first()[0] == w.filter(F.col(key).isNotNull()).count()
    ids = ["ID_CR", "ID_Programacion", "Cancelled", "fuel_burn", "co2"]
    f, w = L.wide(loaded.flights(), ["ID_Vuelo"], *ids), w.select(*ids, "ID_Vuelo")
    assert f.exceptAll(w).count() == 0 == w.exceptAll(f).count()


def test_results_without_a_loaded_flight_are_those_of_a_join(loaded):
    lost = loaded.checked("RESULTADO").filter("reason = 'no VUELO ID_Vuelo'").select("ID_Vuelo")
    want = loaded.checked("RESULTADO").select("ID_Vuelo").join(loaded.read("VUELO").select("ID_Vuelo"), "ID_Vuelo", "left_anti")
    assert lost.count() == want.count() > 0 and lost.exceptAll(want).count() == 0


def test_ids_made_of_the_landed_columns_are_the_flights(spark, loaded):
    from contrail.functions.clean import day_text
    stored = spark.read.parquet(f"{loaded.base}/_wide")
    assert "ID_Vuelo" not in stored.columns
    ids = loaded.m.flights().select(F.col("flight_id").alias("ID_Vuelo"))
    assert loaded.landed().select("ID_Vuelo").exceptAll(ids).count() == 0 and ids.count() == stored.count()
    days = spark.sql("SELECT explode(array(date'1995-01-09', date'0033-12-31', date'9999-12-31', date'1582-10-15', null)) AS d")
    assert days.filter(~day_text("d").eqNullSafe(F.date_format("d", "yyyyMMdd"))).count() == 0


def test_customers_joined_to_the_orders_first_give_the_same_flights(loaded):
    plain = loaded.m.flights("airline", "dest")
    first = loaded.m.flights("airline", "dest", dest_first=True)
    cols = sorted(set(first.columns))
    assert set(plain.columns) >= set(cols) >= {"dest_airport_id", "dest_state", "flight_id"}
    assert first.select(*cols).exceptAll(plain.select(*cols)).count() == 0 and first.count() == plain.count()


def test_the_second_hop_is_made_once_an_aircraft(loaded):
    plan = L.d14_tail_model(loaded.m)._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.split("\n") if "Join LeftOuter" in line]
    assert len(joins) == 2 and "Tail_Number" in joins[0] and "model" in joins[1]        # the flights meet the finished bridge


def test_a_bucket_is_matched_and_written_with_one_shuffle(spark, tmp_path, monkeypatch):
    """Before, restored rows were joined by key and then shuffled again by bucket."""
    from contrail.sources import versioned as V
    path, plans = str(tmp_path / "t"), []
    V.write_keyed(spark.createDataFrame([(i, float(i), None) for i in range(300)] + [(None, 1.0, 1.0)], "id long, x double, y double"),
                  path, "id")
    plain = V._replace_buckets
    monkeypatch.setattr(V, "_replace_buckets", lambda rows, to: plans.append(
        rows._jdf.queryExecution().executedPlan().toString()) or plain(rows, to))
    stage = spark.createDataFrame([(4, 9.0, None), (None, 7.0, 7.0)], "id long, x_new double, y_new double")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        V.correct_keyed(spark, path, stage, "id", ["x", "y"], "t1")
        now = {r.id: (r.x, r.y) for r in spark.read.parquet(path).collect()}
        assert len(now) == 301 and now[4] == (9.0, None) and now[None] == (1.0, 1.0)          # a null key matches nothing
        V.restore_keyed(spark, path, "id", ["x", "y"])
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert {r.id: (r.x, r.y) for r in spark.read.parquet(path).collect()} == {
        **{i: (float(i), None) for i in range(300)}, None: (1.0, 1.0)}
    assert len(plans) == 2 and all(len([x for x in p.split("\n") if "Exchange" in x]) == 1 for p in plans)


# -- disk ---------------------------------------------------------------------

def shuffle_files(spark):
    files = spark._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def test_a_load_leaves_no_shuffle_files(spark, loaded, tmp_path):
    """Before, they all stayed until the driver's next collection of garbage."""
    load = L.Load(loaded.m)
    load.base = str(tmp_path / "load")
    before, setting = shuffle_files(spark), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(setting)
    load.run()
    for _ in range(50):
        if not (left := shuffle_files(spark) - before):
            break
        time.sleep(0.2)
    assert not left and spark.conf.get(setting) == was
    with pytest.raises(ZeroDivisionError), freed_shuffles(spark):
        assert spark.conf.get(setting) == "true" and 1 / 0
    assert spark.conf.get(setting) == was
    names = ["VUELO", "RESULTADO", "AERONAVE"]
    rows = lambda made: {n: sorted(map(str, made.checked(n).collect())) for n in names}
    assert rows(load) == rows(loaded)


def test_a_flights_aircraft_is_found_by_numbers(loaded):
    """The flights that lack an aircraft are those of a join by tail number, of which no text is shuffled."""
    rows, lacking = loaded._with_parents("VUELO", loaded._stored())
    plan = rows.select("order_id", lacking[0][0].alias("x"))._jdf.queryExecution().optimizedPlan().toString()
    assert "concat(N" not in plan and lacking[0][1] == "no AERONAVE Tail_Number"
    known = loaded.read("AERONAVE").select("Tail_Number")
    want = loaded.landed().select("Tail_Number").join(known, "Tail_Number", "left_anti").count()
    assert rows.filter(lacking[0][0]).count() == want > 0


def test_the_stage_of_a_correction_is_made_once(spark, tmp_path):
    from contrail.sources import versioned as V
    path, made = str(tmp_path / "t"), spark.sparkContext.accumulator(0)
    V.write_keyed(spark.createDataFrame([(i, float(i)) for i in range(40)], "id long, x double"), path, "id")

    def counted(batches):
        for b in batches:
            made.add(len(b))
            yield b

    stage = spark.createDataFrame([(4, 9.0), (5, 7.0)], "id long, x_new double").coalesce(1).mapInPandas(
        counted, "id long, x_new double")
    V.correct_keyed(spark, path, stage, "id", ["x"], "t1")
    assert made.value == 2
    assert {r.id: r.x for r in spark.read.parquet(path).collect()} == {i: {4: 9.0, 5: 7.0}.get(i, float(i)) for i in range(40)}
