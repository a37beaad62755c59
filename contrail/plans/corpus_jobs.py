"""Corpus jobs on the test tables.

The question/SQL corpus is generated from templates whose parameter values
are read from the tables (airline names from ``supplier``, continents from
``region``, years and months from ``orders``), so the corpus grows with the
data.  It then goes through the same chain as the original corpus builder:
dedupe -> cap per family -> stratified split -> integrity gate -> schema
reference check.  Chat-reply jobs run on ``conversations``, exact-copy
dedupe on ``documents``.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.operators import corpus as O
from contrail.plans.mart import FlightMart

_DELAY_CHAIN = ("FROM VUELO V JOIN RESULTADO R ON V.ID_Vuelo = R.ID_Vuelo "
                "JOIN CRONOMETRIA_REAL CR ON R.ID_CR = CR.ID_CR "
                "JOIN DETALLE_RETRASOS DR ON CR.ID_Detalle_R = DR.ID_Detalle_R")
_AIRLINE_CHAIN = ("JOIN AERONAVE AN ON V.Tail_Number = AN.Tail_Number "
                  "JOIN AEROLINEA AL ON AN.DOT_ID_Operating_Airline = AL.DOT_ID_Operating_Airline")
_SCHED_CHAIN = "JOIN PROGRAMACION P ON R.ID_Programacion = P.ID_Programacion"

# (template_id, family, param_kind, question, sql) -- "{v}" is the parameter slot.
TEMPLATES = [
    ("d1", "delays", "airline", "What is the average arrival delay of {v}?",
     f"SELECT AVG(DR.ArrDelayMinutes) AS avg_arr_delay {_DELAY_CHAIN} {_AIRLINE_CHAIN} "
     "WHERE AL.Operating_Airline = '{v}';"),
    ("d1b", "delays", "airline", "What is the average arrival delay of {v}?",
     f"SELECT AVG(DR.ArrDelayMinutes) AS avg_arr_delay {_DELAY_CHAIN} {_AIRLINE_CHAIN} "
     "WHERE AL.Operating_Airline = '{v}';"),
    ("d2", "delays", "airline", "What is the average departure delay of {v}?",
     f"SELECT AVG(DR.DepDelayMinutes) AS avg_dep_delay {_DELAY_CHAIN} {_AIRLINE_CHAIN} "
     "WHERE AL.Operating_Airline = '{v}';"),
    ("d3", "delays", "year", "How many flights arrived 15 or more minutes late in {v}?",
     f"SELECT COUNT(*) AS delayed_flights {_DELAY_CHAIN} {_SCHED_CHAIN} "
     "WHERE DR.ArrDel15 = 1 AND P.Year = {v};"),
    ("d4", "delays", "month", "What was the average departure delay in month {v}?",
     f"SELECT AVG(DR.DepDelayMinutes) AS avg_dep_delay {_DELAY_CHAIN} {_SCHED_CHAIN} "
     "WHERE P.Month = {v};"),
    ("t1", "taxi", "airline", "What is the average taxi-out time of {v}?",
     "SELECT AVG(TX.TaxiOut) AS avg_taxi_out FROM VUELO V JOIN RESULTADO R ON V.ID_Vuelo = R.ID_Vuelo "
     "JOIN CRONOMETRIA_REAL CR ON R.ID_CR = CR.ID_CR JOIN TAXI TX ON CR.ID_TAXI = TX.ID_TAXI "
     f"{_AIRLINE_CHAIN} WHERE AL.Operating_Airline = '{{v}}';"),
    ("f1", "fleet", "airline", "How many distinct aircraft does {v} operate?",
     "SELECT COUNT(DISTINCT AN.Tail_Number) AS aircraft FROM AERONAVE AN "
     "JOIN AEROLINEA AL ON AN.DOT_ID_Operating_Airline = AL.DOT_ID_Operating_Airline "
     "WHERE AL.Operating_Airline = '{v}';"),
    ("g1", "geography", "continent", "How many flights landed in {v}?",
     "SELECT COUNT(*) AS flights FROM VUELO V JOIN AEROPUERTO AD ON V.DestAirportID = AD.AirportID "
     "JOIN CIUDAD CI ON AD.CityMarketID = CI.CityMarketID JOIN ESTADO E ON CI.ID_Estado = E.ID_Estado "
     "JOIN WAC W ON E.WAC_ID = W.WAC_ID JOIN CONTINENTE C ON W.Nombre_Continente = C.Nombre_Continente "
     "WHERE C.Nombre_Continente = '{v}';"),
    ("e1", "emissions", "year", "How much CO2 was emitted in {v}?",
     f"SELECT SUM(R.co2) AS total_co2 FROM VUELO V JOIN RESULTADO R ON V.ID_Vuelo = R.ID_Vuelo {_SCHED_CHAIN} "
     "WHERE R.Cancelled = 0 AND P.Year = {v};"),
    ("e2", "emissions", "airline", "How much fuel did {v} burn?",
     f"SELECT SUM(R.fuel_burn) AS total_fuel FROM VUELO V JOIN RESULTADO R ON V.ID_Vuelo = R.ID_Vuelo "
     f"{_AIRLINE_CHAIN} WHERE R.Cancelled = 0 AND AL.Operating_Airline = '{{v}}';"),
]
CAP_PER_FAMILY = 200
VAL_FRACTION = 0.1
SEED = 42


def templates(m: FlightMart) -> DataFrame:
    return m.spark.createDataFrame(
        TEMPLATES, "template_id string, family string, param_kind string, question string, sql string")


def parameters(m: FlightMart) -> DataFrame:
    o = m.table("orders")
    return (m.table("supplier").select(F.lit("airline").alias("param_kind"), F.col("s_name").alias("value"))
            .unionByName(m.table("region").select(F.lit("continent").alias("param_kind"),
                                                  F.col("r_name").alias("value")))
            .unionByName(o.select(F.lit("year").alias("param_kind"),
                                  F.year("o_orderdate").cast("string").alias("value")))
            .unionByName(o.select(F.lit("month").alias("param_kind"),
                                  F.month("o_orderdate").cast("string").alias("value")))
            .distinct())


def o1_expand_templates(m: FlightMart) -> DataFrame:
    return O.expand_templates(templates(m), parameters(m))


def o2_dedupe_corpus(m: FlightMart) -> DataFrame:
    return O.dedupe_pairs(o1_expand_templates(m))


def o2_dedupe_documents(m: FlightMart) -> DataFrame:
    """Exact copies in ``documents``: keep the first doc_id of each text."""
    d = m.table("documents").select("doc_id", "source", "text")
    d = d.select("doc_id", "source", F.sha1("text").alias("__sha"), F.md5("text").alias("__md5"),
                 F.length("text").alias("__len"))  # the text itself never enters the shuffle
    return O.dedupe_pairs(d, keys=["__sha", "__md5", "__len"], order=["doc_id"]).select("doc_id", "source")


def o3_cap_per_family(m: FlightMart) -> DataFrame:
    return O.cap_per_family(o2_dedupe_corpus(m), CAP_PER_FAMILY, SEED)


def o4_stratified_split(m: FlightMart) -> DataFrame:
    return O.stratified_split(o2_dedupe_corpus(m), VAL_FRACTION, SEED).select(
        "family", "instruction", "output", "split")


def o5_family_distribution(m: FlightMart) -> DataFrame:
    return O.family_distribution(o4_stratified_split(m))


def o6_integrity_gate(m: FlightMart) -> DataFrame:
    return O.rule_violations(o2_dedupe_corpus(m), "output")


# Slips planted by the first digit of the instruction's md5 (what to find, what to put).
SLIPS = {
    "0": ("RESULTADO", "DETALLE_VUELO"),
    "1": ("R.Cancelled", "R.Distance"),
    "2": ("V.ID_Vuelo", "Z.ID_Vuelo"),
    "3": ("JOIN PROGRAMACION P", "JOIN TAXI P"),
    "4": ("JOIN WAC W", "JOIN PAIS W"),
    "5": ("VUELO V", "VUELOS V"),
}


def drafts(m: FlightMart) -> DataFrame:
    """The corpus as a careless model would write it: some statements with a slip."""
    d = o2_dedupe_corpus(m).withColumn("__d", F.substring(F.md5("instruction"), 1, 1))
    out = F.col("output")
    for digit, (find, put) in SLIPS.items():
        out = F.when(F.col("__d") == digit, F.replace("output", F.lit(find), F.lit(put))).otherwise(out)
    return d.withColumn("output", out).drop("__d")


def o6_gate_on_drafts(m: FlightMart) -> DataFrame:
    return O.rule_violations(drafts(m), "output")


# must-have and must-not patterns of each family
CASES = [("geography", ["JOIN\\s+WAC", "CONTINENTE"], ["PAIS"]), ("emissions", ["R\\.Cancelled\\s*=\\s*0"], ["DETALLE_VUELO"]),
         ("delays", ["DETALLE_RETRASOS"], ["DETALLE_VUELO"])]


def o7_scored_drafts(m: FlightMart) -> DataFrame:
    """Pass rate of each family's drafts against its cases."""
    cases = m.spark.createDataFrame(CASES, "family string, must_have array<string>, must_not array<string>")
    d = drafts(m).join(F.broadcast(cases), "family")
    s = O.score_cases(d.select(F.concat_ws("|", "family", "template_id", "instruction").alias("case_id"),
                               F.col("output").alias("sql")),
                      d.select(F.concat_ws("|", "family", "template_id", "instruction").alias("case_id"),
                               "must_have", "must_not"))
    return s.groupBy(F.substring_index("case_id", "|", 1).alias("family")).agg(
        F.count("*").alias("cases"), F.count_if("passed").alias("passed"))


def _problems(m: FlightMart, statements: DataFrame) -> DataFrame:
    c = statements.withColumn("id", F.concat_ws("|", "template_id", "instruction"))
    return O.schema_violations(c, O.schema_table(m.spark), "id", "output")


def o8_schema_problems(m: FlightMart) -> DataFrame:
    return _problems(m, drafts(m))


def o8_problem_frequency(m: FlightMart) -> DataFrame:
    return O.problem_frequency(o8_schema_problems(m))


def o8_reference_summary(m: FlightMart) -> DataFrame:
    c = o2_dedupe_corpus(m)
    return c.agg(F.count("*").alias("statements")).crossJoin(
        F.broadcast(_problems(m, c).agg(F.count("*").alias("problems"))))


def replies(m: FlightMart) -> DataFrame:
    """Chat replies around the corpus statements, in four forms by the
    instruction's md5: fenced, bare with a prose tail, prose alone, a procedure."""
    d = o2_dedupe_corpus(m)
    kind = F.substring(F.md5("instruction"), 1, 1)
    bare = F.regexp_replace("output", ";$", "")
    text = (F.when(kind < "4", F.concat(F.lit("Here it is:\n```sql\n"), F.col("output"), F.lit("\n```\nIt counts flights.")))
            .when(kind < "8", F.concat(F.lit("Sure.\n"), bare, F.lit("\nThis is what you asked for.")))
            .when(kind < "a", F.lit("I can't answer that."))
            .otherwise(F.concat(F.lit("CREATE PROCEDURE p AS\nBEGIN\n  "), F.col("output"), F.lit("\nEND\nGO\nThat is all."))))
    return d.select("template_id", "instruction", text.alias("text"))


def spoken_words() -> list[str]:
    """The words in capitals of the corpus templates that are no names of the schema."""
    words = {w for *_, sql in TEMPLATES for w in re.findall(r"\b[A-Z]{2,}\b", re.sub(r"'[^']*'|\w+\.\w+", "", sql))}
    return sorted(w for w in words if w not in O.SCHEMA and len(w) > 2 or w in ("AS", "BY", "ON"))


def o9_extract_code(m: FlightMart) -> DataFrame:
    return replies(m).select("template_id", "instruction", O.extract_code("text", spoken_words()).alias("code"))


def o10_statement_kinds(m: FlightMart) -> DataFrame:
    return (o9_extract_code(m).withColumn("kind", O.statement_kind("code"))
            .groupBy("kind").agg(F.count("*").alias("replies")))


def o11_rewritten_drafts(m: FlightMart) -> DataFrame:
    d = drafts(m)
    return d.select("template_id", "instruction", O.rewrite_names("output").alias("output"),
                    O.invented_table("output").alias("invented"))


def o12_flag_counts(m: FlightMart) -> DataFrame:
    f = drafts(m).select(O.structural_flags("output").alias("f")).select("f.*")
    return f.agg(*[F.count_if(c).alias(c) for c in f.columns])


def o12_repaired_chains(m: FlightMart) -> DataFrame:
    """Drafts of the join chain that lack the timing table, before and after the repair."""
    d = o2_dedupe_corpus(m).withColumn("output", F.regexp_replace("output", r"JOIN CRONOMETRIA_REAL CR ON [^J]*", ""))
    d = d.withColumn("fixed", O.repair_chain("output"))
    flag = lambda c: O.structural_flags(c)["delays_without_timing"]
    return d.agg(F.count_if(flag("output")).alias("broken"), F.count_if(flag("fixed")).alias("still_broken"),
                 F.count_if(F.col("output") != F.col("fixed")).alias("changed"))


def commented(m: FlightMart) -> DataFrame:
    d = o2_dedupe_corpus(m)
    text = F.concat(F.lit("/* "), F.col("instruction"), F.lit("\n */\n\n    "), F.col("output"),
                    F.lit(" -- "), F.col("family"), F.lit("  \n      -- end\n"))
    return d.select("template_id", "instruction", "output", text.alias("text"))


def o13_strip_comments(m: FlightMart) -> DataFrame:
    return commented(m).select("template_id", "instruction", O.strip_comments("text").alias("clean_text"))


def o15_bodies(m: FlightMart) -> DataFrame:
    """The queries inside views and procedures made of the corpus statements."""
    d = o2_dedupe_corpus(m)
    text = (F.when(F.col("family") < "e", F.concat(F.lit("CREATE OR ALTER VIEW v AS "), F.col("output")))
            .otherwise(F.concat(F.lit("CREATE OR ALTER PROCEDURE p @x INT AS BEGIN "),
                                F.regexp_replace("output", ";$", " AND 1 = @x;"), F.lit(" END"))))
    return d.select("template_id", "instruction", O.validable_body(text).alias("body"))
