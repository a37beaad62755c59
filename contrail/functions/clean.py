"""Cleaning and key functions (B1-B28) as pure Column expressions.

All coercions are ANSI-safe (``try_cast`` / ``try_to_date`` / ``try_divide``):
a bad value becomes null instead of failing the job.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

NULL_TOKEN = "<NA>"   # fixed value: canonical-key token for a missing part
KEY_SEP = "||"        # fixed value: canonical-key separator


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def parse_date(c, fmt: str = "dd/MM/yyyy") -> Column:
    """Text -> date, unparseable (incl. 31/02) -> null."""
    return F.try_to_date(_c(c).cast("string"), fmt)


def float_id_text(c) -> Column:
    """B4: '19690.0' -> '19690'; null / '-1' / non-numeric -> null."""
    v = F.trim(_c(c).cast("string")).try_cast("decimal(38,10)")
    s = F.when(v.isNotNull(), F.floor(v).cast("string"))
    return F.nullif(s, F.lit("-1"))


def norm_code(c) -> Column:
    """Trim + upper; the text 'NAN' (a pandas artefact) -> null."""
    return F.nullif(F.upper(F.trim(_c(c).cast("string"))), F.lit("NAN"))


def to_bool(c) -> Column:
    """True for 'true' / '1' / '1.0' (any case), false otherwise; null
    stays false, matching the reference's second coercion."""
    return F.coalesce(F.lower(F.trim(_c(c).cast("string"))).isin("true", "1", "1.0"), F.lit(False))


def flag_fill(c) -> Column:
    """Indicator null -> 0, as int."""
    return F.coalesce(_c(c).cast("string").try_cast("double"), F.lit(0.0)).cast("int")


def safe_number(c, to: str = "double") -> Column:
    """Numeric coercion, bad text -> null."""
    return F.trim(_c(c).cast("string")).try_cast(to)


def parse_formatted_number(c) -> Column:
    """B28: '1,234.5' -> 1234.5."""
    return F.regexp_replace(_c(c).cast("string"), ",", "").try_cast("double")


def relabel(c, mapping: Mapping[str, str], fallback: bool = True, null_code: str | None = None) -> Column:
    """B1/B2: code -> label through a literal map; unknown codes keep the code
    (``fallback``) and a null code can be rescued to ``null_code`` first."""
    code = _c(c)
    if null_code is not None:
        code = F.coalesce(code, F.lit(null_code))
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    lab = F.try_element_at(m, code)
    return F.coalesce(lab, code) if fallback else lab


def zero_if(cond, c) -> Column:
    """Measure forced to 0 when ``cond`` (cancelled flight)."""
    return F.when(_c(cond), F.lit(0.0)).otherwise(_c(c))


def null_above(c, limit: float, gate=None) -> Column:
    """Physically impossible value (> limit) -> null.  ``gate`` lets a
    second column be nulled by the same test (fuel and CO2 together)."""
    g = _c(gate) if gate is not None else _c(c)
    return F.when(g > limit, F.lit(None)).otherwise(_c(c))


def day_text(d) -> Column:
    """``date_format(d, 'yyyyMMdd')`` of a date, by arithmetic: a natural id is made for every flight, and the
    formatter costs more than all the rest of it."""
    d = _c(d)
    number = F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)
    return F.when(F.year(d).between(0, 9999), F.lpad(number.cast("string"), 8, "0")).otherwise(F.date_format(d, "yyyyMMdd"))


def natural_id(parts: Sequence, date_col=None, sep: str = "_") -> Column:
    """Readable natural id 'IATA_yyyyMMdd_tail_time'.  Null parts make the
    whole id null (``concat_ws`` would silently skip them)."""
    cols = []
    for p in parts:
        if date_col is not None and (p is date_col or p == date_col):
            cols.append(F.date_format(_c(p), "yyyyMMdd"))
        else:
            cols.append(_c(p).cast("string"))
    anynull = F.lit(False)
    for c in cols:
        anynull = anynull | c.isNull()
    return F.when(~anynull, F.concat_ws(sep, *cols))


def canon(c, kind: str) -> Column:
    """B15 part: dtype-independent text for one key part.
    int -> '102' (also from 102.0), float -> '%.2f' half-up, date ->
    'yyyy-MM-dd', text -> trimmed upper; null -> '<NA>'."""
    x = _c(c)
    if kind == "int":
        v = F.round(x.cast("string").try_cast("decimal(38,10)"), 0).cast("decimal(28,0)").cast("string")
    elif kind == "float":
        v = F.round(x.cast("string").try_cast("double").cast("decimal(38,10)"), 2) \
             .cast("decimal(38,2)").cast("string")
    elif kind == "date":
        v = F.date_format(x.cast("date"), "yyyy-MM-dd")
    elif kind == "text":
        v = F.nullif(F.upper(F.trim(x.cast("string"))), F.lit("NAN"))
    else:
        raise ValueError(kind)
    return F.coalesce(v, F.lit(NULL_TOKEN))


def canonical_key(spec: Sequence[tuple[str, str]]) -> Column:
    """Canonical typed key over ``[(column, kind), ...]``."""
    return F.concat_ws(KEY_SEP, *[canon(c, k) for c, k in spec])


def day_of_week_mon1(d) -> Column:
    """Monday = 1 .. Sunday = 7 (Spark's dayofweek is Sunday = 1)."""
    return F.weekday(_c(d)) + 1
