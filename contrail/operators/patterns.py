"""Reusable analytical shapes (window / pivot / banding) as DataFrame transforms.

Windows with an empty ``within`` run in a single task: use them only on
aggregated rows (one row per airline, model, route ...), never on detail rows.
For detail rows use :func:`with_totals`, which joins a one-row aggregate.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contrail.functions.numeric import half_up


def _cols(xs) -> list:
    if xs is None:
        return []
    return [xs] if isinstance(xs, (str, Column)) else list(xs)


def _order(by, ascending: bool, tie=()) -> list[Column]:
    out = []
    for b in _cols(by):
        c = F.col(b) if isinstance(b, str) else b
        out.append(c.asc_nulls_first() if ascending else c.desc_nulls_last())
    for t in _cols(tie):
        out.append(F.col(t).asc() if isinstance(t, str) else t)
    return out


def window(within=(), order=None, ascending=False, tie=()):
    w = Window.partitionBy(*_cols(within))
    if order is not None:
        w = w.orderBy(*_order(order, ascending, tie))
    return w


def total_over(measure: str, within=()) -> Column:
    return F.sum(measure).over(window(within))


def share_of(df: DataFrame, measure: str, within=(), name: str = "share_pct",
             scale: int | None = 2) -> DataFrame:
    """measure * 100 / SUM(measure) OVER (PARTITION BY within)."""
    v = F.col(measure).cast("double") * 100.0 / total_over(measure, within)
    return df.withColumn(name, v if scale is None else half_up(v, scale))


def rank_in(df: DataFrame, by, within=(), kind: str = "rank", ascending: bool = False,
            name: str = "rank", tie=()) -> DataFrame:
    """rank / dense_rank / row_number / ntile:N per partition."""
    w = window(within, by, ascending, tie)
    if kind.startswith("ntile"):
        fn = F.ntile(int(kind.split(":")[1]))
    else:
        fn = {"rank": F.rank(), "dense_rank": F.dense_rank(),
              "row_number": F.row_number()}[kind]
    return df.withColumn(name, fn.over(w).cast("long"))


def rank_by_value(df: DataFrame, by: str, within=(), ascending: bool = False, name: str = "rank") -> DataFrame:
    """RANK() of each row, read from the distinct values of ``by``.

    A value's rank is one more than the number of rows with a better one, so
    only distinct values are ordered.  Meant for counts: n different counts
    add up to n^2 / 2 counted rows at least, so there are few of them however
    many rows are ranked.  Measures with many values take
    :func:`contrail.operators.quality.global_rank`."""
    keys = [*_cols(within), by]
    w = window(within, by, ascending).rowsBetween(Window.unboundedPreceding, -1)
    ranks = df.groupBy(*keys).agg(F.count("*").alias("__n")).select(
        *[F.col(k).alias(f"__{k}") for k in keys],
        (F.coalesce(F.sum("__n").over(w), F.lit(0)) + 1).cast("long").alias(name))
    same = [df[k].eqNullSafe(F.col(f"__{k}")) for k in keys]
    on = same[0]
    for c in same[1:]:
        on = on & c
    return df.join(ranks, on).drop(*[f"__{k}" for k in keys])


def share_of_total(df: DataFrame, measure: str, within=(), name: str = "share_pct", scale: int | None = 2,
                   total: str | None = None) -> DataFrame:
    """measure * 100 / its total, with the totals as an aggregate of their own.

    ``within`` names fixed or calendar groups (alliances, quarters): their
    totals are a handful of rows and are broadcast."""
    keys = _cols(within)
    sums = df.groupBy(*keys).agg(F.sum(measure).alias("__total"))
    d = df.join(F.broadcast(sums), keys) if keys else with_totals(df, sums)
    v = F.col(measure).cast("double") * 100.0 / F.col("__total")
    d = d.withColumn(name, v if scale is None else half_up(v, scale))
    return d.withColumnRenamed("__total", total) if total else d.drop("__total")


def with_average(df: DataFrame, measure: str, name: str = "__avg") -> DataFrame:
    """The average over all rows beside each row, as a one-row aggregate."""
    return with_totals(df, df.agg(F.avg(measure).alias(name)))


def top_n(df: DataFrame, n: int, by, within=(), ascending: bool = False, tie=(),
          name: str = "position", kind: str = "row_number") -> DataFrame:
    """Top-N per group; Catalyst turns the rank filter into WindowGroupLimit,
    so each partition keeps only N rows per key before the window sort."""
    return rank_in(df, by, within, kind, ascending, name, tie).filter(F.col(name) <= n)


def running_total(df: DataFrame, measure: str, within, order, name: str) -> DataFrame:
    w = Window.partitionBy(*_cols(within)).orderBy(*_cols(order)) \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn(name, F.sum(measure).over(w))


def moving_avg(df: DataFrame, measure: str, within, order, n: int, name: str) -> DataFrame:
    w = Window.partitionBy(*_cols(within)).orderBy(*_cols(order)).rowsBetween(-(n - 1), 0)
    return df.withColumn(name, F.avg(measure).over(w))


def change_vs_previous(df: DataFrame, measure: str, within, order, prev: str,
                       diff: str | None = None, pct: str | None = None,
                       scale: int = 2) -> DataFrame:
    """LAG once into ``prev`` and derive difference and % change from it."""
    w = Window.partitionBy(*_cols(within)).orderBy(*_cols(order))
    out = df.withColumn(prev, F.lag(measure).over(w))
    if diff:
        out = out.withColumn(diff, F.col(measure) - F.col(prev))
    if pct:
        out = out.withColumn(pct, half_up(F.try_divide(
            (F.col(measure) - F.col(prev)).cast("double") * 100.0, F.col(prev).cast("double")), scale))
    return out


def banded(arms: Sequence[tuple[Column, str]], default: str) -> Column:
    """Searched CASE: first matching arm wins (overlapping bounds allowed)."""
    expr = None
    for cond, label in arms:
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(default)) if expr is not None else F.lit(default)


def vs_average(df: DataFrame, measure: str, within=(), avg_name: str = "avg_value",
               diff_name: str | None = "diff_vs_avg", scale: int | None = 4) -> DataFrame:
    """AVG(measure) OVER (within) beside each row, and the distance to it."""
    a = F.avg(measure).over(window(within))
    out = df.withColumn("__avg", a)
    if diff_name:
        d = F.col(measure) - F.col("__avg")
        out = out.withColumn(diff_name, d if scale is None else half_up(d, scale))
    out = out.withColumn(avg_name, F.col("__avg") if scale is None else half_up("__avg", scale))
    return out.drop("__avg")


def with_totals(df: DataFrame, totals: DataFrame) -> DataFrame:
    """Attach a one-row aggregate to every row (scalar subquery / OVER ()).
    The one-row side is broadcast: its size is one row by construction."""
    return df.crossJoin(F.broadcast(totals))


def pivot_fixed(df: DataFrame, rows, pivot_col: str, values: Sequence, measure: str,
                agg: str = "sum", names: Sequence[str] | None = None,
                fill=None) -> DataFrame:
    """groupBy(rows).pivot(col, values) with an explicit value list (one pass,
    no distinct-values job).  COUNT-style pivots pass ``fill=0`` (a pivot cell
    with no rows counts 0, while SUM/AVG leave it null)."""
    fn = {"sum": F.sum, "avg": F.avg, "count": F.count, "max": F.max, "min": F.min}[agg]
    p = df.groupBy(*_cols(rows)).pivot(pivot_col, list(values)).agg(fn(measure))
    names = list(names) if names else [str(v) for v in values]
    cells = []
    for v, nm in zip(values, names):
        c = F.col(f"`{v}`")
        if fill is not None:
            c = F.coalesce(c, F.lit(fill))
        cells.append(c.alias(nm))
    return p.select(*[F.col(r) if isinstance(r, str) else r for r in _cols(rows)], *cells)


def unpivot_columns(df: DataFrame, ids, columns: Sequence[str], var: str, value: str) -> DataFrame:
    """melt: wide quarter columns back to long rows."""
    return df.unpivot(_cols(ids), list(columns), var, value)
