"""Data-quality audits and profiles.

All audits are aggregations; none collects rows to the driver.  Ranks and
exact percentiles come from :func:`value_positions` (distinct values, a
bucketed running count and per-bucket offsets), so no single task ever sorts
or buffers a whole column or group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contrail.functions.numeric import half_up


def value_positions(df: DataFrame, col: str, by: Sequence[str] = (), buckets: int = 64) -> DataFrame:
    """Distinct values of ``col`` (per ``by`` group) with their row count
    ``__n`` and ``__before`` = number of rows with a smaller value.

    Only distinct (group, value) pairs are shuffled (a value repeated on a
    third of the rows is one row after the map-side count).  The running
    count is computed inside value buckets whose boundaries are approximate
    quantiles fixed as literals in the plan, then shifted by the exact row
    totals of the lower buckets; no task ever orders a whole group, and a
    recomputed partition lands in the same bucket (no sampling at run time)."""
    by = list(by)
    d = df.filter(F.col(col).isNotNull()).groupBy(*by, col).agg(F.count("*").alias("__n"))
    probs = [i / buckets for i in range(1, buckets)]
    bounds = sorted(set(b for b in df.approxQuantile(col, probs, 0.001) if b is not None)) if buckets > 1 else []
    v = F.col(col).cast("double")
    bucket = F.lit(0)
    for bound in bounds:  # bucket = number of boundaries <= value (plain codegen'd comparisons)
        bucket = bucket + F.when(v >= F.lit(float(bound)), 1).otherwise(0)
    d = d.withColumn("__b", bucket)
    w = Window.partitionBy(*by, "__b").orderBy(col).rowsBetween(Window.unboundedPreceding, -1)
    d = d.withColumn("__local", F.coalesce(F.sum("__n").over(w), F.lit(0)))
    tot = d.groupBy(*by, "__b").agg(F.sum("__n").alias("__bn"))
    tot = tot.withColumn("__off", F.coalesce(F.sum("__bn").over(
        Window.partitionBy(*by).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return (d.join(tot.select(*by, "__b", "__off"), [*by, "__b"])
            .withColumn("__before", F.col("__off") + F.col("__local")).drop("__b", "__local", "__off"))


def average_rank(df: DataFrame, col: str, by: Sequence[str] = (), name: str | None = None,
                 buckets: int = 64) -> DataFrame:
    """Average rank of ``col`` (ties share the mean of their positions), over
    all rows or within ``by`` groups; null values get a null rank."""
    name = name or f"{col}_rank"
    by = list(by)
    d = value_positions(df, col, by, buckets)
    d = d.withColumn(name, F.col("__before") + (F.col("__n") + 1) / 2.0)
    return df.join(d.select(*by, col, name), [*by, col], "left")


def global_rank(df: DataFrame, col: str, name: str = "rank", descending: bool = True,
                buckets: int = 64) -> DataFrame:
    """RANK() OVER (ORDER BY col) without a single-task window: the rank is
    1 + the number of rows with a strictly better value, read from the
    bucketed value positions.  Rows with a null value get a null rank."""
    pos = value_positions(df, col, [], buckets)
    tot = pos.agg(F.sum("__n").alias("__total"))
    pos = pos.crossJoin(F.broadcast(tot))
    better = (F.col("__total") - F.col("__before") - F.col("__n")) if descending else F.col("__before")
    r = pos.select(col, (better + 1).cast("long").alias(name))
    return df.join(r, col, "left")


def exact_percentiles(df: DataFrame, col: str, probs: Sequence[float], by: Sequence[str] = (),
                      names: Sequence[str] | None = None, buckets: int = 64) -> DataFrame:
    """Exact linear-interpolation percentiles (PERCENTILE_CONT) computed from
    value positions: for each p the values at 0-based ranks floor and ceil
    of p * (n - 1) are picked out and interpolated.  Unlike an exact
    ``percentile`` aggregate it never holds a group's values in one task."""
    by = list(by)
    names = list(names or [f"p{int(round(p * 1000)):03d}" for p in probs])
    pos = value_positions(df, col, by, buckets)
    n = pos.groupBy(*by).agg(F.sum("__n").alias("__total"))
    pos = pos.join(n, by) if by else pos.crossJoin(F.broadcast(n))
    picks = []
    for p, nm in zip(probs, names):
        r = (F.col("__total") - 1) * float(p)
        lo, hi = F.floor(r), F.ceil(r)
        covers = lambda k: (F.col("__before") <= k) & (k < F.col("__before") + F.col("__n"))
        picks += [F.max(F.when(covers(lo), F.col(col).cast("double"))).alias(f"{nm}__lo"),
                  F.max(F.when(covers(hi), F.col(col).cast("double"))).alias(f"{nm}__hi"),
                  F.first(r - lo).alias(f"{nm}__f")]
    g = pos.groupBy(*by).agg(*picks) if by else pos.agg(*picks)
    return g.select(*by, *[(F.col(f"{nm}__lo") + (F.col(f"{nm}__hi") - F.col(f"{nm}__lo")) * F.col(f"{nm}__f"))
                           .alias(nm) for nm in names])


def corr_audit(df: DataFrame, x: str, y: str, by: Sequence[str] = (), method: str = "pearson",
               scale: int = 6) -> DataFrame:
    """Pearson or Spearman correlation, global or per group.
    An undefined correlation (constant column) is null."""
    by = list(by)
    d = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    if method == "spearman":
        d = average_rank(average_rank(d, x, by, "__rx"), y, by, "__ry")
        xx, yy = "__rx", "__ry"
    else:
        xx, yy = x, y
    g = d.groupBy(*by) if by else d
    # corr() raises DIVIDE_BY_ZERO under ANSI on a constant column; the
    # covariance form with try_divide gives null there instead
    r = F.try_divide(F.covar_pop(xx, yy), F.stddev_pop(xx) * F.stddev_pop(yy))
    return g.agg(F.count("*").alias("n"), half_up(r, scale).alias(f"{method}_corr"))


def group_profile(df: DataFrame, key: str, x: str, min_n: int = 50, scale: int = 4) -> DataFrame:
    """M8: per-group n / mean / min / max of ``x`` for groups with n >= min_n."""
    return (df.filter(F.col(x).isNotNull()).groupBy(key)
            .agg(F.count("*").alias("n"), half_up(F.avg(x), scale).alias("mean"),
                 F.min(x).alias("min"), F.max(x).alias("max"))
            .filter(F.col("n") >= min_n))


def cv_of_group_means(df: DataFrame, key: str, x: str, min_n: int = 50, scale: int = 6) -> DataFrame:
    """Coefficient of variation (sample std / mean) of the group means."""
    g = (df.filter(F.col(x).isNotNull()).groupBy(key)
         .agg(F.count("*").alias("__n"), F.avg(x).alias("__m")).filter(F.col("__n") >= min_n))
    return g.agg(F.count("*").alias("groups"),
                  half_up(F.try_divide(F.stddev_samp("__m"), F.avg("__m")), scale).alias("cv"))


def coherence_rate(df: DataFrame, a: str, b: str, k: float = 1.5, where: Column | None = None) -> DataFrame:
    """M7: share (%) of rows where a > k * b."""
    d = df.filter(where) if where is not None else df
    d = d.filter(F.col(a).isNotNull() & F.col(b).isNotNull())
    bad = F.count_if(F.col(a) > F.col(b) * k)
    return d.agg(F.count("*").alias("rows"), bad.alias("incoherent"),
                 half_up(F.try_divide(bad.cast("double") * 100.0, F.count("*").cast("double")), 4)
                 .alias("incoherent_pct"))


def fd_violations(df: DataFrame, lhs: Sequence[str], rhs: str) -> DataFrame:
    """Determinant values mapped to more than one dependent value."""
    return (df.groupBy(*lhs).agg(F.count_distinct(rhs).alias("distinct_values"))
            .filter(F.col("distinct_values") > 1))


def numeric_profile(df: DataFrame, cols: Sequence[str], scale: int = 4) -> DataFrame:
    """M13 / E14 describe(): count, mean, std, min, median, max, distinct per
    column, computed in one distributed pass over a long (column, value) view."""
    # "+ 0.0" folds IEEE negative zero into 0.0 so min / max / distinct are stable
    long = df.select(*[(F.col(c).cast("double") + F.lit(0.0)).alias(c) for c in cols]).unpivot(
        [], list(cols), "column", "value")
    stats = long.groupBy("column").agg(
        F.count("value").alias("count"), half_up(F.avg("value"), scale).alias("mean"),
        half_up(F.stddev_samp("value"), scale).alias("std"), F.min("value").alias("min"),
        F.max("value").alias("max"))
    med = exact_percentiles(long, "value", [0.5], ["column"], ["__med"])
    distinct = long.filter(F.col("value").isNotNull()).groupBy("column", "value").count() \
        .groupBy("column").agg(F.count("*").alias("distinct"))
    return (stats.join(med, "column", "left").join(distinct, "column", "left")
            .select("column", "count", "mean", "std", "min", half_up("__med", scale).alias("median"), "max",
                    F.coalesce("distinct", F.lit(0)).alias("distinct")))


def profile_columns(df: DataFrame, cols: Sequence[str] | None = None, sample_fmt: str = "yyyy-MM-dd",
                    bands: tuple[int, int] = (7, 15)) -> DataFrame:
    """M14 re-aimed: classify result columns as numeric / date / category /
    text from distinct counts and the share of values parsing as dates
    (> 80 %), in one pass over a long (column, value) view."""
    cols = list(cols or df.columns)
    num = {f.name for f in df.schema.fields if f.dataType.typeName() in
           ("integer", "long", "double", "float", "decimal", "short")}
    long = df.select(*[F.col(c).cast("string").alias(c) for c in cols]).unpivot(
        [], cols, "column", "value")
    p = long.groupBy("column").agg(
        F.count("value").alias("non_null"), F.count_distinct("value").alias("n_distinct"),
        half_up(F.avg(F.try_to_date("value", sample_fmt).isNotNull().cast("double")), 4)
        .alias("date_parse_rate"))
    lo, hi = bands
    kind = (F.when(F.col("column").isin(list(num) or [""]), "numeric")
            .when(F.col("date_parse_rate") > 0.8, "date")
            .when(F.col("n_distinct") <= lo, "category_small")
            .when(F.col("n_distinct") <= hi, "category_medium")
            .otherwise("text"))
    return p.withColumn("kind", kind)


def signal_gate(corr: Column, cv: Column, min_corr: float = 0.30, min_cv: float = 0.25) -> Column:
    """The target carries signal when |corr| > 0.30 or CV > 0.25."""
    return (F.abs(corr) > min_corr) | (cv > min_cv)
