"""Snapshots, staged upserts and restores on plain parquet.

Spark has no UPDATE on plain parquet tables, so every change is written as a
new version beside the old one: ``<base>/v=<n>`` for table versions and
``<base>/_backup/ts=<yyyyMMdd_HHmm>`` for snapshots.  A job never overwrites
the path it reads, so a lost executor re-runs its task against unchanged
input, and a half-written version is never the newest committed one.
Locations live under the shared folder named by ``spark.checkpoint.dir``
(see :func:`contrail.session.checkpoint_dir`), never on a machine-local disk.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException


def exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.parquet(path).limit(0).collect()
        return True
    except AnalysisException:
        return False


def load_if_empty(df: DataFrame, path: str, **options: str) -> bool:
    """Idempotent load.  ``mode('ignore')`` writes only when nothing is
    there yet; returns True when this call wrote the data."""
    existed = exists(df.sparkSession, path)
    df.write.mode("ignore").options(**options).parquet(path)
    return not existed


def append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Append load."""
    w = df.write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def snapshot(df: DataFrame, base: str, ts: str | None = None) -> tuple[str, int]:
    """Copy ``df`` to ``<base>/_backup/ts=<ts>``; an existing snapshot of
    the same name is kept as is.  Returns (snapshot path, rows in it)."""
    ts = ts or _dt.datetime.now(_dt.UTC).strftime("%Y%m%d_%H%M")
    path = f"{base.rstrip('/')}/_backup/ts={ts}"
    spark = df.sparkSession
    if not exists(spark, path):
        df.write.mode("errorifexists").parquet(path)
    return path, spark.read.parquet(path).count()


def snapshots(spark: SparkSession, base: str) -> DataFrame:
    """All snapshots, read as one table partitioned by ``ts``."""
    return spark.read.parquet(f"{base.rstrip('/')}/_backup")


def restore(current: DataFrame, backup: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """A10: rows present in the backup get the backup's values of ``cols``
    (null included, as an UPDATE would set them); other rows are unchanged."""
    b = backup.select(F.col(key), F.lit(True).alias("__hit"),
                      *[F.col(c).alias(f"__b_{c}") for c in cols])
    j = current.join(b, key, "left")
    out = [F.when(F.col("__hit"), F.col(f"__b_{c}")).otherwise(F.col(c)).alias(c)
           if c in cols else F.col(c) for c in current.columns]
    return j.select(*out)


def restore_latest(spark: SparkSession, base: str, current: DataFrame, key: str,
                   cols: Sequence[str], ts: str | None = None) -> DataFrame:
    """A10: restore from the newest (or the named) snapshot; with no snapshot
    the current data is returned unchanged.  The snapshot is kept."""
    try:
        s = snapshots(spark, base)
    except AnalysisException:
        return current
    if ts is None:
        ts = s.agg(F.max("ts").cast("string")).first()[0]
    return restore(current, s.filter(F.col("ts").cast("string") == ts).drop("ts"), key, cols)


def staged_upsert(base: DataFrame, stage: DataFrame, key: str, cols: Sequence[str],
                  new_suffix: str = "_new") -> DataFrame:
    """Set-based UPDATE ... FROM stage.  Stage rows with no
    new value at all are dropped; each column takes COALESCE(new, old), so a
    null new value never erases an old one.  Keys missing in ``base`` are
    ignored (an UPDATE does not insert).  A key that the stage repeats counts
    once, with the greatest of its new values taken together, so the result
    has the rows of ``base`` whatever the stage holds."""
    new = [f"{c}{new_suffix}" for c in cols]
    any_new = None
    for n in new:
        any_new = F.col(n).isNotNull() if any_new is None else any_new | F.col(n).isNotNull()
    s = (stage.filter(any_new).groupBy(key).agg(F.max(F.struct(*new)).alias("__new"))
         .select(key, *[F.col(f"__new.{n}").alias(n) for n in new]))
    j = base.join(s, key, "left")
    return j.select(*[F.coalesce(F.col(f"{c}{new_suffix}"), F.col(c)).alias(c) if c in cols
                      else F.col(c) for c in base.columns])


def write_version(df: DataFrame, base: str, version: int) -> str:
    path = f"{base.rstrip('/')}/v={version}"
    df.write.mode("errorifexists").parquet(path)
    return path


BUCKETS = 256          # two hex digits of the key's md5


def key_bucket(key: str) -> Column:
    """The bucket of a row: it depends on the key alone."""
    return F.concat(F.lit("b"), F.substring(F.md5(F.col(key).cast("string")), 1, 2))    # never read as a number


def write_keyed(df: DataFrame, path: str, key: str) -> None:
    """A table in one folder a key bucket, so that a change can rewrite the buckets it touches."""
    # in the order of the keys, which share beginnings, so that a file is smaller
    (df.withColumn("bucket", key_bucket(key)).repartition("bucket").sortWithinPartitions("bucket", key)
     .write.mode("errorifexists").option("compression", "zstd").partitionBy("bucket").parquet(path))


def _replace_buckets(rows: DataFrame, path: str) -> None:
    """Rewrite the buckets that ``rows`` has (and no others), which are not read from ``path`` itself.  A bucket's
    rows stand in one task already (:func:`_matched`)."""
    (rows.write.mode("overwrite").options(partitionOverwriteMode="dynamic", compression="zstd")
     .partitionBy("bucket").parquet(path))


def _matched(rows: DataFrame, others: DataFrame, key: str, values: Column, name: str) -> DataFrame:
    """``rows`` with the greatest ``values`` that ``others`` has for their key as the struct ``name``, null without
    one (a null key has none).  Both have ``bucket`` and are shuffled by it once: matching needs no other
    shuffle, and neither does writing by bucket."""
    names = rows.columns
    both = rows.select(*names, F.lit(True).alias("__row"), F.lit(None).alias(name)).unionByName(
        others.filter(F.col(key).isNotNull()).select("bucket", key, F.lit(False).alias("__row"), values.alias(name)),
        allowMissingColumns=True)
    found = F.max(name).over(Window.partitionBy("bucket", key))
    return both.repartition("bucket").withColumn(name, found).filter("__row").select(*names, name)


def _buckets(rows: DataFrame) -> list[str]:
    return sorted(r[0] for r in rows.select("bucket").filter("bucket is not null").distinct().collect())   # 256 at most


def snapshot_buckets(table: DataFrame, path: str, buckets: Sequence[str], ts: str) -> str:
    """The named buckets as they are, under ``<path>-backup/ts=<ts>``; an existing snapshot is kept."""
    to = f"{path}-backup/ts={ts}"
    if not exists(table.sparkSession, to):
        (table.filter(F.col("bucket").isin(*buckets)).write.mode("errorifexists").option("compression", "zstd")
         .partitionBy("bucket").parquet(to))
    return to


def correct_keyed(spark: SparkSession, path: str, stage: DataFrame, key: str, cols: Sequence[str], ts: str) -> list[str]:
    """A9, A11, D16 end to end: snapshot the buckets that the stage touches, then rewrite just those.

    The new rows are made from the snapshot, never from the folders that are being replaced, so a
    task that runs again after a lost executor reads what the first one read; and a job that runs
    again as a whole starts from the same snapshot.  Returns the buckets touched."""
    # made once: it is read for its buckets and again for its rows
    at = f"{path}-stage/{uuid.uuid4().hex}"
    stage.withColumn("bucket", key_bucket(key)).write.option("compression", "zstd").parquet(at)
    staged = spark.read.parquet(at)
    touched = _buckets(staged)
    if not touched:
        return []
    table = spark.read.parquet(path)
    kept = spark.read.schema(table.schema).parquet(snapshot_buckets(table, path, touched, ts))
    # as :func:`staged_upsert`: stage rows without a new value don't count, a repeated key's greatest values do
    new = F.struct(*[f"{c}_new" for c in cols])
    some = staged.filter(reduce(Column.__or__, [F.col(f"{c}_new").isNotNull() for c in cols]))
    j = _matched(kept, some, key, new, "__new")
    _replace_buckets(j.select(*[F.coalesce(F.col(f"__new.{c}_new"), F.col(c)).alias(c) if c in cols else F.col(c)
                                for c in kept.columns]), path)
    return touched


def restore_keyed(spark: SparkSession, path: str, key: str, cols: Sequence[str], ts: str | None = None) -> list[str]:
    """A10: the newest (or the named) snapshot's values of ``cols`` come back for the rows it has; rows
    that came later stay.  The snapshot is kept; without one nothing is done.  Returns its buckets."""
    try:
        taken = spark.read.option("recursiveFileLookup", "false").parquet(f"{path}-backup")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    ts = ts if ts is not None else taken.agg(F.max(F.col("ts").cast("string"))).first()[0]
    backup = taken.filter(F.col("ts").cast("string") == ts).drop("ts")
    touched = _buckets(backup)
    if not touched:
        return []
    work = f"{path}-work/{uuid.uuid4().hex}"                  # the current rows, apart from the folders to be replaced
    spark.read.parquet(path).filter(F.col("bucket").isin(*touched)).write.option("compression", "zstd").parquet(work)
    now = spark.read.parquet(work)
    j = _matched(now, backup, key, F.struct(*cols), "__was")                                 # as :func:`restore`
    _replace_buckets(j.select(*[F.when(F.col("__was").isNotNull(), F.col(f"__was.{c}")).otherwise(F.col(c)).alias(c)
                                if c in cols else F.col(c) for c in now.columns]), path)
    return touched


def write_json_report(df: DataFrame, path: str) -> None:
    """Report rows as JSON lines, in as many files as the frame has tasks."""
    df.write.mode("overwrite").json(path)


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int) -> None:
    """Bucket a fact table by its join key so later joins / aggregations on
    that key need no shuffle (both sides bucketed alike)."""
    df.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).saveAsTable(table)


def catalogue(spark: SparkSession) -> DataFrame:
    """Tables and views known to the session catalog."""
    rows = [(t.name, t.tableType, bool(t.isTemporary)) for t in spark.catalog.listTables()]
    return spark.createDataFrame(rows, "name string, table_type string, is_temporary boolean")
