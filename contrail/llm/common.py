"""Shared helpers: table reading, work folders, files in the shared store."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession

from contrail.session import checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def work_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, which every executor sees."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def settled(df: DataFrame, folder: str, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts lineage in a way that survives lost executors; later steps read the
    files, whoever wrote them.
    """
    spark = df.sparkSession
    path = f"{folder}/{name}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def sized(df: DataFrame, rows: int, a_task: int) -> DataFrame:
    """At most one task for each ``a_task`` of the counted ``rows``: small tables
    don't pay for the partitions of large ones."""
    return df.coalesce(max(1, -(-rows // a_task)))


def open_store(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder in the shared store (any URI pyarrow knows)."""
    return pafs.FileSystem.from_uri(uri)


def rows_kept(docs: DataFrame, keep: Callable[[list[str]], list[bool]], text_col: str = "text") -> DataFrame:
    """The rows whose texts ``keep`` accepts, all columns as they are; nothing is
    shuffled.  A null text is judged as the empty one."""
    place = docs.columns.index(text_col)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                part = batch.slice(i, 512)
                mask = keep([t or "" for t in part.column(place).to_pylist()])
                yield part.filter(pa.array(mask, pa.bool_()))

    return docs.mapInArrow(rows, docs.schema)
