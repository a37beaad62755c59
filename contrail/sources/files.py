"""Delimited / JSON-lines readers with explicit schemas."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_delimited(spark: SparkSession, path: str, schema: T.StructType | str,
                   sep: str = ";", header: bool = True,
                   columns: Sequence[str] | None = None) -> DataFrame:
    """A1 / A2: read a delimited file with a declared schema (no inference
    pass), PERMISSIVE so malformed fields become null.  A single ``.gz``
    file is not splittable: land it once as parquet before heavy use."""
    df = (spark.read.schema(schema).option("sep", sep).option("header", header)
          .option("mode", "PERMISSIVE").option("nullValue", "").csv(path))
    return df.select(*columns) if columns else df


def with_missing_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """A3: a catalogue that lacks some columns gets them as typed nulls."""
    for f in schema.fields:
        if f.name not in df.columns:
            df = df.withColumn(f.name, F.lit(None).cast(f.dataType))
    return df.select(*[f.name for f in schema.fields])


CORPUS_SCHEMA = T.StructType([T.StructField("instruction", T.StringType()),
                              T.StructField("input", T.StringType()),
                              T.StructField("output", T.StringType())])


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType = CORPUS_SCHEMA,
               keep_corrupt: bool = True) -> DataFrame:
    """JSON lines with a schema; unparseable lines are kept in
    ``_corrupt_record`` instead of failing the read."""
    s = schema
    if keep_corrupt:
        s = T.StructType(schema.fields + [T.StructField("_corrupt_record", T.StringType())])
    return (spark.read.schema(s).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", "_corrupt_record").json(path))


def write_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)
