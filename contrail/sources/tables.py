"""Table readers for the parquet test tables and for raw flight files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one table.  Parquet keeps pushdown and column pruning available to
    Catalyst: nothing is selected here, callers project what they use."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def register_views(spark: SparkSession, sf_dir: str, names=TABLES) -> None:
    """Expose the tables to ``spark.sql`` under their own names."""
    for n in names:
        table(spark, sf_dir, n).createOrReplaceTempView(n)
