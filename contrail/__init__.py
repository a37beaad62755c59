"""contrail: flight-operations analytics expressed as Spark DataFrame plans.

Sub-packages
------------
sources    readers, writers, versioned snapshots / staged upserts
functions  pure Column expressions (cleaning, keys, numerics, physics)
operators  DataFrame -> DataFrame building blocks (windows, dedupe, lookups,
           quality audits, corpus jobs, Spark ML)
plans      the flight mart and the report catalogue built on it
streaming  Structured Streaming re-aims of batch operators
"""

from contrail.session import get_spark, checkpoint_dir  # noqa: F401

__all__ = ["get_spark", "checkpoint_dir"]
