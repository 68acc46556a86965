"""Reading the driver's parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One parquet table; zone-less timestamps are cast once to TIMESTAMP (UTC session)."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    casts = [F.col(f.name).cast("timestamp").alias(f.name)
             if isinstance(f.dataType, T.TimestampNTZType) else F.col(f.name)
             for f in df.schema.fields]
    return df.select(*casts)
