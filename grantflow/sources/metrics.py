"""Metric samples and health observations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..model import SAMPLES


def read_samples(spark: SparkSession, path: str, fmt: str = "parquet", *, stream: bool = False) -> DataFrame:
    """Samples ``(name, labels, ts, value)`` from files, as a batch or as a stream."""
    reader = spark.readStream if stream else spark.read
    return reader.schema(SAMPLES).format(fmt).load(path)


def to_samples(df: DataFrame, name: str, labels: list[str], ts: str = "ts", value: str = "value") -> DataFrame:
    """Typed columns to samples: the given columns become labels; empty labels are left out."""
    pairs = F.map_from_arrays(F.array(*[F.lit(c) for c in labels]), F.array(*[F.col(c).cast("string") for c in labels]))
    return df.select(
        F.lit(name).alias("name"),
        F.map_filter(pairs, lambda _, v: v.isNotNull() & (v != "")).alias("labels"),
        F.col(ts).cast("timestamp").alias("ts"), F.col(value).cast("double").alias("value"),
    )


def health_to_up(df: DataFrame) -> DataFrame:
    """Observations ``(job, ts, status)`` to ``up`` samples: status 200 to 399 is 1, anything else or none is 0."""
    up = F.when(F.col("status").between(200, 399), 1.0).otherwise(0.0)
    return df.select(
        F.lit("up").alias("name"), F.create_map(F.lit("job"), F.col("job")).alias("labels"), "ts", up.alias("value")
    )
