"""Projections for downstream tables, and writers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def split_dlq(df: DataFrame, error: Column) -> tuple[DataFrame, DataFrame]:
    """``(good, dead letters)``. ``error`` is null for good rows; a dead letter keeps key, original event and text."""
    marked = df.withColumn("_error", error)
    dead = marked.where("_error is not null").select(
        "key", F.col("value").alias("original"), F.col("_error").alias("error")
    )
    return marked.where("_error is null").drop("_error"), dead


def audit_log(df: DataFrame) -> DataFrame:
    """Decoded relationship changes to audit rows with a ``day`` to partition by."""
    when = F.timestamp_millis("ts_ms")
    return df.select(
        F.col("operation").alias("action"),
        F.concat_ws(":", "namespace", "object_id").alias("resource"),
        "relation",
        F.concat_ws(":", "userset_namespace", "userset_object_id").alias("subject"),
        F.col("ts_ms").alias("time_ms"),
        F.date_format(when, "yyyy-MM-dd").alias("day"),
    )


def write_batch(df: DataFrame, path: str, batch_id: int, by: tuple[str, ...] = ()) -> None:
    """Write one batch into its own folder ``batch=<id>``, divided by the columns ``by``.

    A batch that is written again, as after a failure, replaces what it wrote before, so no row counts twice.
    """
    df.write.mode("overwrite").partitionBy(*by).parquet(f"{path}/batch={batch_id}")


def read_batches(df: DataFrame, path: str) -> DataFrame:
    """All batches so far, with the columns of ``df``, which is what one of them looks like."""
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


def write_audit(df: DataFrame, path: str, batch_id: int, files_per_day: int = 8) -> None:
    """Audit rows of one batch by day; rows of one day are spread over up to ``files_per_day`` files by resource."""
    spread = F.pmod(F.xxhash64("resource"), F.lit(files_per_day))
    write_batch(df.repartition("day", spread), path, batch_id, ("day",))


def write_by_topic(df: DataFrame, path: str, batch_id: int) -> None:
    """Messages of one batch, in one folder per topic."""
    write_batch(df, path, batch_id, ("topic",))


def search_index_view(df: DataFrame, order: str = "lsn") -> DataFrame:
    """One document per ``namespace:object:relation``; the newest change wins."""
    body = F.struct("userset_namespace", "userset_object_id", "userset_relation", "operation")
    return (
        df.groupBy(F.concat_ws(":", "namespace", "object_id", "relation").alias("doc_id"))
        .agg(F.max_by(body, F.col(order)).alias("b"), F.max(order).alias(order))
        .select("doc_id", "b.*", order)
    )
