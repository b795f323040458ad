"""Change events to relationship tuples, and reports about the flow."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ordered import block_chunk, exact_percentiles, group_key
from ..functions.skew import spread_join
from ..model import TUPLE_COLS


def workspace_tuples(df: DataFrame) -> DataFrame:
    """Workspace changes ``(id, tenant_id, op)`` to parent tuples with ``sign`` +1 or -1; no tenant gives no tuple."""
    return df.where("coalesce(id, '') <> '' and coalesce(tenant_id, '') <> ''").select(
        F.lit("rbac/workspace").alias("res_type"), F.col("id").alias("res_id"), F.lit("t_parent").alias("relation"),
        F.lit("rbac/tenant").alias("sub_type"), F.col("tenant_id").alias("sub_id"), F.lit("").alias("sub_rel"),
        F.when(F.col("op") == "d", -1).otherwise(1).alias("sign"),
    )


def role_events(df: DataFrame) -> DataFrame:
    """Counts of role changes by outcome: roles are checked but give no tuple."""
    missing_ws = (F.col("op") != "d") & (F.coalesce("workspace_id", F.lit("")) == "")
    outcome = (
        F.when(F.coalesce("id", F.lit("")) == "", "missing_id").when(missing_ws, "missing_workspace").otherwise("ok")
    )
    return df.groupBy("op", outcome.alias("outcome")).agg(F.count("*").alias("events"))


def resource_tuples(
    df: DataFrame, namespace: str, name: str, relation: str = "t_workspace", *, keep: list[str] | None = None
) -> DataFrame:
    """Resource changes ``(id, workspace_id, resolved)`` to placement tuples with ``sign``; ``keep`` adds columns."""
    return df.where(F.col("resolved").isin("created", "updated", "deleted")).select(
        F.lit(f"{namespace}/{name}").alias("res_type"), F.col("id").alias("res_id"), F.lit(relation).alias("relation"),
        F.lit("rbac/workspace").alias("sub_type"), F.col("workspace_id").alias("sub_id"), F.lit("").alias("sub_rel"),
        F.when(F.col("resolved") == "deleted", -1).otherwise(1).alias("sign"), *(keep or []),
    )


def dispatch(df: DataFrame) -> DataFrame:
    """Add ``route``: ``<entity>_<create|update|delete>``; an unknown op or table gives ``skipped``."""
    action = F.when(F.col("op").isin("c", "r"), "create").when(F.col("op") == "u", "update").when(
        F.col("op") == "d", "delete"
    )
    entity = F.when(F.col("table") == "workspaces", "workspace").when(F.col("table") == "roles", "role")
    known = action.isNotNull() & entity.isNotNull()
    return df.withColumn("route", F.when(known, F.concat_ws("_", entity, action)).otherwise("skipped"))


def latest_state(df: DataFrame, keys: list[str], *, order: str = "lsn", drop_deleted: bool = True) -> DataFrame:
    """Newest image per key. One aggregation with map-side combine, so a key with many changes is no hot spot."""
    rest = [c for c in df.columns if c not in keys]
    out = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(order)).alias("_n")).select(*keys, "_n.*")
    return out.where("op <> 'd'") if drop_deleted else out


def dedupe(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row per event identity; ``keys`` should be the whole tuple and its transaction."""
    return df.dropDuplicates(keys)


def event_identity() -> list[str]:
    return ["namespace", "object_id", "relation", "userset_namespace", "userset_object_id", "userset_relation", "created_xid"]


def admin_changes(df: DataFrame) -> DataFrame:
    """Notifications for changes of organization admins."""
    return df.where("namespace = 'organization' and relation = 'admin'").select(
        F.col("object_id").alias("organization"), F.col("userset_object_id").alias("admin"), "operation", "ts_ms"
    )


def event_counts(df: DataFrame, by: list[str]) -> DataFrame:
    return df.groupBy(*by).agg(F.count("*").alias("events"))


def consumer_lag(df: DataFrame, critical: int = 1000) -> DataFrame:
    """Lag per ``(group, topic, partition)`` and its totals: rows with null partition are per topic, with null
    topic per group. Adds ``critical``."""
    lag = F.col("log_end_offset") - F.col("current_offset")
    return (
        df.withColumn("lag", lag)
        .rollup("group", "topic", "partition")
        .agg(F.sum("lag").alias("lag"))
        .where(F.col("group").isNotNull())
        .withColumn("critical", F.col("lag") > critical)
    )


def hop_latency(first: DataFrame, second: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Latency between two stages ``(event_id, at_ms)``: count and exact percentiles of the difference in ms."""
    a = first.withColumnRenamed("at_ms", "start_ms")
    b = second.select("event_id", F.col("at_ms").alias("end_ms"))
    keys = by or []
    took = spread_join(a, b, ["event_id"]).withColumn("took", F.col("end_ms") - F.col("start_ms")).select(*keys, "took")
    marks = exact_percentiles(
        took, keys, "took", {"p50_ms": 0.5, "p95_ms": 0.95, "p99_ms": 0.99}, block_chunk(F.col("took"), 60_000)
    )
    sums = took.groupBy(*keys).agg(F.count("*").alias("events"), F.avg("took").alias("mean_ms"))
    marks = marks.withColumn("_group", group_key(keys)).drop(*keys)
    return sums.withColumn("_group", group_key(keys)).join(marks, "_group").drop("_group")


# Base and longest backoff in seconds.
BASE_BACKOFF, MAX_BACKOFF = 1.0, 300.0


def retry_stats(df: DataFrame, keys: list[str]) -> DataFrame:
    """Attempts per message ``(keys, ok)``: failures, final success, expected total backoff without jitter.

    The wait after the n-th failure is ``min(base * 2^(n-1), max)``; the sum has a closed form, so no attempt
    list is built.
    """
    failures = F.sum(F.when(F.col("ok"), 0).otherwise(1))
    out = df.groupBy(*keys).agg(
        F.count("*").alias("attempts"), failures.cast("long").alias("failures"), F.bool_or("ok").alias("succeeded")
    )
    grow = 9  # failures whose wait is below the longest: 2^(9-1) = 256 < 300
    waits = BASE_BACKOFF * (F.pow(F.lit(2.0), F.least("failures", F.lit(grow))) - 1) + MAX_BACKOFF * F.greatest(
        F.col("failures") - grow, F.lit(0)
    )
    return out.withColumn("backoff_sec", waits)


def schema_changes(df: DataFrame) -> DataFrame:
    """Decoded schema changes: operation, 100-character preview of the definition, size, transaction."""
    definition = F.get_json_object("serialized_config", "$.definition")
    return df.where("operation is not null").select(
        "namespace", "operation", F.substring(definition, 1, 100).alias("preview"),
        F.length("serialized_config").alias("size"), F.col("created_xid").cast("long").alias("xid"),
    )


def change_report(df: DataFrame) -> DataFrame:
    """One text line per decoded relationship change; snapshot reads are reported as creations."""
    action = (
        F.when(F.col("operation").isin("CREATE", "READ"), "CREATED").when(F.col("operation") == "UPDATE", "UPDATED")
        .when(F.col("operation") == "DELETE", "DELETED")
    )
    head = F.concat(F.lit("Relationship "), action, F.lit(" "), "namespace", F.lit(":"), "object_id", F.lit("#"), "relation")
    subject = F.concat(F.lit("@"), "userset_namespace", F.lit(":"), "userset_object_id")
    tail = F.coalesce(F.nullif(F.col("userset_relation"), F.lit("")), F.lit("self"))
    line = F.when(action == "UPDATED", head).when(action == "DELETED", F.concat(head, subject)).otherwise(
        F.concat(head, subject, F.lit("#"), tail)
    )
    return df.where("operation is not null").withColumn("line", line)


def cdc_tuples(df: DataFrame) -> DataFrame:
    """Change log of workspaces to the tuples of its end state."""
    return workspace_tuples(latest_state(df, ["id"])).select(*TUPLE_COLS)
