"""Decoding and routing of change events and outbox rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..model import FLAT_CDC, RELATION_IMAGE, RESOURCE_PAYLOAD, envelope

# Operation codes and their names.
OPERATIONS = {"c": "CREATE", "u": "UPDATE", "d": "DELETE", "r": "READ"}


def operation_name(op: Column) -> Column:
    out = F.lit(None).cast("string")
    for code, name in OPERATIONS.items():
        out = F.when(op == code, name).otherwise(out)
    return out


def decode_flat_cdc(df: DataFrame, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """Flattened JSON change events: ``(good rows, malformed rows)``. Other columns are kept."""
    schema = T.StructType([*FLAT_CDC.fields, T.StructField("_bad", T.StringType())])
    rest = [c for c in df.columns if c != value]
    parsed = df.withColumn(
        "_e", F.from_json(value, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    )
    broken = F.col("_e").isNull() | F.col("_e._bad").isNotNull()
    good = parsed.where(~broken).select(
        *rest, "_e.id", "_e.name", "_e.description", "_e.workspace_id", "_e.tenant_id", "_e.created_at",
        "_e.updated_at", F.col("_e.__op").alias("op"), F.col("_e.__table").alias("table"),
        F.col("_e.__lsn").alias("lsn"), F.col("_e.__source_ts_ms").alias("source_ms"),
        (F.lower("_e.__deleted") == "true").alias("deleted"),
    )
    return good, parsed.where(broken).select(*rest, value)


def decode_envelope(df: DataFrame, image: T.StructType = RELATION_IMAGE, value: str = "value") -> DataFrame:
    """Before/after envelopes: the row image is ``after``, else ``before``; adds ``op, operation, ts_ms``."""
    rest = [c for c in df.columns if c != value]
    return (
        df.withColumn("_e", F.from_json(value, envelope(image)))
        .where("_e.op is not null")
        .withColumn("_i", F.coalesce("_e.after", "_e.before"))
        .select(*rest, "_i.*", F.col("_e.op").alias("op"), operation_name(F.col("_e.op")).alias("operation"),
                F.col("_e.ts_ms").alias("ts_ms"))
    )


def unwrap_cdc(df: DataFrame, fields: list[str]) -> DataFrame:
    """Change record with structs ``before``, ``after``, ``source`` and ``op`` to a flat row.

    The new image is kept; a delete keeps the old image with ``__deleted = 'true'``.
    """
    gone = F.col("op") == "d"
    image = F.when(gone, F.col("before")).otherwise(F.col("after"))
    rest = [c for c in df.columns if c not in ("before", "after", "op", "source")]
    return df.withColumn("_i", image).select(
        *rest, *[F.col(f"_i.{f}").alias(f) for f in fields], F.col("op").alias("__op"),
        F.col("source.table").alias("__table"), F.col("source.lsn").alias("__lsn"),
        F.col("source.ts_ms").alias("__source_ts_ms"),
        F.when(gone, "true").otherwise("false").alias("__deleted"),
    )


# Topic pattern and its replacement.
TOPIC_PATTERN = r"^([^.]+)\.([^.]+)\.([^.]+)$"
TOPIC_REPLACEMENT = "$1.$3.events"


def route_regex(topic: Column) -> Column:
    """``a.b.c`` to ``a.c.events``; other topics are unchanged."""
    return F.regexp_replace(topic, TOPIC_PATTERN, TOPIC_REPLACEMENT)


def route_outbox(df: DataFrame, prefix: str, header_cols: tuple[str, ...] = ("operation", "version")) -> DataFrame:
    """Outbox inserts as messages ``(event_id, topic, key, event_type, payload, value, headers)``; others route nothing.

    ``value`` is the payload as it came, ``payload`` its top-level fields as a map of texts (inner objects stay JSON),
    so payloads of any aggregate type keep all their fields.
    """
    headers = F.map_from_arrays(
        F.array(*[F.lit(c) for c in header_cols]), F.array(*[F.col(c) for c in header_cols])
    )
    return df.where("op = 'c'").select(
        F.col("id").alias("event_id"), F.concat(F.lit(f"outbox.event.{prefix}."), "aggregatetype").alias("topic"),
        F.col("aggregateid").alias("key"), F.col("type").alias("event_type"),
        F.from_json("payload", "map<string,string>").alias("payload"), F.col("payload").alias("value"), headers.alias("headers"),
    )


def parse_resource_event(df: DataFrame, value: str = "payload") -> DataFrame:
    """Report/delete resource payloads to columns; ``kind`` is the outbox event type."""
    rest = [c for c in df.columns if c != value]
    return df.withColumn("_p", F.from_json(value, RESOURCE_PAYLOAD)).select(
        *rest, F.col("_p.type").alias("res_type"), F.col("_p.id").alias("res_id"),
        F.col("_p.displayName").alias("display_name"), F.col("_p.workspaceId").alias("workspace_id"),
        F.col("_p.reporter.type").alias("reporter"), F.col("_p.reporter.reporterInstanceId").alias("instance"),
    )


def resolve_operation(df: DataFrame, *, strict_header: bool = False) -> DataFrame:
    """Add ``resolved`` from column ``header`` (null when absent) and ``payload_operation``; unknown ones are dropped.

    By default a missing header falls back to the payload. ``strict_header`` reproduces the behaviour where a
    missing header means ``created`` and only an empty one falls back.
    """
    own = F.nullif(F.col("payload_operation"), F.lit(""))
    header = F.coalesce("header", F.lit("created")) if strict_header else F.col("header")
    resolved = F.coalesce(F.nullif(header, F.lit("")), own, F.lit("" if strict_header else "created"))
    return df.withColumn("resolved", resolved).where(F.col("resolved").isin("created", "updated", "deleted"))
