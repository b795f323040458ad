"""Schemas of the relationship graph and the rule table."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .session import literal_table

TUPLE_COLS = ["res_type", "res_id", "relation", "sub_type", "sub_id", "sub_rel"]
LIVE_XID = 9223372036854775807  # fixed value: deleted_xid of a live tuple

TUPLES = T.StructType([T.StructField(c, T.StringType()) for c in TUPLE_COLS])

_TYPE = T.StructType([T.StructField("namespace", T.StringType()), T.StructField("name", T.StringType())])
_OBJECT = T.StructType([T.StructField("type", _TYPE), T.StructField("id", T.StringType())])
NESTED_TUPLE = T.StructType(
    [
        T.StructField("resource", _OBJECT),
        T.StructField("relation", T.StringType()),
        T.StructField(
            "subject",
            T.StructType([T.StructField("subject", _OBJECT), T.StructField("relation", T.StringType())]),
        ),
    ]
)
NESTED_REQUEST = T.StructType([T.StructField("tuples", T.ArrayType(NESTED_TUPLE))])

FLAT_CDC = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("workspace_id", T.StringType()),
        T.StructField("tenant_id", T.StringType()),
        T.StructField("created_at", T.LongType()),
        T.StructField("updated_at", T.LongType()),
        T.StructField("__op", T.StringType()),
        T.StructField("__table", T.StringType()),
        T.StructField("__lsn", T.LongType()),
        T.StructField("__source_ts_ms", T.LongType()),
        T.StructField("__deleted", T.StringType()),
    ]
)
RELATION_IMAGE = T.StructType(
    [
        T.StructField("namespace", T.StringType()),
        T.StructField("object_id", T.StringType()),
        T.StructField("relation", T.StringType()),
        T.StructField("userset_namespace", T.StringType()),
        T.StructField("userset_object_id", T.StringType()),
        T.StructField("userset_relation", T.StringType()),
        T.StructField("created_xid", T.StringType()),
        T.StructField("deleted_xid", T.StringType()),
    ]
)
SCHEMA_IMAGE = T.StructType(
    [
        T.StructField("namespace", T.StringType()),
        T.StructField("serialized_config", T.StringType()),
        T.StructField("created_xid", T.StringType()),
    ]
)
RESOURCE_PAYLOAD = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("type", "id", "displayName", "workspaceId")]
    + [
        T.StructField(
            "reporter",
            T.StructType(
                [T.StructField("type", T.StringType()), T.StructField("reporterInstanceId", T.StringType())]
            ),
        )
    ]
)
SAMPLES = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("labels", T.MapType(T.StringType(), T.StringType())),
        T.StructField("ts", T.TimestampType()),
        T.StructField("value", T.DoubleType()),
    ]
)


def envelope(image: T.StructType) -> T.StructType:
    """Before/after change envelope around a row image."""
    return T.StructType(
        [
            T.StructField("before", image),
            T.StructField("after", image),
            T.StructField("op", T.StringType()),
            T.StructField("ts_ms", T.LongType()),
        ]
    )


class Rule(NamedTuple):
    """One term of a permission. Terms with the same ``and_group`` (> 0) must hold together."""

    type: str
    permission: str
    and_group: int
    kind: str  # rel, perm or arrow
    relation: str
    target: str = ""


def rel(name: str) -> tuple[str, str, str]:
    return ("rel", name, "")


def perm(name: str) -> tuple[str, str, str]:
    return ("perm", name, "")


def arrow(relation: str, target: str) -> tuple[str, str, str]:
    return ("arrow", relation, target)


def any_of(type_: str, permission: str, *terms: tuple[str, str, str]) -> list[Rule]:
    """A permission that is the union of its terms."""
    return [Rule(type_, permission, 0, *t) for t in terms]


def all_of(type_: str, permission: str, *terms: tuple[str, str, str], group: int = 1) -> list[Rule]:
    """A permission that needs every term for the same subject."""
    return [Rule(type_, permission, group, *t) for t in terms]


RULES = T.StructType(
    [
        T.StructField("type", T.StringType()),
        T.StructField("permission", T.StringType()),
        T.StructField("and_group", T.IntegerType()),
        T.StructField("kind", T.StringType()),
        T.StructField("relation", T.StringType()),
        T.StructField("target", T.StringType()),
    ]
)


def rules_list(df: DataFrame) -> list[Rule]:
    """Rules kept in a table; a model has as many rows as it has terms."""
    return [Rule(*r) for r in df.select(*RULES.names).distinct().collect()]


def tuples_frame(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return literal_table(spark, rows, TUPLES)
