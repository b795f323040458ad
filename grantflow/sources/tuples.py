"""Relationship tuples from text and nested form."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import parse_object
from ..model import NESTED_REQUEST, TUPLE_COLS


def parse_tuple_text(df: DataFrame) -> DataFrame:
    """``resource, relation, subject`` texts to tuple columns plus BOOLEAN ``valid``.

    A subject or resource without a type is malformed; it is flagged, not dropped.
    """
    out = df.withColumn("_r", parse_object(F.col("resource"))).withColumn("_s", parse_object(F.col("subject")))
    ok = (F.col("_r.type") != "") & (F.col("_s.type") != "") & (F.col("_r.rel") == "") & (F.col("relation") != "")
    return out.select(
        F.col("_r.type").alias("res_type"), F.col("_r.id").alias("res_id"), "relation",
        F.col("_s.type").alias("sub_type"), F.col("_s.id").alias("sub_id"), F.col("_s.rel").alias("sub_rel"),
        F.coalesce(ok, F.lit(False)).alias("valid"),
        *[c for c in df.columns if c not in ("resource", "relation", "subject")],
    )


def read_tuples_text(spark: SparkSession, path: str, *, lines: bool = False) -> DataFrame:
    """Tuples from JSON arrays of ``{resource, relation, subject}``; arrays may span lines, so a file is one task.

    ``lines=True`` reads JSON Lines, which Spark splits.
    """
    raw = spark.read.schema("resource string, relation string, subject string").json(path, multiLine=not lines)
    return parse_tuple_text(raw).where("valid").select(*TUPLE_COLS)


def flatten_nested(df: DataFrame) -> DataFrame:
    """A column ``tuples`` of nested tuples to tuple columns; ``namespace/name`` becomes the type."""

    def type_of(path: str):
        return F.concat_ws("/", F.col(f"{path}.type.namespace"), F.col(f"{path}.type.name"))

    return df.select(F.explode("tuples").alias("t")).select(
        type_of("t.resource").alias("res_type"), F.col("t.resource.id").alias("res_id"),
        F.col("t.relation").alias("relation"),
        type_of("t.subject.subject").alias("sub_type"), F.col("t.subject.subject.id").alias("sub_id"),
        F.coalesce("t.subject.relation", F.lit("")).alias("sub_rel"),
    )


def read_tuples_nested(df: DataFrame, value: str = "value") -> DataFrame:
    """JSON request bodies ``{"tuples": [...]}`` in column ``value`` to tuple columns."""
    return flatten_nested(df.select(F.from_json(value, NESTED_REQUEST).alias("b")).select("b.tuples"))
