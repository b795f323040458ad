"""Checks of tuple tables against sources, models and each other."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..model import TUPLE_COLS
from ..session import literal_table
from .closure import closure, node_id, node_type, tuple_edges


def migration_report(tuples: DataFrame, expected: DataFrame | None = None) -> DataFrame:
    """``(kind, name, n, expected, ok)``: entities per type, and members per group.

    With ``expected(name, expected)`` a type is ok when it has that many entities, and types that were expected but
    are absent are reported with none. Without, what is there is ok. A group without members is not ok.
    """
    entities = tuples.groupBy(F.col("res_type").alias("name")).agg(F.countDistinct("res_id").alias("n"))
    if expected is None:
        entities = entities.withColumn("expected", F.lit(None).cast("long"))
    else:
        wanted = expected.select("name", F.col("expected").cast("long").alias("expected"))
        entities = entities.join(wanted, "name", "full_outer").withColumn("n", F.coalesce("n", F.lit(0)))
    member = F.col("relation").isin("member", "t_member")
    groups = (
        tuples.where(F.col("res_type").isin("group", "rbac/group"))
        .groupBy(F.col("res_id").alias("name"))
        .agg(F.count(F.when(member, 1)).alias("n"))
    )
    same = F.coalesce(F.col("n") == F.col("expected"), F.lit(expected is None))
    return entities.select(F.lit("entities").alias("kind"), "name", "n", "expected", same.alias("ok")).unionByName(
        groups.select(F.lit("members").alias("kind"), "name", "n", F.lit(None).cast("long").alias("expected"), (F.col("n") > 0).alias("ok"))
    )


# Cardinalities a model may state, with the least and the most subjects they allow.
CARDINALITIES = [("ExactlyOne", 1, 1), ("AtMostOne", 0, 1), ("AtLeastOne", 1, None), ("Any", 0, None)]


def check_cardinality(tuples: DataFrame, entities: DataFrame, spec: DataFrame) -> DataFrame:
    """Entities ``(res_type, res_id)`` whose distinct subjects on a relation are too few or too many.

    ``spec(res_type, relation, cardinality)`` states what the model asks for, one of :data:`CARDINALITIES`; any other
    name is an error. Returns ``(res_type, res_id, relation, cardinality, n)``. All rules are checked together: the
    tuples are counted once, and each entity meets the rules of its type.
    """
    kinds = literal_table(spec.sparkSession, CARDINALITIES, "cardinality string, least int, most int")
    unknown = spec.join(kinds, "cardinality", "left_anti").first()
    if unknown is not None:
        raise ValueError(f"unknown cardinality {unknown['cardinality']}")
    asked = spec.select("res_type", "relation", "cardinality").distinct().join(kinds, "cardinality").where("least > 0 or most is not null")
    # Subjects repeat only inside one relation of one entity, so a distinct count needs no shuffle of its own.
    counts = (
        tuples.join(asked.select("res_type", "relation").distinct(), ["res_type", "relation"], "left_semi")
        .select("res_type", "res_id", "relation", "sub_type", "sub_id", "sub_rel").distinct()
        .groupBy("res_type", "res_id", "relation").agg(F.count("*").alias("n"))
    )
    due = entities.select("res_type", "res_id").distinct().join(asked, "res_type")
    found = due.join(counts, ["res_type", "res_id", "relation"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return found.where("n < least or n > most").select("res_type", "res_id", "relation", "cardinality", "n")


def check_subject_types(tuples: DataFrame, allowed: DataFrame) -> DataFrame:
    """Tuples whose subject is not allowed. ``allowed(res_type, relation, sub_type, sub_rel, wildcard)``."""
    keys = ["res_type", "relation", "sub_type", "sub_rel", "wildcard"]
    return tuples.withColumn("wildcard", F.col("sub_id") == "*").join(allowed, keys, "left_anti").select(*TUPLE_COLS)


def lint_tuples(tuples: DataFrame, relations: DataFrame, parents: list[str]) -> DataFrame:
    """Problems ``(problem, res_type, res_id, detail)``.

    ``relations(res_type, relation)`` lists what the model declares; ``parents`` are the hierarchy relations.
    Reported: undefined types and relations, repeated tuples, parents that are never described, cycles.
    """
    types = relations.select("res_type").distinct()
    undefined_type = tuples.join(types, "res_type", "left_anti").select(
        F.lit("undefined type").alias("problem"), "res_type", "res_id", F.col("res_type").alias("detail")
    )
    undefined_relation = (
        tuples.join(types, "res_type", "left_semi").join(relations, ["res_type", "relation"], "left_anti")
        .select(F.lit("undefined relation").alias("problem"), "res_type", "res_id", F.col("relation").alias("detail"))
    )
    repeated = tuples.groupBy(*TUPLE_COLS).count().where("count > 1").select(
        F.lit("repeated tuple").alias("problem"), "res_type", "res_id", F.col("relation").alias("detail")
    )
    links = tuples.where(F.col("relation").isin(parents) & (F.col("sub_rel") == ""))
    described = tuples.select(F.col("res_type").alias("sub_type"), F.col("res_id").alias("sub_id")).distinct()
    dangling = links.join(described, ["sub_type", "sub_id"], "left_anti").select(
        F.lit("dangling parent").alias("problem"), "res_type", "res_id",
        F.concat_ws(":", "sub_type", "sub_id").alias("detail"),
    )
    cycle = closure(tuple_edges(tuples, parents)).where("src = dst").select(
        F.lit("cycle").alias("problem"), node_type("src").alias("res_type"), node_id("src").alias("res_id"),
        F.concat(F.lit("length "), "depth").alias("detail"),
    )
    parts = [undefined_type, undefined_relation, repeated, dangling, cycle]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.distinct()


def reconcile(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Each tuple of either side with ``status`` matched, missing or extra."""
    a = expected.select(*TUPLE_COLS).distinct().withColumn("_e", F.lit(True))
    b = actual.select(*TUPLE_COLS).distinct().withColumn("_a", F.lit(True))
    status = F.when(F.col("_a").isNull(), "missing").when(F.col("_e").isNull(), "extra").otherwise("matched")
    return a.join(b, TUPLE_COLS, "full_outer").select(*TUPLE_COLS, status.alias("status"))


def tuple_counts(tuples: DataFrame) -> DataFrame:
    return tuples.groupBy("res_type", "relation").agg(F.count("*").alias("tuples"))


def run_summary(df: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Totals of a test run with BOOLEAN ``passed``: success rate in percent, 1 digit, 0 when empty."""
    total, passed = F.count("*"), F.count(F.when(F.col("passed"), 1))
    rate = F.when(total > 0, F.round(100.0 * passed / F.greatest(total, F.lit(1)), 1)).otherwise(0.0)
    return df.groupBy(*(by or [])).agg(
        total.alias("total"), passed.alias("passed_tests"), (total - passed).alias("failed_tests"), rate.alias("success_rate")
    )
