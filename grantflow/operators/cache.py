"""Decision cache as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.paging import paged_lists
from ..functions.skew import spread_join
from .closure import reachable

# Time to live in seconds.
TTL = {"perm": 60, "rel": 30, "schema": 300}


def fresh(df: DataFrame, at, ttl: int = TTL["perm"]) -> DataFrame:
    """Entries still valid at ``at``; one that is exactly ``ttl`` old has expired."""
    return df.where(F.col("cached_at") + F.expr(f"interval {int(ttl)} seconds") > at)


def subjects_list(tuples: DataFrame, page: int = 10_000) -> DataFrame:
    """Sorted subject list per ``resource#relation``: ``(res_type, res_id, relation, page, pages, subjects)``."""
    key = ["res_type", "res_id", "relation"]
    text = F.concat(
        F.col("sub_type"), F.lit(":"), F.col("sub_id"),
        F.when(F.col("sub_rel") == "", "").otherwise(F.concat(F.lit("#"), "sub_rel")),
    )
    return paged_lists(tuples.select(*key, text.alias("subject")), key, "subject", "subjects", page)


def invalidate_rel(decisions: DataFrame, changes: DataFrame) -> DataFrame:
    """Decisions left after relationship changes: every decision of a changed object goes."""
    hit = changes.select("res_type", "res_id").distinct()
    return decisions.join(hit, ["res_type", "res_id"], "left_anti")


def invalidate_lists(lists: DataFrame, changes: DataFrame) -> DataFrame:
    """Relation lists left after relationship changes."""
    keys = ["res_type", "res_id", "relation"]
    return lists.join(changes.select(*keys).distinct(), keys, "left_anti")


def invalidate_schema(decisions: DataFrame, schemas: DataFrame, changed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(decisions, schema entries)`` left after schema changes ``(res_type)``."""
    hit = changed.select("res_type").distinct()
    return decisions.join(hit, "res_type", "left_anti"), schemas.join(hit, "res_type", "left_anti")


def dependants(tuples: DataFrame, changes: DataFrame) -> DataFrame:
    """Objects whose decisions can depend on the changed ones: everything that reaches them as a subject."""
    edges = tuples.where("sub_id <> '*'").select(
        F.concat_ws(":", "sub_type", "sub_id").alias("src"), F.concat_ws(":", "res_type", "res_id").alias("dst")
    )
    seeds = changes.select(F.concat_ws(":", "res_type", "res_id").alias("src")).distinct()
    return reachable(seeds, edges).select(F.col("dst").alias("object"))


def invalidate_transitive(decisions: DataFrame, changes: DataFrame, tuples: DataFrame) -> DataFrame:
    """Decisions left when dependants of the changed objects go as well."""
    hit = dependants(tuples, changes)
    return spread_join(
        decisions.withColumn("object", F.concat_ws(":", "res_type", "res_id")), hit, ["object"], how="left_anti"
    ).drop("object")


def cache_stats(df: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Hits, misses, total and hit rate in percent (2 digits, 0 when empty) from rows with BOOLEAN ``hit``."""
    hits = F.coalesce(F.sum(F.col("hit").cast("long")), F.lit(0)).cast("long")
    total = F.count("hit")
    rate = F.when(total > 0, F.round(100.0 * hits / F.greatest(total, F.lit(1)), 2)).otherwise(0.0)
    return df.groupBy(*(by or [])).agg(
        hits.alias("hits"), (total - hits).alias("misses"), total.alias("total"), rate.alias("hit_rate")
    )
