"""Lists per group that stay bounded per row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import cut
from .ordered import group_key


def paged_lists(rows: DataFrame, keys: list[str], value: str, out: str, page: int = 10_000) -> DataFrame:
    """Sorted distinct values per group as ``(keys, page, pages, out)``.

    Page ``i`` has the values of rank ``i * page`` to ``(i + 1) * page - 1`` in the order of the whole group, so the
    pages one after the other are the sorted list, whatever its length. Nothing is left out. Ranks are counted
    inside ranges of the order of all groups, dealt by Spark; one row per group and range carries the counts on.
    """
    distinct = rows.select(group_key(keys).alias("_group"), F.col(value).alias("_value")).distinct()
    # Sorted runs of the whole order: a group lies in neighbouring ranges, and a large one in many.
    ranged = cut(distinct.repartitionByRange("_group", F.col("_value").asc_nulls_last()).withColumn("_range", F.spark_partition_id()))
    edge = ranged.groupBy("_group", "_range").agg(F.count("*").alias("_n"), F.count("_value").alias("_values"))
    before = Window.partitionBy("_group").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    edge = edge.select(
        "_group", "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
        F.sum("_values").over(Window.partitionBy("_group")).alias("_all"),
    )
    inside = F.row_number().over(Window.partitionBy("_group", "_range").orderBy(F.col("_value").asc_nulls_last())) - 1
    ranked = ranged.withColumn("_rank", inside).join(edge, ["_group", "_range"])
    # A null comes last and adds no page; a group of null alone is one empty page.
    pages = F.greatest(F.ceil(F.col("_all") / F.lit(page)), F.lit(1).cast("long"))
    place = F.floor((F.col("_before") + F.col("_rank")) / F.lit(page))
    paged = ranked.select("_group", "_value", F.least(place, pages - 1).alias("page"), pages.alias("pages"))
    lists = paged.groupBy("_group", "page", "pages").agg(F.sort_array(F.collect_list("_value")).alias(out))
    return lists.select(*[F.col("_group")[f"k{i}"].alias(k) for i, k in enumerate(keys)], "page", "pages", out)
