"""Joins whose key may be hot."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_BROADCAST_ROWS = 100_000


def bounded_broadcast(df: DataFrame, rows: int) -> DataFrame:
    """Broadcast hint only when the known row count is small; otherwise Spark chooses the join."""
    return F.broadcast(df) if rows <= MAX_BROADCAST_ROWS else df


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate; no job is run. It is an upper bound for scans, filters and unions."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


#: Rows of one key that a task may get; a key with more is spread over as many tasks as that takes.
ROWS_PER_TASK = 5_000_000

#: Least bytes of a row in the optimizer's estimate.
ROW_BYTES = 16


def hot_keys(df: DataFrame, keys: list[str], rows_per_task: int) -> DataFrame:
    """Keys with more than ``rows_per_task`` rows and the ``_ways`` to spread them over. There are at most
    ``rows / rows_per_task`` of them."""
    counts = df.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") > rows_per_task)
    return counts.select(*keys, F.ceil(F.col("_n") / rows_per_task).cast("int").alias("_ways"))


def spread_join(
    big: DataFrame,
    other: DataFrame,
    on: list[str],
    *,
    how: str = "inner",
    rows: int | None = None,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Equi-join where single keys of ``big`` may hold a large share of its rows.

    A key with more than ``rows_per_task`` rows is spread over as many salts as its count asks for, and the matching
    rows of ``other`` are repeated once per salt; other keys join as usual. Keys are not counted where the number of
    rows, or an upper bound of it from the optimizer's estimate, shows that none can have so many.
    ``how`` may be inner, left, left_semi or left_anti (``big`` is the left side).
    """
    if rows is None:
        rows = estimated_bytes(big) // ROW_BYTES
    if rows <= rows_per_task:
        return big.join(other, on, how)
    hot = hot_keys(big, on, rows_per_task)
    found = hot.collect()
    if not found:
        return big.join(other, on, how)
    hot = bounded_broadcast(big.sparkSession.createDataFrame(found, hot.schema), len(found))
    rest = [c for c in big.columns if c not in on] or on
    ways = F.coalesce("_ways", F.lit(1))
    left = big.join(hot, on, "left").withColumn("_salt", F.pmod(F.xxhash64(*rest), ways).cast("int")).drop("_ways")
    right = other.join(hot, on, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), ways - 1))).drop("_ways")
    return left.join(right, [*on, "_salt"], how).drop("_salt")


def conj(conds: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conds, F.lit(True))
