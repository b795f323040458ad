"""Ordered calculations per key that do not put a whole key into one task.

Every function takes ``chunk``: a column that grows with the order (a time bucket, a sequence number divided by
a block size). Rows are windowed inside ``(keys, chunk)``; what crosses a chunk border is carried by a table
with one row per ``(keys, chunk)``. A key with a third of all rows is therefore split over its chunks.
:func:`sized_chunks` makes chunks of time that are bounded by rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import cut_table
from .skew import ROWS_PER_TASK, bounded_broadcast, estimated_bytes

#: Into how many slices a chunk with too many rows is cut at once.
SLICES = 16


def block_chunk(seq: Column, size: int) -> Column:
    """Start of the block of ``size`` values that ``seq`` falls into; integers only."""
    return (seq - F.pmod(seq, F.lit(size))).cast("long")


def time_chunk(ts: Column, seconds: int) -> Column:
    return block_chunk(F.unix_micros(ts), seconds * 1_000_000)


def sized_chunks(df: DataFrame, keys: list[str], ts: str, seconds: int, *, name: str = "_slice", rows: int = ROWS_PER_TASK) -> DataFrame:
    """Add ``name``: the start, in microseconds, of the slice of time a row falls into, for use as ``chunk``.

    Slices are ``seconds`` wide. One with more than ``rows`` rows of a key is cut into sixteen, again and again, so a
    slice has more rows than that only where they share one microsecond. Of the keys and slices that are cut there are
    at most as many as ``rows`` goes into the number of all rows; nothing is counted where the optimizer's estimate
    of bytes shows that there can be none.
    """
    width = seconds * 1_000_000
    at = F.unix_micros(ts)
    df = df.withColumn(name, time_chunk(F.col(ts), seconds))
    if estimated_bytes(df) <= rows:
        return df

    def large(part: DataFrame):
        return cut_table(part.groupBy(*keys, name).count().where(F.col("count") > rows).select(*keys, name))

    full = large(df)
    while full.rows and width > 1:
        width = -(-width // SLICES)
        marked = df.join(bounded_broadcast(full.df.withColumn("_full", F.lit(True)), full.rows), [*keys, name], "left")
        within = at - F.col(name)
        df = marked.withColumn(name, F.when(F.col("_full"), F.col(name) + within - F.pmod(within, F.lit(width))).otherwise(F.col(name)))
        full = large(df.where("_full"))
        df = df.drop("_full")
    return df


def _neighbour(df, keys, order, cols, chunk, *, back: bool, prefix: str) -> DataFrame:
    df = df.withColumn("_chunk", chunk)
    ordering = [F.col(c).asc() if back else F.col(c).desc() for c in order]
    inside = Window.partitionBy(*keys, "_chunk").orderBy(*ordering)
    pick = F.max_by if back else F.min_by
    edge = df.groupBy(*keys, "_chunk").agg(
        pick(F.struct(*[F.col(c).alias(f"c_{c}") for c in cols]), F.struct(*order)).alias("_edge")
    )
    across = Window.partitionBy(*keys).orderBy(F.col("_chunk").asc() if back else F.col("_chunk").desc())
    edge = edge.select(*keys, "_chunk", F.lag("_edge").over(across).alias("_carry"))
    out = df.withColumn("_rn", F.row_number().over(inside))
    for c in cols:
        out = out.withColumn(f"_in_{c}", F.lag(c).over(inside))
    out = out.join(edge, [*keys, "_chunk"], "left")
    for c in cols:
        out = out.withColumn(
            f"{prefix}{c}",
            F.when(F.col("_rn") == 1, F.col("_carry")[f"c_{c}"]).otherwise(F.col(f"_in_{c}")),
        )
    return out.drop("_chunk", "_rn", "_carry", *[f"_in_{c}" for c in cols])


def with_previous(df: DataFrame, keys: list[str], order: list[str], cols: list[str], chunk: Column) -> DataFrame:
    """Add ``prev_<col>``: the value of the row before, per key. Keys must not be null."""
    return _neighbour(df, keys, order, cols, chunk, back=True, prefix="prev_")


def with_next(df: DataFrame, keys: list[str], order: list[str], cols: list[str], chunk: Column) -> DataFrame:
    """Add ``next_<col>``: the value of the row after, per key. Keys must not be null."""
    return _neighbour(df, keys, order, cols, chunk, back=False, prefix="next_")


def with_running(
    df: DataFrame, keys: list[str], order: list[str], outs: dict[str, tuple[str, Column]], chunk: Column
) -> DataFrame:
    """Add running ``sum`` or ``max`` columns: ``outs = {name: (kind, expression)}``."""
    agg = {"sum": F.sum, "max": F.max}
    df = df.withColumn("_chunk", chunk)
    for name, (_, expr) in outs.items():
        df = df.withColumn(f"_x_{name}", expr)
    inside = (
        Window.partitionBy(*keys, "_chunk").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    before = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    edge = df.groupBy(*keys, "_chunk").agg(*[agg[k](f"_x_{n}").alias(f"_e_{n}") for n, (k, _) in outs.items()])
    edge = edge.select(
        *keys, "_chunk", *[agg[k](f"_e_{n}").over(before).alias(f"_c_{n}") for n, (k, _) in outs.items()]
    )
    out = df
    for name, (kind, _) in outs.items():
        out = out.withColumn(f"_i_{name}", agg[kind](f"_x_{name}").over(inside))
    out = out.join(edge, [*keys, "_chunk"], "left")
    for name, (kind, _) in outs.items():
        i, c = F.col(f"_i_{name}"), F.col(f"_c_{name}")
        out = out.withColumn(name, F.coalesce(i + c, i, c) if kind == "sum" else F.greatest(i, c))
    drop = [f"_{p}_{n}" for n in outs for p in "xic"]
    return out.drop("_chunk", *drop)


def group_key(keys: list[str]) -> Column:
    """The key columns as one value that is never null, so that groups with null keys meet in joins."""
    return F.struct(F.lit(1).alias("one"), *[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)])


def exact_percentiles(
    df: DataFrame, keys: list[str], value: str, outs: dict[str, float], chunk: Column
) -> DataFrame:
    """Exact percentiles with linear interpolation per key: ``outs = {name: fraction}``.

    Equal values are counted map-side first; ranks come from running counts over chunks of the value range, so
    a key with most of the rows is neither one task nor one in-memory table. ``chunk`` is an expression of
    ``value``. Null values are ignored.
    """
    tag = ["_all"]
    counts = (
        df.where(F.col(value).isNotNull()).withColumn("_all", group_key(keys))
        .groupBy(*tag, value).agg(F.count("*").alias("_n"))
    )
    totals = counts.groupBy(*tag).agg(F.sum("_n").alias("_total"))
    ranked = with_running(counts, tag, [value], {"_upto": ("sum", F.col("_n"))}, chunk).join(totals, tag)

    def at(position: Column) -> Column:
        return F.min(F.when(F.col("_upto") > position, F.col(value)))

    aggs = []
    for name, q in outs.items():
        place = F.lit(q) * (F.col("_total") - 1)
        aggs += [at(F.floor(place)).alias(f"_lo_{name}"), at(F.ceil(place)).alias(f"_hi_{name}"),
                 F.max(place - F.floor(place)).alias(f"_f_{name}")]
    picked = ranked.groupBy(*tag).agg(*aggs)
    return picked.select(
        *[F.col("_all")[f"k{i}"].alias(k) for i, k in enumerate(keys)],
        *[
            (F.col(f"_lo_{n}") + (F.col(f"_hi_{n}") - F.col(f"_lo_{n}")) * F.col(f"_f_{n}")).alias(n) for n in outs
        ],
    )
