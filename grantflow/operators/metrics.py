"""Counter rates, quantiles and ratios over metric samples.

Samples are ``(name, labels, ts, value)``. Range operators look back from evaluation times, which are the
multiples of ``step`` seconds; a look-back covers ``(t - range, t]``. A range needs two samples, a falling
counter is a restart, and nothing is extrapolated to the edges of the range.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions.ordered import block_chunk, with_previous

SERIES = ["name", "series"]
CHUNK = 86_400  # seconds of one series whose panes are put in order by one task


def series_key(labels: Column) -> Column:
    """Labels as JSON text in label order, to group by; ``series_labels`` turns it back."""
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(labels))))


def series_labels(series: Column) -> Column:
    return F.from_json(series, T.MapType(T.StringType(), T.StringType())).alias("labels")


def _grid(us: Column, range_s: int, step_s: int) -> Column:
    """Evaluation times (microseconds) whose look-back contains the pane that ends at ``us``."""
    step, span = F.lit(step_s * 1_000_000), F.lit(range_s * 1_000_000)
    first = us + F.pmod(-us, step)
    last = us + span - 1
    last = last - F.pmod(last, step)
    return F.when(last >= first, F.sequence(first, last, step)).otherwise(F.array().cast("array<bigint>"))


def _increase(before: Column, after: Column) -> Column:
    """Growth of a counter between two samples; a falling value is a restart from zero."""
    return F.when(after < before, after).otherwise(after - before)


def _panes(df: DataFrame, range_s: int, step_s: int) -> DataFrame:
    """Samples ``(name, series, us, value)`` with the end of their ``pane``: the largest equal slices of time of which
    every look-back is made."""
    width = F.lit(math.gcd(range_s, step_s) * 1_000_000)
    rows = df.select("name", series_key(F.col("labels")).alias("series"), F.unix_micros("ts").alias("us"), "value")
    return rows.withColumn("pane", F.col("us") + F.pmod(-F.col("us"), width))


def ranges(df: DataFrame, range_s: int, step_s: int = 30, *, chunk: int = CHUNK) -> DataFrame:
    """What rates and last values are made of, per series and evaluation time in one pass over the samples.

    Columns: ``name, series, t``, the number ``n`` and first and last time ``lo, hi`` of the samples in the look-back,
    their increase ``grown``, the last two samples as ``tail`` (``us, prev_us, grown``) and the ``last`` value. A
    series is ordered inside its panes, so a task gets the samples of one series in one pane at most; only one row per
    pane is carried over the borders and added to the evaluation times. Of samples with equal time the larger value
    counts as the later one.
    """
    order = F.struct("us", "value")
    inside = Window.partitionBy(*SERIES, "pane").orderBy("us", "value")
    rows = _panes(df, range_s, step_s).withColumns(
        {"prev_us": F.lag("us").over(inside), "grown": _increase(F.lag("value").over(inside), F.col("value"))}
    )
    panes = rows.groupBy(*SERIES, "pane").agg(
        F.count("*").alias("n"), F.min("us").alias("lo"), F.max("us").alias("hi"), F.sum("grown").alias("rest"),
        F.min_by("value", order).alias("head"), F.max_by("value", order).alias("last"),
        F.max_by(F.struct("us", "prev_us", "grown"), order).alias("tail"),
    )
    panes = with_previous(panes, SERIES, ["pane"], ["hi", "last"], block_chunk(F.col("pane"), chunk * 1_000_000))
    panes = panes.withColumn("across", _increase(F.col("prev_last"), F.col("head")))
    border = F.struct(F.col("hi").alias("us"), F.col("prev_hi").alias("prev_us"), F.col("across").alias("grown"))
    panes = panes.withColumn("tail", F.when(F.col("n") == 1, border).otherwise(F.col("tail")))
    panes = panes.withColumn("t", F.explode(_grid(F.col("pane"), range_s, step_s)))
    joined = F.when(F.col("prev_hi") > F.col("t") - F.lit(range_s * 1_000_000), F.col("across"))
    return (
        panes.groupBy(*SERIES, "t")
        .agg(
            F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"),
            F.sum(F.coalesce(F.col("rest") + joined, "rest", joined)).alias("grown"),
            F.max_by("tail", "pane").alias("tail"), F.max_by("last", "pane").alias("last"),
        )
    )


def rate_value() -> Column:
    """Per-second increase of a row of :func:`ranges`; null with fewer than two samples or no time between them."""
    return F.when(
        (F.col("n") >= 2) & (F.col("hi") > F.col("lo")), F.col("grown") / ((F.col("hi") - F.col("lo")) / 1e6)
    )


def irate_value(range_s: int) -> Column:
    """Increase per second between the last two samples; null where they are not both in the look-back or of one time."""
    tail = F.col("tail")
    both = (tail["prev_us"] > F.col("t") - F.lit(range_s * 1_000_000)) & (tail["us"] > tail["prev_us"])
    return F.when(both, tail["grown"] / ((tail["us"] - tail["prev_us"]) / 1e6))


def _by_labels(df: DataFrame, value: Column) -> DataFrame:
    return df.select("name", series_labels(F.col("series")), F.timestamp_micros("t").alias("t"), value.alias("value"))


def rate(df: DataFrame, range_s: int, step_s: int = 30, *, chunk: int = CHUNK) -> DataFrame:
    """Per-second increase over the look-back at every evaluation time: ``(name, labels, t, value)``."""
    rows = ranges(df, range_s, step_s, chunk=chunk)
    return _by_labels(rows.where("n >= 2 and hi > lo"), rate_value())


def irate(df: DataFrame, range_s: int, step_s: int = 30, *, chunk: int = CHUNK) -> DataFrame:
    """Rate between the last two samples of the look-back."""
    rows = ranges(df, range_s, step_s, chunk=chunk)
    inside = F.col("tail.prev_us") > F.col("t") - F.lit(range_s * 1_000_000)
    return _by_labels(rows.where(inside), irate_value(range_s))


def instant(df: DataFrame, step_s: int = 30, lookback_s: int = 300) -> DataFrame:
    """Last sample of each series at every evaluation time, no older than the look-back.

    Samples are first reduced to the last one of their pane, before any shuffle.
    """
    panes = _panes(df, lookback_s, step_s).groupBy(*SERIES, "pane").agg(
        F.max_by("value", F.struct("us", "value")).alias("value")
    )
    panes = panes.withColumn("t", F.explode(_grid(F.col("pane"), lookback_s, step_s)))
    return _by_labels(panes.groupBy(*SERIES, "t").agg(F.max_by("value", "pane").alias("value")), F.col("value"))


def agg_by(df: DataFrame, labels: list[str], how: str = "sum", time: str = "t") -> DataFrame:
    """Aggregate over series by some labels: ``(labels..., t, value)``; ``how`` is sum, avg, max, min or count."""
    fn = {"sum": F.sum, "avg": F.avg, "max": F.max, "min": F.min, "count": F.count}[how]
    keys = [F.col("labels")[c].alias(c) for c in labels]
    return df.groupBy(*keys, time).agg(fn("value").alias("value"))


def to_buckets(df: DataFrame, bounds: list[float], by: list[str], value: str = "value") -> DataFrame:
    """Cumulative histogram of observations: ``(by..., le, value)`` with ``le`` up to infinity.

    One counter per bound is kept while scanning; rows are not multiplied.
    """
    edges = [*bounds, float("inf")]
    counted = df.groupBy(*by).agg(
        *[F.count(F.when(F.col(value) <= F.lit(float(b)), 1)).alias(f"_b{i}") for i, b in enumerate(edges)]
    )
    rows = F.array(
        *[F.struct(F.lit(float(b)).alias("le"), F.col(f"_b{i}").cast("double").alias("value")) for i, b in enumerate(edges)]
    )
    return counted.select(*by, F.explode(rows).alias("b")).select(*by, "b.le", "b.value")


# Default duration buckets in seconds.
DEFAULT_BUCKETS = [0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0, 10.0]


def bucket_bound(label: Column) -> Column:
    """Bucket label ``le`` as a number; ``+Inf`` is infinity."""
    return F.when(label == "+Inf", F.lit(float("inf"))).otherwise(label.cast("double"))


def histogram_quantile(df: DataFrame, q: float | Column, by: list[str]) -> DataFrame:
    """Quantile from cumulative buckets ``(by..., le DOUBLE, value)`` with linear interpolation; ``q`` may be a column.

    The lowest bucket starts at 0; a quantile in the infinite bucket is the highest finite bound. Groups
    without observations give no row. A group is one row per bound, so the window stays small.
    """
    order = Window.partitionBy(*by).orderBy("le")
    whole = Window.partitionBy(*by)
    rows = (
        df.withColumn("_low", F.lag("le").over(order)).withColumn("_below", F.lag("value").over(order))
        .withColumn("_rank", (q if isinstance(q, Column) else F.lit(float(q))) * F.max("value").over(whole))
    )
    hit = rows.where("value >= _rank and value > 0")
    low, below = F.coalesce("_low", F.lit(0.0)), F.coalesce("_below", F.lit(0.0))
    inside = low + (F.col("le") - low) * F.try_divide(F.col("_rank") - below, F.col("value") - below)
    at = F.when(F.col("le") == float("inf"), F.col("_low")).otherwise(inside)
    return hit.select(*by, at.alias("value"), "le").groupBy(*by).agg(F.min_by("value", "le").alias("value")).where(
        "value is not null"
    )


def ratio(a: DataFrame, b: DataFrame, keys: list[str], *, missing_a: float | None = 0.0, missing_b: float | None = None):
    """``a / b`` by key; a side without a row counts as its default. Zero or missing divisors give null."""
    both = a.select(*keys, F.col("value").alias("_a")).join(b.select(*keys, F.col("value").alias("_b")), keys, "full_outer")
    x = F.col("_a") if missing_a is None else F.coalesce("_a", F.lit(float(missing_a)))
    y = F.col("_b") if missing_b is None else F.coalesce("_b", F.lit(float(missing_b)))
    return both.select(*keys, F.try_divide(x, y).alias("value"))


def hit_rate(hits: DataFrame, misses: DataFrame, keys: list[str]) -> DataFrame:
    """``hits / (hits + misses)`` by key with a missing side as 0."""
    both = hits.select(*keys, F.col("value").alias("_h")).join(
        misses.select(*keys, F.col("value").alias("_m")), keys, "full_outer"
    )
    h, m = F.coalesce("_h", F.lit(0.0)), F.coalesce("_m", F.lit(0.0))
    return both.select(*keys, F.try_divide(h, h + m).alias("value"))


def percent_used(available: DataFrame, total: DataFrame, keys: list[str]) -> DataFrame:
    """``(1 - available / total) * 100``."""
    return ratio(available, total, keys, missing_a=None).select(*keys, ((1 - F.col("value")) * 100).alias("value")).where(
        "value is not null"
    )


def percent_of(part: DataFrame, total: DataFrame, keys: list[str]) -> DataFrame:
    """``part / total * 100``: free disk, connections in use."""
    return ratio(part, total, keys, missing_a=None).select(*keys, (F.col("value") * 100).alias("value")).where(
        "value is not null"
    )


def cpu_used(idle_rate: DataFrame, by: list[str]) -> DataFrame:
    """``100 - avg(idle rate) * 100``."""
    return agg_by(idle_rate, by, "avg").withColumn("value", 100 - F.col("value") * 100)


def signed_rate(sent: DataFrame, received: DataFrame) -> DataFrame:
    """Rates of both directions in one table, the received one negated."""
    return sent.withColumn("direction", F.lit("sent")).unionByName(
        received.withColumn("value", -F.col("value")).withColumn("direction", F.lit("received"))
    )


def up_count(up: DataFrame, time: str = "t") -> DataFrame:
    """Number of targets that are up at each time."""
    return up.groupBy(time).agg(F.count(F.when(F.col("value") == 1, 1)).alias("up"))


def availability(up: DataFrame, by: list[str]) -> DataFrame:
    """Share of samples that were up, by labels."""
    return up.groupBy(*[F.col("labels")[c].alias(c) for c in by]).agg(
        F.avg("value").alias("availability"), F.count("*").alias("samples")
    )


def compare(col: Column, op: str, bound: float) -> Column:
    tests = {">": col > bound, "<": col < bound, ">=": col >= bound, "<=": col <= bound, "==": col == bound, "!=": col != bound}
    return tests[op]


def compare_by(col: Column, op: Column, bound: Column) -> Column:
    """:func:`compare` with the operator in a column."""
    tests = {">": col > bound, "<": col < bound, ">=": col >= bound, "<=": col <= bound, "==": col == bound, "!=": col != bound}
    return F.coalesce(*[F.when(op == name, test) for name, test in tests.items()])


def threshold(df: DataFrame, op: str, bound: float) -> DataFrame:
    """Rows of a series that satisfy the comparison."""
    return df.where(compare(F.col("value"), op, bound))


def reduce_panel(df: DataFrame, by: list[str], time: str = "ts") -> DataFrame:
    """Panel reducers: last non-null, last, mean and max value per group."""
    return df.groupBy(*by).agg(
        F.max_by("value", F.when(F.col("value").isNotNull(), F.col(time))).alias("last_not_null"),
        F.max_by("value", time).alias("last"), F.avg("value").alias("mean"), F.max("value").alias("max"),
    )


def error_share(rates: DataFrame, failed: Column, by: list[str]) -> DataFrame:
    """Percent of the rate that ``failed`` selects; no failures is 0, no traffic is 0 of 1."""
    keys = [*by, "t"]
    bad, every = agg_by(rates.where(failed), by), agg_by(rates, by)
    return ratio(bad, every, keys, missing_b=1.0).withColumn("value", F.col("value") * 100)
