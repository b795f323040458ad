"""Alert states, rule sets, grouping, throttling and inhibition."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.ordered import block_chunk, group_key, sized_chunks, with_previous, with_running
from ..functions.paging import paged_lists
from ..functions.skew import ROWS_PER_TASK, spread_join
from ..session import cut, literal_table
from . import metrics as me


def alert_states(
    df: DataFrame, for_seconds: int | Column, *, keys: list[str] | None = None, step_s: int | None = None, chunk: int = 86_400,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """States of conditions ``(series, ts, active)``: inactive, pending, firing after ``for_seconds``, and ``since``.

    With ``step_s``, the distance of evaluations, a series that was missing for longer starts a new run. The start
    of the current run is carried over chunks of ``chunk`` seconds or less, of at most ``rows_per_task`` rows, so a
    long or a dense series is many tasks.
    """
    keys = keys or ["series"]
    rows = sized_chunks(df, keys, "ts", chunk, rows=rows_per_task)
    rows = with_previous(rows, keys, ["ts"], ["active", "ts"], F.col("_slice"))
    unbroken = F.coalesce("prev_active", F.lit(False))
    if step_s is not None:
        unbroken &= F.unix_micros("ts") - F.unix_micros("prev_ts") <= F.lit(step_s * 1_000_000)
    begins = F.col("active") & ~unbroken
    rows = with_running(
        rows, keys, ["ts"], {"since": ("max", F.when(begins, F.col("ts")))}, F.col("_slice")
    )
    hold = (for_seconds if isinstance(for_seconds, Column) else F.lit(for_seconds)).cast("long")
    held = F.unix_micros("ts") - F.unix_micros("since") >= hold * F.lit(1_000_000)
    return (
        rows.withColumn("state", F.when(~F.col("active"), "inactive").when(held, "firing").otherwise("pending"))
        .withColumn("since", F.when(F.col("active"), F.col("since")))
        .drop("prev_active", "prev_ts", "_slice")
    )


class AlertRule(NamedTuple):
    """A row of a rule table: what is computed from the samples, a comparison, and what it means.

    ``kind`` is one of :data:`KINDS`; ``other`` is the second metric of the kinds that take two, ``label match
    label_value`` an optional condition on labels of the first, ``q`` the quantile.
    """

    alert: str
    kind: str
    metric: str
    other: str | None
    label: str | None
    match: str | None
    label_value: str | None
    q: float | None
    op: str
    bound: float
    for_seconds: int
    severity: str
    component: str


#: Most rows of a rule table; rules are broadcast.
MOST_RULES = 10_000

RULE_COLUMNS = (
    "alert string, kind string, metric string, other string, label string, match string, label_value string, q double, "
    "op string, bound double, for_seconds int, severity string, component string"
)


#: Kinds of expressions a rule may use, and what their samples are read as.
KINDS = {
    "rate": "rate", "gauge": "gauge", "quantile": "rate", "ratio": "gauge", "percent": "gauge", "percent_used": "gauge",
    "rate_share": "rate", "total_ratio": "gauge", "busy_percent": "irate",
}
PAIRS = ("ratio", "percent", "percent_used", "rate_share", "total_ratio")


def _operands(rules: list[AlertRule]) -> list[tuple]:
    """``(rule, side, source, name, label, match, label_value)``: one row per metric a rule reads."""
    rows = []
    for i, r in enumerate(rules):
        rows.append((i, "a", KINDS[r.kind], r.metric, r.label, r.match, r.label_value))
        if r.kind in PAIRS:
            rows.append((i, "b", KINDS[r.kind], r.other, None, None, None))
    return rows


def _values(samples: DataFrame, operands: DataFrame, range_s: int, step_s: int, chunk: int) -> DataFrame:
    """``(rule, side, labels, t, value)`` of every operand, from one pass over the samples the rules name."""
    wanted = samples.join(F.broadcast(operands.select("name").distinct()), "name", "left_semi")
    seen = me.ranges(wanted, range_s, step_s, chunk=chunk)

    def read_as(source: str, value: Column) -> Column:
        return F.struct(F.lit(source).alias("source"), value.alias("value"))

    # A rate that cannot be computed is no row, while a last value may be null.
    three = F.array(
        F.when(me.rate_value().isNotNull(), read_as("rate", me.rate_value())),
        F.when(me.irate_value(range_s).isNotNull(), read_as("irate", me.irate_value(range_s))),
        read_as("gauge", F.col("last")),
    )
    read = seen.select("name", "series", "t", F.explode(F.array_compact(three)).alias("r")).select(
        "name", me.series_labels(F.col("series")), "t", "r.source", "r.value"
    )
    found = F.coalesce(F.try_element_at("labels", F.col("label")), F.lit(""))
    whole = F.concat(F.lit("^(?:"), F.col("label_value"), F.lit(")$"))
    matches = (
        F.when(F.col("label").isNull(), True)
        .when(F.col("match") == "=", found == F.col("label_value")).when(F.col("match") == "!=", found != F.col("label_value"))
        .when(F.col("match") == "=~", F.regexp_like(found, whole)).when(F.col("match") == "!~", ~F.regexp_like(found, whole))
    )
    return read.join(F.broadcast(operands), ["source", "name"]).where(matches).select("rule", "side", "labels", "t", "value")


def evaluate_rules(
    samples: DataFrame, rules: DataFrame | list[AlertRule], *, range_s: int = 300, step_s: int = 30, chunk: int = 86_400
) -> DataFrame:
    """States of all rules: ``(alert, severity, component, series, ts, value, state, since)``.

    ``rules`` is a table with the columns of :data:`RULE_COLUMNS`, one row per rule. The samples are read once
    whatever the number of rules: rates and last values of all named metrics come from one aggregation, are joined with
    the rules as rows and kept as a table, and one more aggregation makes the expressions of all rules. Rules are
    broadcast; a table of more than :data:`MOST_RULES` is refused.
    """
    if isinstance(rules, DataFrame):
        rules = [AlertRule(*r) for r in rules.select(*AlertRule._fields).take(MOST_RULES + 1)]
    if len(rules) > MOST_RULES:
        raise ValueError(f"more than {MOST_RULES} rules")
    spark = samples.sparkSession
    operands = literal_table(
        spark, _operands(rules),
        "rule int, side string, source string, name string, label string, match string, label_value string",
    )
    table = literal_table(spark, [(i, *r) for i, r in enumerate(rules)], f"rule int, {RULE_COLUMNS}")
    values = cut(_values(samples, operands, range_s, step_s, chunk))
    kind = F.col("kind")
    joined = values.join(F.broadcast(table.select("rule", "kind", "q")), "rule")

    # All kinds but quantiles: sums of both operands over the labels that stay.
    instance = F.create_map(F.lit("instance"), F.coalesce(F.try_element_at("labels", F.lit("instance")), F.lit("")))
    none = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    stays = F.when(kind == "total_ratio", none).when(kind == "busy_percent", instance).otherwise(F.col("labels"))
    first, second = F.col("side") == "a", F.col("side") == "b"
    sides = (
        joined.where(kind != "quantile").groupBy("rule", "kind", me.series_key(stays).alias("series"), "t")
        .agg(
            F.sum(F.when(first, F.col("value"))).alias("a"), F.avg(F.when(first, F.col("value"))).alias("mean"),
            F.sum(F.when(second, F.col("value"))).alias("b"),
        )
    )
    a, b = F.col("a"), F.col("b")
    share = F.try_divide(a, b)
    plain = sides.withColumn(
        "value",
        F.when(kind.isin("ratio", "total_ratio"), share).when(kind == "percent", share * 100)
        .when(kind == "percent_used", (1 - share) * 100).when(kind == "rate_share", F.try_divide(a, a + b))
        .when(kind == "busy_percent", 100 - F.col("mean") * 100).otherwise(a),
    ).where(~kind.isin(*PAIRS) | F.col("value").isNotNull()).select("rule", "series", "t", "value")

    rest = F.map_filter("labels", lambda k, _: k != "le")
    buckets = joined.where(kind == "quantile").select(
        "rule", "q", me.series_key(rest).alias("series"), "t",
        me.bucket_bound(F.try_element_at("labels", F.lit("le"))).alias("le"), "value",
    )
    quantiles = me.histogram_quantile(buckets, F.col("q"), ["rule", "series", "t"]).select("rule", "series", "t", "value")

    every = plain.unionByName(quantiles).join(F.broadcast(table), "rule").select(
        "alert", "severity", "component", "for_seconds", "series", F.timestamp_micros("t").alias("ts"), "value",
        me.compare_by(F.col("value"), F.col("op"), F.col("bound")).alias("active"),
    )
    states = alert_states(every, F.col("for_seconds"), keys=["alert", "series"], step_s=step_s, chunk=chunk)
    return states.select("alert", "severity", "component", "series", "ts", "value", "state", "since")


GROUP_BY = ["alertname", "cluster", "service"]  # fixed values: labels alerts are grouped and inhibited by


def _labels(df: DataFrame, names: list[str]) -> DataFrame:
    """An absent label is an empty text."""
    for n in names:
        df = df.withColumn(n, F.coalesce(F.col(n), F.lit("")) if n in df.columns else F.lit(""))
    return df


def group_alerts(alerts: DataFrame, by: list[str] | None = None, *, page: int = 10_000) -> DataFrame:
    """Alerts ``(by..., ts, series)`` of one group and time as one notification, long ones in pages.

    Absent labels group as empty ones.
    """
    keys = [*(by or GROUP_BY), "ts"]
    alerts = _labels(alerts, keys[:-1])
    sizes = alerts.select(*keys, "series").distinct().groupBy(*keys).agg(F.count("*").alias("alerts"))
    return paged_lists(alerts, keys, "series", "members", page).join(sizes, keys)


def inhibit(alerts: DataFrame, equal: list[str] | None = None, *, within_s: int = 0) -> DataFrame:
    """Drop warnings for which a critical alert with equal labels is firing; absent labels equal absent ones.

    A critical alert counts at its own time and, with ``within_s``, for so many seconds after it.
    """
    names = equal or GROUP_BY
    marked = alerts
    keys = [f"_k{i}" for i in range(len(names))]
    for k, n in zip(keys, names):
        marked = marked.withColumn(k, F.coalesce(F.col(n), F.lit("")) if n in alerts.columns else F.lit(""))
    critical = marked.where("severity = 'critical'").select(*keys, F.col("ts").alias("_from")).distinct()
    rest = alerts.where("severity is null or severity <> 'warning'")
    warnings = marked.where("severity = 'warning'")
    if not within_s:
        kept = warnings.join(critical.withColumnRenamed("_from", "ts"), [*keys, "ts"], "left_anti")
    else:
        # Both sides meet in time buckets of the span, so a label with a long history is not compared as a whole.
        bucket = lambda c: F.floor(F.unix_micros(c) / F.lit(within_s * 1_000_000))
        spans = critical.withColumn("_b", F.explode(F.array(bucket(F.col("_from")), bucket(F.col("_from")) + 1)))
        w, c = warnings.withColumn("_b", bucket(F.col("ts"))).alias("w"), spans.alias("c")
        on = [F.col(f"w.{k}") == F.col(f"c.{k}") for k in [*keys, "_b"]]
        span = F.unix_micros("w.ts") - F.unix_micros("c._from")
        kept = w.join(c, reduce(lambda x, y: x & y, on) & span.between(0, within_s * 1_000_000), "left_anti")
    return rest.unionByName(kept.select(*rest.columns))


def throttle(
    groups: DataFrame, keys: list[str], *, repeat_s: int = 43_200, interval_s: int = 10, group_wait_s: int = 0,
    chunk: int | None = None,
) -> DataFrame:
    """Notifications of groups ``(keys, ts, content)``: the first one, every change, and one per ``repeat_s``.

    Groups are looked at every ``interval_s``; the last content of an interval counts, at equal times the larger one.
    With ``group_wait_s`` a new group is first told so long after it was first seen, with the content it has by
    then; what changed in between is not told apart. Null keys are a group, null content is a content, rows without
    a time are left out.

    The time of the next repeat is carried through a group as a function. A task gets ``chunk`` seconds of one group
    (64 repeat times by default), at most ``chunk / interval_s`` rows, and makes of them the function from the
    repeat time before the chunk to the one after it: at most ``repeat_s / interval_s`` pieces, or a constant if the
    content changes in the chunk. Functions of chunks without a change are composed with those before them in
    rounds of doubling distance until all are constants. Then every chunk is walked once on its own.
    """
    step = interval_s * 1_000_000
    wait, hold = -(-repeat_s // interval_s), -(-group_wait_s // interval_s)
    size = max(1, (64 * repeat_s if chunk is None else chunk) // interval_s)
    kinds = {f.name: f.dataType.simpleString() for f in groups.schema}
    rows = groups.where("ts is not null").select(
        group_key(keys).alias("_g"), "ts", "content",
        (block_chunk(F.unix_micros("ts"), step) / F.lit(step)).cast("long").alias("tick"),
    )
    ticks = rows.groupBy("_g", "tick").agg(F.max(F.struct("ts", "content")).alias("_last"))
    if hold:
        begins = ticks.groupBy("_g").agg((F.min("tick") + hold).alias("_from"))
        ticks = spread_join(ticks, begins, ["_g"]).withColumn("tick", F.greatest("tick", "_from"))
        ticks = ticks.groupBy("_g", "tick").agg(F.max("_last").alias("_last"))
    block = block_chunk(F.col("tick"), size)
    ticks = ticks.select("_g", "tick", F.col("_last.content").alias("content"))
    ticks = with_previous(ticks, ["_g"], ["tick"], ["tick", "content"], block)
    first = F.col("prev_tick").isNull()
    # A group goes to Python as one text, whatever its keys are.
    text = F.to_json(F.struct("_g"), {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"})
    ticks = cut(ticks.select(
        "_g", text.alias("id"), block.alias("chunk"), "tick", "content", first.alias("first"),
        (first | ~F.col("content").eqNullSafe(F.col("prev_content"))).alias("changed"),
    ))

    def jumps(tick: np.ndarray) -> np.ndarray:
        return np.searchsorted(tick, tick + wait)

    def function(tick: np.ndarray, changed: np.ndarray, start: int) -> tuple[list[int], list[int], bool]:
        """Pieces: a repeat time up to ``upto[i]`` (and above the piece before) becomes ``due[i]``."""
        at, count = jumps(tick), len(tick)
        if changed.any():
            entries = np.array([np.flatnonzero(changed)[-1]])
        else:
            # A repeat time comes from before the chunk, so it is at most ``wait`` after its start.
            entries = np.arange(min(count, int(np.searchsorted(tick, start + wait)) + 1))
        here = entries.copy()
        while (ahead := at[here] < count).any():
            here[ahead] = at[here[ahead]]
        return tick[entries].tolist(), (tick[here] + wait).tolist(), bool(changed.any())

    def summarise(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            parts = [
                function(np.asarray(t, dtype="int64"), np.asarray(c, dtype=bool), s)
                for t, c, s in zip(pdf["ticks"], pdf["marks"], pdf["chunk"])
            ]
            out = pdf[["id", "place"]].copy()
            out["upto"], out["due"], out["fixed"] = ([p[i] for p in parts] for i in range(3))
            yield out

    def compose(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            parts = []
            for upto, due, fixed, upto0, due0, fixed0 in zip(
                pdf["upto"], pdf["due"], pdf["fixed"], pdf["upto0"], pdf["due0"], pdf["fixed0"]
            ):
                if fixed or upto0 is None:
                    parts.append((upto, due, bool(fixed)))
                    continue
                upto, due, upto0, due0 = (np.asarray(x, dtype="int64") for x in (upto, due, upto0, due0))
                through = np.searchsorted(upto, due0)
                after = np.where(through < len(upto), due[np.minimum(through, len(upto) - 1)], due0)
                if not fixed0:
                    # Repeat times after the last row of the chunks before pass them unchanged.
                    more = upto > upto0[-1]
                    upto0, after = np.concatenate([upto0, upto[more]]), np.concatenate([after, due[more]])
                parts.append((upto0.tolist(), after.tolist(), bool(fixed0)))
            out = pdf[["id", "place"]].copy()
            out["upto"], out["due"], out["fixed"] = ([p[i] for p in parts] for i in range(3))
            yield out

    def walk(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            ids, told = [], []
            for key, t, c, due in zip(pdf["id"], pdf["ticks"], pdf["marks"], pdf["due"]):
                tick, marks = np.asarray(t, dtype="int64"), np.flatnonzero(c).tolist()
                at, count = jumps(tick).tolist(), len(tick)
                starts, ends = marks, [*marks[1:], count]
                if not c[0]:
                    starts, ends = [int(np.searchsorted(tick, int(due))), *marks], [*marks, count]
                for i, end in zip(starts, ends):
                    while i < end:
                        ids.append(key)
                        told.append(int(tick[i]))
                        i = at[i]
            yield pd.DataFrame({"id": pd.Series(ids, dtype="object"), "tick": pd.Series(told, dtype="int64")})

    # One row per chunk with arrays of bounded length; the order of the chunks of a group is found without them.
    order = Window.partitionBy("id").orderBy("chunk")
    places = ticks.select("id", "chunk").distinct().withColumn("place", F.row_number().over(order))
    chunks = ticks.groupBy("id", "chunk").agg(F.array_sort(F.collect_list(F.struct("tick", "changed"))).alias("_rows"))
    chunks = cut(
        chunks.join(places, ["id", "chunk"])
        .select("id", "place", "chunk", F.col("_rows.tick").alias("ticks"), F.col("_rows.changed").alias("marks"))
    )
    shape = "id string, place int, upto array<bigint>, due array<bigint>, fixed boolean"
    summary = cut(chunks.mapInPandas(summarise, shape))
    distance = 1
    while not summary.where("not fixed").isEmpty():
        before = summary.select(
            "id", (F.col("place") + distance).alias("place"), F.col("upto").alias("upto0"), F.col("due").alias("due0"),
            F.col("fixed").alias("fixed0"),
        )
        summary = cut(summary.join(before, ["id", "place"], "left").mapInPandas(compose, shape))
        distance *= 2
    entry = summary.select("id", (F.col("place") + 1).alias("place"), F.col("due")[0].alias("due"))
    ready = chunks.join(entry, ["id", "place"], "left").select("id", "ticks", "marks", "due")
    sent = ready.mapInPandas(walk, "id string, tick bigint")
    return ticks.join(sent, ["id", "tick"]).select(
        *[F.col("_g")[f"k{i}"].cast(kinds[k]).alias(k) for i, k in enumerate(keys)],
        F.timestamp_micros(F.col("tick") * step).alias("sent_at"), "content",
        F.when(F.col("first"), "first").when(F.col("changed"), "changed").otherwise("repeat").alias("reason"),
    )
