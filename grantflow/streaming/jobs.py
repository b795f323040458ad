"""Streams: event source, tuple maintenance, two-stage flow, de-duplication, counts, alert states."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from ..model import TUPLE_COLS
from ..operators.relate import dispatch, latest_state, workspace_tuples
from ..sources.cdc import decode_flat_cdc
from ..sources.sinks import write_batch

EVENT = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("headers", T.MapType(T.StringType(), T.StringType())),
    ]
)


def read_event_stream(spark: SparkSession, source: str, *, fmt: str = "parquet", files_per_batch: int = 1000, **options):
    """Messages with topic, partition, offset, timestamp, key, value, headers.

    ``fmt`` is a file format, or ``kafka`` where that connector is on the class path (``source`` is then the
    bootstrap servers and ``subscribe`` an option); both give the same columns.
    """
    if fmt == "kafka":
        raw = (
            spark.readStream.format("kafka").option("kafka.bootstrap.servers", source)
            .option("includeHeaders", "true").options(**options).load()
        )
        pairs = F.transform("headers", lambda h: F.struct(h["key"], h["value"].cast("string")))
        return raw.select(
            "topic", "partition", "offset", "timestamp", F.col("key").cast("string"), F.col("value").cast("string"),
            F.map_from_entries(pairs).alias("headers"),
        )
    return spark.readStream.schema(EVENT).format(fmt).option("maxFilesPerTrigger", files_per_batch).load(source)


class ChangeTable:
    """Parquet folders ``batch=<id>`` of keyed changes, newest order value wins on reading.

    A micro-batch only writes its own folder, so its cost does not grow with the table. A replayed batch
    overwrites the folder it wrote before, so every batch counts once. ``compact`` folds old folders into one
    ``base=<id>`` that later reads start from.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys: list[str], order: str):
        self.spark, self.path, self.schema, self.keys, self.order = spark, path, schema, keys, order

    def _folders(self, prefix: str) -> dict[int, str]:
        jvm = self.spark.sparkContext._jvm
        root = jvm.org.apache.hadoop.fs.Path(self.path)
        fs = root.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(root):
            return {}
        done = {}
        for s in fs.listStatus(root):
            name = s.getPath().getName()
            if name.startswith(prefix) and fs.exists(jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS")):
                done[int(name[len(prefix):])] = f"{self.path}/{name}"
        return done

    def put(self, changes: DataFrame, batch_id: int) -> None:
        """Write the newest change per key of one micro-batch."""
        folded = latest_state(changes.select(*self.schema.names), self.keys, order=self.order, drop_deleted=False)
        folded.select(*self.schema.names).write.mode("overwrite").parquet(f"{self.path}/batch={batch_id}")

    def read(self) -> DataFrame:
        """Newest change per key, deletes included."""
        bases = self._folders("base=")
        start = max(bases, default=-1)
        paths = [bases[start]] if bases else []
        paths += [p for b, p in sorted(self._folders("batch=").items()) if b > start]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        rows = self.spark.read.schema(self.schema).parquet(*paths)
        return latest_state(rows, self.keys, order=self.order, drop_deleted=False).select(*self.schema.names)

    def compact(self) -> None:
        """Fold everything written so far into a new base."""
        newest = max(self._folders("batch="), default=None)
        if newest is not None and newest > max(self._folders("base="), default=-1):
            self.read().write.mode("overwrite").parquet(f"{self.path}/base={newest}")


STATE = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("id", "tenant_id", "op")] + [T.StructField("lsn", T.LongType())]
)


def workspace_table(spark: SparkSession, path: str) -> ChangeTable:
    """Newest image per workspace with its last LSN."""
    return ChangeTable(spark, path, STATE, ["id"], "lsn")


def update_table(spark: SparkSession, path: str) -> ChangeTable:
    """Last operation per tuple."""
    fields = [T.StructField(c, T.StringType()) for c in [*TUPLE_COLS, "op"]]
    return ChangeTable(spark, path, T.StructType([*fields, T.StructField("seq", T.LongType())]), TUPLE_COLS, "seq")


def _run(stream: DataFrame, apply, checkpoint: str):
    return (
        stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def workspace_stream(
    events: DataFrame, table: ChangeTable, checkpoint: str, *, on_bad: Callable[[DataFrame, int], None] | None = None,
    outputs: str | None = None,
):
    """Start the flow: flattened change messages to the newest image per workspace.

    Duplicates and late messages cannot bring back an older parent, and an update replaces the previous parent.
    ``current_tuples`` turns the table into tuples. Malformed messages go to ``on_bad``, and with a folder
    ``outputs`` to the table ``dead`` in it, while ``counts`` has the good and bad messages of every batch. A
    micro-batch is read once for all of them. A failing batch stops the query and is retried from the checkpoint;
    every output replaces what it wrote for that batch, so nothing is skipped and nothing counts twice.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        batch = batch.select("key", "value").persist()
        try:
            good, bad = decode_flat_cdc(batch)
            if on_bad is not None:
                on_bad(bad, batch_id)
            if outputs is not None:
                keep_dead(batch, bad, outputs, batch_id)
            routed = dispatch(good).where("route like 'workspace_%' and coalesce(id, '') <> ''")
            table.put(routed.select(*STATE.names), batch_id)
        finally:
            batch.unpersist()

    return _run(events, apply, checkpoint)


def keep_dead(batch: DataFrame, bad: DataFrame, outputs: str, batch_id: int) -> None:
    """Write the dead letters of a micro-batch and how many messages it had; both are counted while they are written."""
    seen = Observation(f"dead-{batch_id}")
    write_batch(bad.observe(seen, F.count(F.lit(1)).alias("bad")), f"{outputs}/dead", batch_id)
    counts = batch.agg(F.count(F.lit(1)).alias("messages")).select(
        F.lit(batch_id).cast("long").alias("batch_id"), (F.col("messages") - F.lit(seen.get["bad"])).alias("good"), F.lit(seen.get["bad"]).cast("long").alias("bad"))
    write_batch(counts, f"{outputs}/counts", batch_id)


def current_tuples(table: ChangeTable) -> DataFrame:
    """Tuples of the live workspaces in the table."""
    return workspace_tuples(table.read().where("op <> 'd'")).drop("sign")


def tuple_stream(updates: DataFrame, table: ChangeTable, checkpoint: str):
    """Apply ``(tuple columns, op, seq)`` updates from a stream; the last operation per tuple wins."""
    return _run(updates, lambda batch, batch_id: table.put(batch, batch_id), checkpoint)


def live_tuples(table: ChangeTable) -> DataFrame:
    """Tuples whose last operation is no delete."""
    return table.read().where("op <> 'DELETE'").select(*TUPLE_COLS)


def two_stage(
    resources: DataFrame, resource_path: str, table: ChangeTable, checkpoint: str,
    to_updates: Callable[[DataFrame], DataFrame],
) -> None:
    """Resource outbox to the resource table and a second outbox, then that outbox to tuples.

    Both stages are micro-batch queries with their own checkpoint; the second reads what the first appended.
    """
    outbox = f"{resource_path}/outbox"

    def first(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            write_batch(batch, f"{resource_path}/rows", batch_id)
            write_batch(to_updates(batch), outbox, batch_id)
        finally:
            batch.unpersist()

    _run(resources, first, f"{checkpoint}/one").awaitTermination()
    second = resources.sparkSession.readStream.schema(table.schema).parquet(f"{outbox}/batch=*")
    tuple_stream(second, table, f"{checkpoint}/two").awaitTermination()


def dedupe_stream(events: DataFrame, keys: list[str], *, time: str = "timestamp", delay: str = "10 minutes") -> DataFrame:
    """Drop repeats of ``keys`` arriving within the watermark; state older than that is forgotten."""
    return events.withWatermark(time, delay).dropDuplicatesWithinWatermark(keys)


def count_stream(
    events: DataFrame, path: str, by: list[str], checkpoint: str, *, time: str = "timestamp", window: str = "5 minutes"
):
    """Start counting events per window and key into folders ``batch=<id>`` under ``path``.

    A micro-batch writes its own partial counts and a replay overwrites them, so late and out-of-order events count
    like others and windows that are still open show. ``window_counts`` sums the parts.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        counts = batch.groupBy(F.window(time, window).alias("w"), *by).agg(F.count("*").alias("events"))
        counts.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *by, "events").write.mode(
            "overwrite").parquet(f"{path}/batch={batch_id}")

    return _run(events, apply, checkpoint)


def window_counts(spark: SparkSession, path: str, by: list[str]) -> DataFrame:
    """Counts per window and key over all micro-batches so far."""
    parts = spark.read.parquet(f"{path}/batch=*")
    return parts.groupBy("start", "end", *by).agg(F.sum("events").alias("events"))


CONDITION = T.StructType(
    [T.StructField("series", T.StringType()), T.StructField("ts", T.TimestampType()), T.StructField("active", T.BooleanType())]
)


def condition_table(spark: SparkSession, path: str) -> ChangeTable:
    """Conditions by series and time; a repeated one counts once, and of two values at one time the active one."""
    return ChangeTable(spark, path, CONDITION, ["series", "ts"], "active")


def condition_stream(conditions: DataFrame, table: ChangeTable, checkpoint: str):
    """Start keeping ``(series, ts, active)`` rows in any order of arrival. ``alert_states`` over the table gives the
    states; what is older than the longest holding time may be dropped from it."""
    return _run(conditions, lambda batch, batch_id: table.put(batch, batch_id), checkpoint)


STATES = T.StructType(
    [*CONDITION.fields, T.StructField("since", T.TimestampType()), T.StructField("state", T.StringType())]
)


def _pack(pdf: pd.DataFrame) -> bytes:
    """A frame as one value of a state, so that reading and writing state does not cost a call per row."""
    sink = pa.BufferOutputStream()
    table = pa.Table.from_pandas(pdf, preserve_index=False)
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def _unpack(packed: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(packed).read_all().to_pandas()


class AlertTimers(StatefulProcessor):
    """States of the series of one bucket from conditions in any order within the watermark.

    Conditions wait until the watermark has passed them, which a timer at the earliest one tells. They are then put in
    order and settled against the last settled one of their series (``series, us, active, since``). With a step, that
    is forgotten once the watermark is so far behind it that the next condition would start a new run anyway. Calls of
    the state are made per bucket, not per series or condition.
    """

    def __init__(self, for_us: int, step_us: int | None):
        self.for_us, self.step_us = for_us, step_us

    def init(self, handle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "conditions binary")
        self.last = handle.getValueState("last", "conditions binary")

    def _wake(self, us: int) -> None:
        self.handle.registerTimer(-(-us // 1000))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        parts = [pdf.loc[pdf["active"].notna() & pdf["us"].notna(), ["name", "us", "active"]] for pdf in rows]
        parts = [pdf.set_axis(["series", "us", "active"], axis=1).astype({"us": "int64", "active": "bool"}) for pdf in parts if len(pdf)]
        if parts:
            self.waiting.appendList([(_pack(pdf),) for pdf in parts])
            self._wake(min(int(pdf["us"].min()) for pdf in parts))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        none = pd.DataFrame({"series": pd.Series(dtype=object), "us": pd.Series(dtype="int64"), "active": pd.Series(dtype=bool)})
        waiting = pd.concat([none, *[_unpack(r[0]) for r in (self.waiting.get() if self.waiting.exists() else ())]])
        last = _unpack(self.last.get()[0]) if self.last.exists() else none.assign(since=none["us"])
        ready, rest = waiting[waiting["us"] <= passed], waiting[waiting["us"] > passed]
        if len(ready):
            ready = ready.groupby(["series", "us"], dropna=False, as_index=False)["active"].any()
            settled = self._settle(pd.concat([last.assign(new=False), ready.assign(since=ready["us"], new=True)], ignore_index=True))
            last = settled.drop_duplicates("series", keep="last")
            if len(rest):
                self.waiting.put([(_pack(rest),)])
            else:
                self.waiting.clear()
        if len(rest):
            self._wake(int(rest["us"].min()))
        if self.step_us is not None and len(last):
            ended = ~last["series"].isin(rest["series"])
            kept = last[~(ended & (last["us"] + self.step_us < passed))]
            if ended[kept.index].any():
                self._wake(int(kept.loc[ended[kept.index], "us"].min()) + self.step_us + 1000)
        else:
            kept = last
        if len(kept):
            self.last.update((_pack(kept[["series", "us", "active", "since"]]),))
        elif self.last.exists():
            self.last.clear()
        if len(ready):
            yield self._states(settled[settled["new"]])

    def _settle(self, rows: pd.DataFrame) -> pd.DataFrame:
        """Conditions in order with the start of their run as ``since``; older ones, at most one a series, have it."""
        rows = rows.sort_values(["series", "us"], kind="stable", ignore_index=True)
        series = pd.factorize(rows["series"], use_na_sentinel=False)[0]
        us, active, new = rows["us"].to_numpy("int64"), rows["active"].to_numpy(bool), rows["new"].to_numpy(bool)
        unbroken = np.zeros(len(rows), bool)
        unbroken[1:] = (series[1:] == series[:-1]) & active[1:] & active[:-1] & new[1:]
        if self.step_us is not None:
            unbroken[1:] &= us[1:] - us[:-1] <= self.step_us
        first = np.maximum.accumulate(np.where(unbroken, 0, np.arange(len(rows))))
        return rows.assign(since=rows["since"].to_numpy("int64")[first])

    def _states(self, rows: pd.DataFrame) -> pd.DataFrame:
        state = np.where(rows["us"] - rows["since"] >= self.for_us, "firing", "pending")
        return pd.DataFrame({
            "series": rows["series"], "ts": pd.to_datetime(rows["us"], unit="us"), "active": rows["active"],
            "since": pd.to_datetime(rows["since"].where(rows["active"]).astype("Int64"), unit="us"),
            "state": np.where(rows["active"], state, "inactive"),
        })


def alert_stream(
    conditions: DataFrame, path: str, checkpoint: str, for_seconds: int, *, step_s: int | None = None, delay: str = "10 minutes",
    buckets: int = 512,
):
    """Start writing the states of a stream of ``(series, ts, active)`` to folders ``batch=<id>`` under ``path``.

    A state is final: it is written when the watermark, ``delay`` behind the newest time, has passed it. Conditions
    later than that, and all up to the start of 1970, where Spark's watermark starts, are dropped by the watermark;
    ``condition_stream`` keeps any order at the cost of a growing table.
    Of two values at one time the active one counts. Rows without a value only move the watermark. State is what the
    watermark has not passed and, per series, one row until ``step_s`` after its last condition. It is kept in
    ``buckets`` of series; a task works on one bucket at a time, and a checkpoint belongs to their number. Needs the RocksDB
    state store (``spark.sql.streaming.stateStore.providerClass``), which is set for the session.
    """
    conditions.sparkSession.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    )
    # The key of the state is the number of a bucket of series, as text.
    bucket = F.pmod(F.xxhash64("series"), F.lit(buckets)).cast("string").alias("series")
    rows = conditions.withWatermark("ts", delay).select(bucket, F.col("series").alias("name"), "ts", "active", F.unix_micros("ts").alias("us"))
    states = rows.groupBy("series").transformWithStateInPandas(
        AlertTimers(for_seconds * 1_000_000, None if step_s is None else step_s * 1_000_000), STATES, "Append", "EventTime"
    )
    return _run(states, lambda batch, batch_id: write_batch(batch, path, batch_id), checkpoint)
