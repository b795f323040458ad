"""Time-series operators and alerts over metrics derived from the event table."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import alerts as al
from ..operators import metrics as me
from ..session import cut, cut_table, shared_folder
from ..sources import metrics as src
from ..streaming.jobs import STATES, alert_stream, condition_stream, condition_table
from .alert_rules import CONSUMER_RULES, SERVICE_RULES
from .catalog import query
from .derived import COUNTER_SQL, RESET_SQL, counter_samples, events, gauge_samples, reset_samples
from .queries_sources import HEALTH_SQL, health_observations, tag

HOUR = 3600
RANGE, STEP = 6 * HOUR, HOUR
BOUNDS = [1.0, 5.0, 10.0, 25.0, 50.0, 100.0, 250.0]


def rate_sql(counter: str, labels: str, name: str = "rates") -> str:
    """Rates of a table with series columns ``labels``, ``ts`` and ``value`` at hourly times over six hours."""
    return f"""
{name}_d AS (
  SELECT {labels}, epoch_us(ts) AS us, value, lag(epoch_us(ts)) OVER w AS pus, lag(value) OVER w AS pv
  FROM {counter} WINDOW w AS (PARTITION BY {labels} ORDER BY ts)
),
{name}_i AS (SELECT *, CASE WHEN value < pv THEN value ELSE value - pv END AS grown FROM {name}_d),
{name}_g AS (SELECT unnest(range((SELECT min(us) // 3600000000 * 3600000000 FROM {name}_d),
                          (SELECT max(us) FROM {name}_d) + 6 * 3600000000, 3600000000)) AS t),
{name} AS (
  SELECT {labels}, t, sum(CASE WHEN pus > t - 6 * 3600000000 THEN grown END) / ((max(us) - min(us)) / 1e6) AS value
  FROM {name}_i JOIN {name}_g ON us > t - 6 * 3600000000 AND us <= t GROUP BY {labels}, t
  HAVING count(*) >= 2 AND max(us) > min(us)
)"""


def label(name):
    return F.col("labels")[name].alias(name)


def at_us(col="t"):
    return F.unix_micros(col).alias("t")


def rounded(digits=6):
    return F.round("value", digits).alias("value")


def method_rates(spark, sf):
    return me.rate(counter_samples(spark, sf), RANGE, STEP)


@query(
    "t01_counter_rate",
    f"WITH {RESET_SQL}, {rate_sql('counter', 'series')} SELECT series, t, round(value, 6) AS value FROM rates",
)
def t01(spark, sf):
    r = me.rate(reset_samples(spark, sf), RANGE, STEP)
    return r.select(F.col("labels")["user"].alias("series"), at_us(), rounded())


@query(
    "t02_instant_rate",
    f"""WITH {RESET_SQL}, {rate_sql('counter', 'series')},
    l AS (SELECT series, t, arg_max(pus, us) AS pus, max(us) AS us, arg_max(grown, us) AS grown FROM rates_i
      JOIN rates_g ON us > t - 6 * 3600000000 AND us <= t WHERE pus IS NOT NULL GROUP BY series, t)
    SELECT series, t, round(grown / ((us - pus) / 1e6), 6) AS value FROM l WHERE pus > t - 6 * 3600000000""",
)
def t02(spark, sf):
    r = me.irate(reset_samples(spark, sf), RANGE, STEP)
    return r.select(F.col("labels")["user"].alias("series"), at_us(), rounded())


@query(
    "t03_aggregate_by_labels",
    f"""WITH {COUNTER_SQL}, {rate_sql('counter', 'method, code')}
    SELECT code, t, round(sum(value), 6) AS value, 'sum' AS how FROM rates GROUP BY code, t
    UNION ALL SELECT code, t, round(avg(value), 6), 'avg' FROM rates GROUP BY code, t""",
)
def t03(spark, sf):
    r = cut(method_rates(spark, sf))
    parts = [me.agg_by(r, ["code"], how).select("code", at_us(), rounded(), F.lit(how).alias("how")) for how in ("sum", "avg")]
    return parts[0].unionByName(parts[1])


def bucket_sql(by: str, source: str = "events") -> str:
    edges = ", ".join(f"({b})" for b in BOUNDS) + ", ('inf'::DOUBLE)"
    return f"""
edge(le) AS (VALUES {edges}),
bucket AS (SELECT {by}, CAST(le AS DOUBLE) AS le, CAST(count(CASE WHEN value <= le THEN 1 END) AS DOUBLE) AS value
           FROM (SELECT *, epoch_us(ts) // 86400000000 AS day FROM {source}), edge GROUP BY {by}, le)"""


@query(
    "t04_bucket_quantile",
    f"""WITH {bucket_sql('event_type, day')}, x AS (SELECT *, lag(le) OVER w AS low, coalesce(lag(value) OVER w, 0) AS below,
      max(value) OVER (PARTITION BY event_type, day) AS total FROM bucket WINDOW w AS (PARTITION BY event_type, day ORDER BY le)),
    q(q) AS (VALUES (0.5), (0.95), (0.99))
    SELECT event_type, day, CAST(q AS DOUBLE) AS q, round(CASE WHEN isinf(le) THEN low ELSE
      coalesce(low, 0) + (le - coalesce(low, 0)) * (q * total - below) / (value - below) END, 6) AS value
    FROM x, q WHERE total > 0 AND value >= q * total AND below < q * total""",
)
def t04(spark, sf):
    ev = events(spark, sf).withColumn("day", F.floor(F.unix_micros("ts") / F.lit(86_400_000_000)))
    buckets = cut(me.to_buckets(ev, BOUNDS, ["event_type", "day"]))
    parts = [
        me.histogram_quantile(buckets, q, ["event_type", "day"]).select("event_type", "day", F.lit(q).alias("q"), rounded())
        for q in (0.5, 0.95, 0.99)
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "t05_ratio_with_default",
    f"""WITH {COUNTER_SQL}, {rate_sql('counter', 'method, code')},
    b AS (SELECT t, sum(value) AS v FROM rates WHERE code <> 'OK' GROUP BY t), a AS (SELECT t, sum(value) AS v FROM rates GROUP BY t)
    SELECT a.t, round(coalesce(b.v, 0) / a.v, 6) AS value FROM a LEFT JOIN b USING (t)""",
)
def t05(spark, sf):
    r = cut(method_rates(spark, sf))
    bad = me.agg_by(r.where(F.col("labels")["code"] != "OK"), [])
    return me.ratio(bad, me.agg_by(r, []), ["t"], missing_b=1.0).select(at_us(), rounded())


@query(
    "t06_hit_rate",
    f"""WITH {COUNTER_SQL}, {rate_sql('counter', 'method, code')},
    h AS (SELECT t, value AS h FROM rates WHERE method = 'view'), m AS (SELECT t, value AS m FROM rates WHERE method = 'click')
    SELECT coalesce(h.t, m.t) AS t, round(coalesce(h, 0) / (coalesce(h, 0) + coalesce(m, 0)), 6) AS value
    FROM h FULL JOIN m ON h.t = m.t""",
)
def t06(spark, sf):
    r = cut(method_rates(spark, sf))
    hits, misses = (r.where(F.col("labels")["method"] == m).select("t", "value") for m in ("view", "click"))
    return me.hit_rate(hits, misses, ["t"]).select(at_us(), rounded())


@query(
    "t07_utilisation",
    """WITH d AS (SELECT user_id, epoch_us(ts) // 86400000000 AS day, event_type, sum(value) AS v FROM events GROUP BY ALL),
    a AS (SELECT * FROM d WHERE event_type = 'view'), b AS (SELECT * FROM d WHERE event_type = 'purchase')
    SELECT a.user_id, a.day, round((1 - a.v / b.v) * 100, 4) AS memory_used, round(a.v / b.v * 100, 4) AS disk_free,
    round(100 - (SELECT avg(v) FROM d c WHERE c.event_type = 'click' AND c.day = a.day) * 100, 4) AS cpu_used
    FROM a JOIN b ON a.user_id = b.user_id AND a.day = b.day
    WHERE EXISTS (SELECT 1 FROM d c WHERE c.event_type = 'click' AND c.day = a.day)""",
)
def t07(spark, sf):
    day = F.floor(F.unix_micros("ts") / F.lit(86_400_000_000)).alias("day")
    d = cut(events(spark, sf).groupBy("user_id", day, "event_type").agg(F.sum("value").alias("value")))
    keys = ["user_id", "day"]
    avail, total = d.where("event_type = 'view'"), d.where("event_type = 'purchase'")
    used = me.percent_used(avail, total, keys).select(*keys, F.round("value", 4).alias("memory_used"))
    free = me.percent_of(avail, total, keys).select(*keys, F.round("value", 4).alias("disk_free"))
    idle = d.where("event_type = 'click'").select(F.create_map(F.lit("mode"), F.lit("idle")).alias("labels"), F.col("day").alias("t"), "value")
    cpu = me.cpu_used(idle, []).select(F.col("t").alias("day"), F.round("value", 4).alias("cpu_used"))
    return used.join(free, keys).join(cpu, "day")


@query(
    "t08_signed_rate",
    f"""WITH {COUNTER_SQL}, {rate_sql('counter', 'method, code')}
    SELECT 'sent' AS direction, t, round(value, 6) AS value FROM rates WHERE method = 'view'
    UNION ALL SELECT 'received', t, round(-value, 6) FROM rates WHERE method = 'click'""",
)
def t08(spark, sf):
    r = cut(method_rates(spark, sf))
    sent, received = (r.where(F.col("labels")["method"] == m) for m in ("view", "click"))
    return me.signed_rate(sent, received).select("direction", at_us(), rounded())


@query(
    "t09_up_count",
    f"""WITH {HEALTH_SQL}, g AS (SELECT unnest(range((SELECT min(epoch_us(ts)) // 3600000000 * 3600000000 FROM up),
      (SELECT max(epoch_us(ts)) FROM up) + 6 * 3600000000, 3600000000)) AS t),
    i AS (SELECT job, t, arg_max(value, epoch_us(ts)) AS value FROM up JOIN g ON epoch_us(ts) > t - 6 * 3600000000
      AND epoch_us(ts) <= t GROUP BY job, t)
    SELECT t, count(CASE WHEN value = 1 THEN 1 END) AS up FROM i GROUP BY t""",
)
def t09(spark, sf):
    up = src.health_to_up(health_observations(spark, sf))
    return me.up_count(me.instant(up, STEP, RANGE)).select(at_us(), "up")


@query(
    "t09_availability",
    f"WITH {HEALTH_SQL} SELECT job, round(avg(value), 6) AS availability, count(*) AS samples FROM up GROUP BY job",
)
def t09b(spark, sf):
    up = src.health_to_up(health_observations(spark, sf))
    return me.availability(up, ["job"]).withColumn("availability", F.round("availability", 6))


@query(
    "t10_threshold",
    f"WITH {COUNTER_SQL}, {rate_sql('counter', 'method, code')} SELECT method, t FROM rates WHERE value > 0.0007",
)
def t10(spark, sf):
    return me.threshold(method_rates(spark, sf), ">", 0.0007).select(label("method"), at_us())


STATE_SQL = """
cond AS (SELECT 'u'||user_id AS series, ts, event_id, event_type IN ('error', 'click', 'view') AS active FROM events),
marked AS (SELECT *, active AND NOT coalesce(lag(active) OVER w AND epoch_us(ts) - epoch_us(lag(ts) OVER w) <= 172800000000, false) AS begins
           FROM cond WINDOW w AS (PARTITION BY series ORDER BY ts)),
runs AS (SELECT *, sum(CASE WHEN begins OR NOT active THEN 1 ELSE 0 END) OVER (PARTITION BY series ORDER BY ts) AS run FROM marked),
states AS (SELECT series, epoch_us(ts) AS t, CASE WHEN active THEN min(epoch_us(ts)) OVER (PARTITION BY series, run) END AS since,
           active FROM runs)"""
STATE_OUT = """SELECT series, t, since, CASE WHEN NOT active THEN 'inactive' WHEN t - since >= 86400000000 THEN 'firing'
ELSE 'pending' END AS state FROM states"""


def conditions(spark, sf):
    return events(spark, sf).select(
        tag("u", "user_id").alias("series"), "ts", F.col("event_type").isin("error", "click", "view").alias("active")
    )


@query("t11_alert_states", f"WITH {STATE_SQL} {STATE_OUT}")
def t11(spark, sf):
    s = al.alert_states(conditions(spark, sf), 86_400, step_s=172_800)
    return s.select("series", at_us("ts"), F.unix_micros("since").alias("since"), "state")


@query("t11_alert_states_stream", f"WITH {STATE_SQL} {STATE_OUT}")
def t11b(spark, sf):
    """The same from a stream of files in random order, one per micro-batch."""
    rows = cut_table(conditions(spark, sf).repartition(4, F.xxhash64("series", "ts")))
    stream = spark.readStream.schema(rows.df.schema).option("maxFilesPerTrigger", 1).parquet(rows.path)
    path = f"{shared_folder(spark)}/conditions-{uuid.uuid4().hex}"
    table = condition_table(spark, f"{path}/out")
    condition_stream(stream, table, f"{path}/state").awaitTermination()
    s = al.alert_states(table.read(), 86_400, step_s=172_800)
    return s.select("series", at_us("ts"), F.unix_micros("since").alias("since"), "state")


@query("t11_alert_states_timers", f"WITH {STATE_SQL} {STATE_OUT}")
def t11c(spark, sf):
    """The same with state and timers: files follow each other in time but for a day's disorder, and a row without a
    value at the end lets the watermark pass all of them."""
    day = 86_400_000_000
    late = F.unix_micros("ts") + F.pmod(F.xxhash64("series", "ts"), F.lit(day))
    rows = cut(conditions(spark, sf).withColumn("arrives", late))
    lo, hi = rows.agg(F.min("arrives"), F.max("arrives")).first()
    path = f"{shared_folder(spark)}/timers-{uuid.uuid4().hex}"
    for i in range(4):
        quarter = F.floor((F.col("arrives") - F.lit(lo or 0)) * 4 / F.lit((hi or 0) - (lo or 0) + 1)) == i
        rows.where(quarter).drop("arrives").write.mode("append").parquet(f"{path}/in")
    end = F.timestamp_micros(F.lit((hi or 0) + 10 * day))
    spark.range(1).select(F.lit("").alias("series"), end.alias("ts"), F.lit(None).cast("boolean").alias("active")).coalesce(1).write.mode(
        "append").parquet(f"{path}/in")
    stream = spark.readStream.schema(rows.drop("arrives").schema).option("maxFilesPerTrigger", 8).parquet(f"{path}/in")
    alert_stream(stream, f"{path}/out", f"{path}/state", 86_400, step_s=172_800, delay="2 days").awaitTermination()
    s = spark.read.schema(STATES).parquet(f"{path}/out/batch=*")
    return s.select("series", at_us("ts"), F.unix_micros("since").alias("since"), "state")


def named(df, name, factor=1.0, **labels):
    """Samples under another name, with the given labels."""
    pairs = [x for k, v in labels.items() for x in (F.lit(k), v if not isinstance(v, str) else F.lit(v))]
    return df.select(F.lit(name).alias("name"), F.create_map(*pairs).alias("labels"), "ts", (F.col("value") * factor).alias("value"))


def buckets(df, name, shares):
    """A histogram whose buckets hold fixed shares of a counter."""
    return [named(df, name, share, le=le) for le, share in shares.items()]


def rule_samples(spark, sf):
    """Samples under all names the service rules read, from the counters and gauges of the event types."""
    c, g = cut(counter_samples(spark, sf)), cut(gauge_samples(spark, sf))
    method = F.col("labels")["method"]
    count, gauge = ({m: df.where(method == m) for m in ("view", "click", "signup", "purchase")} for df in (c, g))
    up = {m: df.withColumn("value", F.when(F.col("value") > 10, 1.0).otherwise(0.0)) for m, df in gauge.items()}
    less = gauge["click"].withColumn("value", F.col("value") - 50)
    fixed = lambda m, v: gauge[m].withColumn("value", F.lit(float(v)))
    parts = [
        named(c, "spicedb_grpc_server_handled_total", grpc_method=method, grpc_code=F.col("labels")["code"]),
        *buckets(count["view"], "spicedb_grpc_server_handling_seconds_bucket", {"0.5": 0.5, "2": 0.9, "+Inf": 1.0}),
        named(up["view"], "up", job="spicedb"), named(up["click"], "up", job="redis"),
        named(up["signup"], "up", job="kafka"), named(up["purchase"], "up", job="postgres"),
        named(count["view"], "redis_keyspace_hits_total", job="redis"), named(count["click"], "redis_keyspace_misses_total", job="redis"),
        named(gauge["view"], "redis_memory_used_bytes", job="redis"), named(fixed("view", 40), "redis_memory_max_bytes", job="redis"),
        named(count["purchase"], "redis_evicted_keys_total", 20_000.0, job="redis"),
        named(gauge["click"], "pg_stat_activity_count", db="a"), named(gauge["purchase"], "pg_stat_activity_count", db="b"),
        named(fixed("view", 60), "pg_settings_max_connections", job="postgres"), named(gauge["purchase"], "pg_replication_lag", job="postgres"),
        named(gauge["signup"], "kafka_consumergroup_lag", 20.0, group="g"),
        named(less, "kafka_server_replicamanager_underreplicatedpartitions", job="kafka"),
        named(count["signup"], "node_cpu_seconds_total", 100.0, instance="n", mode="idle"),
        named(gauge["view"], "node_memory_MemAvailable_bytes", instance="n"), named(fixed("view", 100), "node_memory_MemTotal_bytes", instance="n"),
        named(gauge["click"], "node_filesystem_avail_bytes", instance="n"), named(fixed("click", 100), "node_filesystem_size_bytes", instance="n"),
    ]
    return reduce(DataFrame.unionByName, parts)


GAUGE_SQL = """
grid AS (SELECT unnest(range((SELECT min(epoch_us(ts)) // 3600000000 * 3600000000 FROM events),
         (SELECT max(epoch_us(ts)) FROM events) + 6 * 3600000000, 3600000000)) AS t),
gauge AS (SELECT event_type AS method, t, arg_max(value, epoch_us(ts)) AS value FROM events
          JOIN grid ON epoch_us(ts) > t - 6 * 3600000000 AND epoch_us(ts) <= t GROUP BY event_type, t)"""
RULES_SQL = f"""
{COUNTER_SQL}, {rate_sql('counter', 'method, code')}, {GAUGE_SQL},
idle AS (SELECT t, arg_max(pus, us) AS pus, max(us) AS us, arg_max(grown, us) AS grown FROM rates_i JOIN rates_g
         ON us > t - 6 * 3600000000 AND us <= t WHERE method = 'signup' AND pus IS NOT NULL GROUP BY t),
raw AS (
  SELECT 'SpiceDBHighErrorRate' AS alert, 300 AS hold, method AS s, t, value AS value, '>' AS op, 0.05 AS bound FROM rates WHERE code <> 'OK'
  UNION ALL SELECT 'SpiceDBHighLatency', 300, '', t, 2, '>', 1 FROM rates WHERE method = 'view'
  UNION ALL SELECT 'SpiceDBDown', 60, '', t, CASE WHEN value > 10 THEN 1 ELSE 0 END, '=', 0 FROM gauge WHERE method = 'view'
  UNION ALL SELECT 'RedisLowHitRate', 600, '', h.t, h.value / (h.value + m.value), '<', 0.5
    FROM rates h JOIN rates m ON h.t = m.t AND h.method = 'view' AND m.method = 'click'
  UNION ALL SELECT 'RedisHighMemory', 300, '', t, value / 40, '>', 0.9 FROM gauge WHERE method = 'view'
  UNION ALL SELECT 'RedisHighEvictionRate', 300, '', t, value * 20000, '>', 10 FROM rates WHERE method = 'purchase'
  UNION ALL SELECT 'RedisDown', 60, '', t, CASE WHEN value > 10 THEN 1 ELSE 0 END, '=', 0 FROM gauge WHERE method = 'click'
  UNION ALL SELECT 'PostgresTooManyConnections', 300, '', a.t, a.v / 60, '>', 0.8
    FROM (SELECT t, sum(value) AS v FROM gauge WHERE method IN ('click', 'purchase') GROUP BY t) a JOIN gauge m ON m.t = a.t AND m.method = 'view'
  UNION ALL SELECT 'PostgresReplicationLag', 300, '', t, value, '>', 30 FROM gauge WHERE method = 'purchase'
  UNION ALL SELECT 'PostgresDown', 60, '', t, CASE WHEN value > 10 THEN 1 ELSE 0 END, '=', 0 FROM gauge WHERE method = 'purchase'
  UNION ALL SELECT 'KafkaHighConsumerLag', 300, '', t, value * 20, '>', 1000 FROM gauge WHERE method = 'signup'
  UNION ALL SELECT 'KafkaUnderReplicatedPartitions', 300, '', t, value - 50, '>', 0 FROM gauge WHERE method = 'click'
  UNION ALL SELECT 'KafkaDown', 60, '', t, CASE WHEN value > 10 THEN 1 ELSE 0 END, '=', 0 FROM gauge WHERE method = 'signup'
  UNION ALL SELECT 'HighCPUUsage', 300, '', t, 100 - grown * 100 / ((us - pus) / 1e6) * 100, '>', 80 FROM idle WHERE pus > t - 6 * 3600000000
  UNION ALL SELECT 'HighMemoryUsage', 300, '', t, (1 - value / 100) * 100, '>', 90 FROM gauge WHERE method = 'view'
  UNION ALL SELECT 'LowDiskSpace', 300, '', t, value / 100 * 100, '<', 10 FROM gauge WHERE method = 'click'
),
val AS (SELECT *, CASE op WHEN '>' THEN value > bound WHEN '<' THEN value < bound ELSE value = bound END AS active FROM raw),
vm AS (SELECT *, active AND NOT coalesce(lag(active) OVER w AND t - lag(t) OVER w <= 3600000000, false) AS b FROM val
       WINDOW w AS (PARTITION BY alert, s ORDER BY t)),
vr AS (SELECT *, sum(CASE WHEN b OR NOT active THEN 1 ELSE 0 END) OVER (PARTITION BY alert, s ORDER BY t) AS run FROM vm),
vs AS (SELECT *, min(t) OVER (PARTITION BY alert, s, run) AS since FROM vr),
fired AS (SELECT alert, s, t, value, CASE WHEN NOT active THEN 'inactive' WHEN t - since >= hold * 1000000 THEN 'firing'
          ELSE 'pending' END AS state FROM vs)"""


@query(
    "t12_rule_set",
    f"WITH {RULES_SQL} SELECT alert, t, round(CAST(value AS DOUBLE), 6) AS value, state FROM fired",
)
def t12(spark, sf):
    out = al.evaluate_rules(cut(rule_samples(spark, sf)), SERVICE_RULES, range_s=RANGE, step_s=STEP, chunk=7 * 86_400)
    return out.select("alert", at_us("ts"), rounded(), "state")


def alert_rows(spark, sf):
    """Alerts with labels: events as alert instances of a service, severity by type."""
    return events(spark, sf).select(
        F.when(F.col("k") % 2 == 0, "HighLoad").otherwise("Down").alias("alertname"),
        F.when(F.col("k") % 5 > 0, F.lit("local")).alias("cluster"), F.when(F.col("k") % 3 > 0, F.concat(F.lit("svc"), F.col("k") % 3)).alias("service"),
        F.when(F.col("event_type") == "error", "critical").when(F.col("event_type") == "signup", "info")
        .otherwise("warning").alias("severity"),
        F.timestamp_micros(F.floor(F.unix_micros("ts") / F.lit(3_600_000_000)) * 3_600_000_000).alias("ts"),
        tag("u", "user_id").alias("series"), "event_id",
    )


ALERT_SQL = """
al AS (
  SELECT CASE WHEN k % 2 = 0 THEN 'HighLoad' ELSE 'Down' END AS alertname, CASE WHEN k % 5 > 0 THEN 'local' ELSE '' END AS cluster,
         CASE WHEN k % 3 > 0 THEN 'svc'||(k % 3) ELSE '' END AS service,
         CASE event_type WHEN 'error' THEN 'critical' WHEN 'signup' THEN 'info' ELSE 'warning' END AS severity,
         epoch_us(ts) // 3600000000 * 3600000000 AS t, 'u'||user_id AS series, event_id
  FROM (SELECT *, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events)
)"""


@query(
    "t13_group_alerts",
    f"""WITH {ALERT_SQL}, one AS (SELECT DISTINCT alertname, cluster, service, t, series FROM al),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY alertname, cluster, service, t ORDER BY series) - 1 AS place,
        count(*) OVER (PARTITION BY alertname, cluster, service, t) AS alerts FROM one)
    SELECT alertname, cluster, service, t, alerts, place // 4 AS page, (alerts + 3) // 4 AS pages,
        string_agg(series, ',' ORDER BY series) AS members FROM ranked GROUP BY ALL""",
)
def t13(spark, sf):
    g = al.group_alerts(alert_rows(spark, sf), page=4)
    return g.select("alertname", "cluster", "service", at_us("ts"), "alerts", "page", "pages", F.concat_ws(",", "members").alias("members"))


def group_content(spark, sf, group=None):
    """State of each alert group over time: firing while the last event is an error or a view."""
    return events(spark, sf).select(
        (F.concat(F.lit("grp"), F.col("user_id") % 10) if group is None else group).alias("grp"), "ts",
        F.when(F.col("event_type").isin("error", "view", "click", "purchase"), "firing").otherwise("resolved").alias("content"),
    )


@query(
    "t14_throttle",
    """WITH RECURSIVE raw AS (SELECT 'grp'||(user_id % 10) AS grp, epoch_us(ts) // 600000000 AS tick,
      arg_max(CASE event_type WHEN 'signup' THEN 'resolved' ELSE 'firing' END, ts) AS content FROM events GROUP BY ALL),
    chg AS (SELECT *, content IS DISTINCT FROM lag(content) OVER w AS c, row_number() OVER w AS rn FROM raw
      WINDOW w AS (PARTITION BY grp ORDER BY tick)),
    runs AS (SELECT *, sum(CAST(c AS INTEGER)) OVER (PARTITION BY grp ORDER BY tick) AS run FROM chg),
    sent AS (
      SELECT grp, tick, run, content, CASE rn WHEN 1 THEN 'first' ELSE 'changed' END AS reason FROM runs WHERE c
      UNION ALL
      SELECT grp, tick, run, content, 'repeat' FROM (
        SELECT s.grp, s.run, min(r.tick) AS tick, any_value(r.content) AS content FROM sent s JOIN runs r
        ON r.grp = s.grp AND r.run = s.run AND r.tick >= s.tick + 18 GROUP BY s.grp, s.run, s.tick))
    SELECT grp, tick * 600000000 AS sent_at, content, reason FROM sent""",
)
def t14(spark, sf):
    sent = al.throttle(group_content(spark, sf), ["grp"], repeat_s=3 * HOUR, interval_s=600)
    return sent.select("grp", F.unix_micros("sent_at").alias("sent_at"), "content", "reason")


@query(
    "t14_group_wait",
    """WITH RECURSIVE seen AS (SELECT 'g'||user_id AS grp, ts, epoch_us(ts) // 600000000 AS tick,
      CASE event_type WHEN 'signup' THEN 'resolved' ELSE 'firing' END AS content FROM events),
    raw AS (SELECT grp, greatest(tick, min(tick) OVER (PARTITION BY grp) + 6) AS tick, ts, content FROM seen),
    one AS (SELECT grp, tick, arg_max(content, ts) AS content FROM raw GROUP BY ALL),
    chg AS (SELECT *, content IS DISTINCT FROM lag(content) OVER w AS c, row_number() OVER w AS rn FROM one
      WINDOW w AS (PARTITION BY grp ORDER BY tick)),
    runs AS (SELECT *, sum(CAST(c AS INTEGER)) OVER (PARTITION BY grp ORDER BY tick) AS run FROM chg),
    sent AS (
      SELECT grp, tick, run, content, CASE rn WHEN 1 THEN 'first' ELSE 'changed' END AS reason FROM runs WHERE c
      UNION ALL
      SELECT grp, tick, run, content, 'repeat' FROM (
        SELECT s.grp, s.run, min(r.tick) AS tick, any_value(r.content) AS content FROM sent s JOIN runs r
        ON r.grp = s.grp AND r.run = s.run AND r.tick >= s.tick + 72 GROUP BY s.grp, s.run, s.tick))
    SELECT grp, tick * 600000000 AS sent_at, content, reason FROM sent""",
)
def t14b(spark, sf):
    """A group per user, first told an hour after it is seen, repeated after twelve hours."""
    groups = group_content(spark, sf, F.concat(F.lit("g"), F.col("user_id")))
    sent = al.throttle(groups, ["grp"], interval_s=600, group_wait_s=HOUR)
    return sent.select("grp", F.unix_micros("sent_at").alias("sent_at"), "content", "reason")


@query(
    "t15_inhibit",
    f"""WITH {ALERT_SQL} SELECT event_id, severity FROM al a WHERE severity <> 'warning' OR NOT EXISTS (SELECT 1 FROM al c
    WHERE c.severity = 'critical' AND c.alertname = a.alertname AND c.cluster = a.cluster AND c.service = a.service AND c.t = a.t)""",
)
def t15(spark, sf):
    return al.inhibit(alert_rows(spark, sf)).select("event_id", "severity")


@query(
    "t16_panel_reducers",
    """SELECT event_type, round(arg_max(v, ts) FILTER (v IS NOT NULL), 6) AS last_not_null,
    round(arg_max_null(v, ts), 6) AS last, round(avg(v), 6) AS mean, max(v) AS max
    FROM (SELECT event_type, ts, CASE WHEN value < 50 THEN value END AS v FROM events) GROUP BY event_type""",
)
def t16(spark, sf):
    rows = events(spark, sf).withColumn("value", F.when(F.col("value") < 50, F.col("value")))
    out = me.reduce_panel(rows, ["event_type"])
    return out.withColumns({c: F.round(c, 6) for c in ("last_not_null", "last", "mean")})


def consumer_samples(spark, sf):
    """The consumer's own metrics from the counters of the event types."""
    c = cut(counter_samples(spark, sf))
    method = F.col("labels")["method"]
    names = {"error": "validation_errors_total", "view": "messages_processed_total", "click": "retry_attempts_total"}
    parts = [named(c.where(method == m), f"rbac_kafka_consumer_{n}", topic="t") for m, n in names.items()]
    parts += buckets(c.where(method == "purchase"), "rbac_kafka_consumer_message_processing_duration_seconds_bucket", {"5": 0.5, "20": 0.95, "+Inf": 1.0})
    return reduce(DataFrame.unionByName, parts)


@query(
    "t17_consumer_alerts",
    f"""WITH {COUNTER_SQL}, {rate_sql('counter', 'method, code')} SELECT CASE method WHEN 'error' THEN 'High Error Rate'
    WHEN 'view' THEN 'Message Processing Stalled' WHEN 'click' THEN 'High Retry Rate' ELSE 'Slow Processing' END AS alert, t,
    CASE method WHEN 'purchase' THEN 20 ELSE round(value, 6) END AS value,
    CASE WHEN (method = 'error' AND value > 0.1) OR (method = 'view' AND value = 0) OR (method = 'click' AND value > 1) OR method = 'purchase'
    THEN 'firing' ELSE 'inactive' END AS state FROM rates WHERE method IN ('error', 'view', 'click', 'purchase')""",
)
def t17(spark, sf):
    out = al.evaluate_rules(consumer_samples(spark, sf), CONSUMER_RULES, range_s=RANGE, step_s=STEP, chunk=7 * 86_400)
    return out.select("alert", at_us("ts"), rounded(), "state")


@query(
    "t18_duration_buckets",
    f"""WITH {bucket_sql('event_type')} SELECT event_type, CASE WHEN isinf(le) THEN 'inf' ELSE CAST(CAST(le AS INTEGER) AS VARCHAR)
    END AS le, value FROM bucket""",
)
def t18(spark, sf):
    b = me.to_buckets(events(spark, sf), BOUNDS, ["event_type"])
    return b.select(
        "event_type", F.when(F.col("le") == float("inf"), "inf").otherwise(F.col("le").cast("int").cast("string")).alias("le"), "value"
    )


@query(
    "t19_error_share",
    f"""WITH {COUNTER_SQL}, {rate_sql('counter', 'method, code')},
    b AS (SELECT t, sum(value) AS v FROM rates WHERE code LIKE 'Int%' GROUP BY t), a AS (SELECT t, sum(value) AS v FROM rates GROUP BY t)
    SELECT a.t, round(coalesce(b.v, 0) / a.v * 100, 6) AS value FROM a LEFT JOIN b USING (t)""",
)
def t19(spark, sf):
    failed = F.col("labels")["code"].rlike("^Int.*$")
    return me.error_share(cut(method_rates(spark, sf)), failed, []).select(at_us(), rounded())
