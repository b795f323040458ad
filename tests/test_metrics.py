import random

import pytest
from pyspark.sql import functions as F

from grantflow.operators import alerts as al
from grantflow.operators import roles as ro
from grantflow.plans.alert_rules import SERVICE_RULES
from grantflow.session import literal_table
from grantflow.streaming.jobs import STATES, alert_stream, condition_table
from grantflow.operators import metrics as me

SAMPLE = "name string, series string, s int, value double"


def samples(spark, rows):
    df = spark.createDataFrame([("m", *r) for r in rows], SAMPLE)
    return df.select("name", F.create_map(F.lit("i"), F.col("series")).alias("labels"), F.timestamp_seconds("s").alias("ts"), "value")


def at(df):
    return {(r.labels["i"], int(r.t.timestamp())): round(r.value, 6) for r in df.collect()}


def test_rate_reset_single_sample_and_chunks(spark):
    data = [("a", 15 * i, float(v)) for i, v in enumerate([0, 10, 20, 5, 15, 30])] + [("one", 30, 5.0)]
    for chunk in (20, 86_400):
        got = at(me.rate(samples(spark, data), 60, 30, chunk=chunk))
        assert not [k for k in got if k[0] == "one"]
        assert all(v >= 0 for v in got.values())
        # At 60 s the look-back (0, 60] holds 10, 20, 5, 15: increases 10, 5 (restart), 10 over 45 s.
        assert got["a", 60] == round(25 / 45, 6)
        last = at(me.irate(samples(spark, data), 60, 30, chunk=chunk))
        assert last["a", 60] == round(10 / 15, 6) and last["a", 75 // 30 * 30 + 30] == 1.0


def test_rate_against_brute_force(spark):
    rnd = random.Random(5)
    data, s = [], 0
    for _ in range(120):
        s += rnd.randint(1, 40)
        data.append(("a", s, float(rnd.randint(0, 50))))
    want = {}
    for t in range(0, s + 200, 30):
        rows = [(x, v) for _, x, v in data if t - 120 < x <= t]
        if len(rows) >= 2:
            inc = sum(b[1] if b[1] < a[1] else b[1] - a[1] for a, b in zip(rows, rows[1:], strict=False))
            want["a", t] = round(inc / (rows[-1][0] - rows[0][0]), 6)
    assert at(me.rate(samples(spark, data), 120, 30, chunk=100)) == want


def test_quantile_edges(spark):
    inf = float("inf")
    rows = [("x", 1.0, 0.0), ("x", 2.0, 4.0), ("x", inf, 4.0), ("tail", 1.0, 1.0), ("tail", 2.0, 1.0), ("tail", inf, 9.0),
            ("none", 1.0, 0.0), ("none", inf, 0.0)]
    df = spark.createDataFrame(rows, "g string, le double, value double")
    got = {r.g: r.value for r in me.histogram_quantile(df, 0.5, ["g"]).collect()}
    assert got == {"x": 1.5, "tail": 2.0}


def test_ratio_defaults(spark):
    a = spark.createDataFrame([(1, 2.0)], "t int, value double")
    b = spark.createDataFrame([(1, 4.0), (2, 0.0), (3, 5.0)], "t int, value double")
    assert {r.t: r.value for r in me.ratio(a, b, ["t"]).collect()} == {1: 0.5, 2: None, 3: 0.0}


def test_alert_states_pending_never_fires_when_short(spark):
    flags = [True, True, False, True, True, True, True]
    df = spark.createDataFrame([("s", 30 * i, f) for i, f in enumerate(flags)], "series string, s int, active boolean")
    df = df.withColumn("ts", F.timestamp_seconds("s"))
    for chunk in (45, 86_400):
        got = [r.state for r in al.alert_states(df, 60, chunk=chunk).orderBy("ts").collect()]
        assert got == ["pending", "pending", "inactive", "pending", "pending", "firing", "firing"]


def throttled(rows, repeat, wait):
    """``(time, content, reason)`` of one group whose rows are in order, one per interval."""
    told, last, prev = [], None, None
    begin = rows[0][0] + wait
    early = [c for t, c in rows if t <= begin]
    for t, c in [(begin, early[-1]), *[r for r in rows if r[0] > begin]]:
        if last is None or c != prev or t - last >= repeat:
            told.append((t, c, "first" if last is None else "repeat" if c == prev else "changed"))
            last = t
        prev = c
    return told


def walk_rows(rnd, n, contents, steps):
    rows, s = [], 0
    for _ in range(n):
        s += rnd.choice(steps)
        rows.append((s, rnd.choice(contents)))
    return rows


@pytest.mark.parametrize("wait", [0, 50])
def test_throttle_against_brute_force(spark, wait):
    rnd = random.Random(3)
    groups = {
        "g": walk_rows(rnd, 200, "aaaab", [10, 10, 10, 20, 70, 400]),
        "calm": walk_rows(rnd, 400, "a", [10, 10, 20, 70, 400, 900]),  # many chunks without a change
        "rare": walk_rows(rnd, 300, "a" * 80 + "b", [10, 20, 330]),
        None: walk_rows(rnd, 60, ["a", None], [10, 400]),
    }
    rows = [(g, s, c) for g, part in groups.items() for s, c in part]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "g string, s int, content string").withColumn("ts", F.timestamp_seconds("s"))
    want = sorted((str(g), *x) for g, part in groups.items() for x in throttled(part, 300, wait))
    for chunk in (60, 500, 86_400):
        got = al.throttle(df, ["g"], repeat_s=300, interval_s=10, group_wait_s=wait, chunk=chunk).collect()
        assert sorted((str(r.g), int(r.sent_at.timestamp()), r.content, r.reason) for r in got) == want


def test_throttle_of_nothing_and_of_one_group_without_keys(spark):
    df = spark.createDataFrame([(0, "a"), (5, "b"), (None, "c")], "s int, content string").withColumn("ts", F.timestamp_seconds("s"))
    assert [(r.content, r.reason) for r in al.throttle(df, []).collect()] == [("b", "first")]
    assert al.throttle(df.where("false"), ["s"]).collect() == []


def test_every_rule_fires_on_its_own_data(spark):
    """Ten minutes of samples that break each rule, and the firing rules they give."""
    rows = []

    def series(name, labels, fn):
        rows.extend((name, labels, 15 * i, float(fn(i))) for i in range(81))

    series("spicedb_grpc_server_handled_total", {"grpc_code": "Internal"}, lambda i: 3 * i)
    for le, share in (("0.5", 0), ("2", 1), ("+Inf", 1)):
        series("spicedb_grpc_server_handling_seconds_bucket", {"le": le}, lambda i, share=share: 5 * i * share)
    for job in ("spicedb", "redis", "postgres", "kafka"):
        series("up", {"job": job}, lambda i: 0)
    series("redis_keyspace_hits_total", {}, lambda i: i)
    series("redis_keyspace_misses_total", {}, lambda i: 3 * i)
    series("redis_memory_used_bytes", {}, lambda i: 95)
    series("redis_memory_max_bytes", {}, lambda i: 100)
    series("redis_evicted_keys_total", {}, lambda i: 300 * i)
    series("pg_stat_activity_count", {"db": "x"}, lambda i: 90)
    series("pg_settings_max_connections", {}, lambda i: 100)
    series("pg_replication_lag", {}, lambda i: 31)
    series("kafka_consumergroup_lag", {"group": "g"}, lambda i: 1001)
    series("kafka_server_replicamanager_underreplicatedpartitions", {}, lambda i: 1)
    series("node_cpu_seconds_total", {"instance": "n", "mode": "idle"}, lambda i: i)
    series("node_memory_MemAvailable_bytes", {"instance": "n"}, lambda i: 5)
    series("node_memory_MemTotal_bytes", {"instance": "n"}, lambda i: 100)
    series("node_filesystem_avail_bytes", {"instance": "n"}, lambda i: 5)
    series("node_filesystem_size_bytes", {"instance": "n"}, lambda i: 100)
    df = spark.createDataFrame(rows, "name string, labels map<string,string>, s int, value double")
    df = df.select("name", "labels", F.timestamp_seconds("s").alias("ts"), "value")
    fired = al.evaluate_rules(df, literal_table(spark, SERVICE_RULES, al.RULE_COLUMNS)).where("state = 'firing'").select("alert").distinct()
    assert {r.alert for r in fired.collect()} == {r.alert for r in SERVICE_RULES}


def test_a_missing_series_starts_a_new_run(spark):
    rows = [("s", s, True) for s in (0, 30, 60, 86_400, 86_430, 86_460)]
    df = spark.createDataFrame(rows, "series string, s int, active boolean").withColumn("ts", F.timestamp_seconds("s"))
    got = [r.state for r in al.alert_states(df, 60, step_s=30).orderBy("ts").collect()]
    assert got == ["pending", "pending", "firing"] * 2


def test_absent_labels_group_and_inhibit(spark):
    rows = [
        ("A", None, None, "critical", 0, "x"), ("A", None, None, "warning", 0, "y"), ("A", "c", None, "warning", 0, "z"),
        ("A", None, None, "warning", 50, "u"), (None, None, "s", "warning", 0, "v"), ("A", None, None, "warning", -5, "t"),
    ]
    df = spark.createDataFrame(rows, "alertname string, cluster string, service string, severity string, s int, series string")
    df = df.withColumn("ts", F.timestamp_seconds("s"))
    groups = {(r.alertname, r.cluster, r.service, r.s): r.alerts for r in al.group_alerts(df).withColumn("s", F.unix_timestamp("ts")).collect()}
    assert groups == {("A", "", "", 0): 2, ("A", "c", "", 0): 1, ("A", "", "", 50): 1, ("", "", "s", 0): 1, ("A", "", "", -5): 1}
    assert {r.series for r in al.inhibit(df).collect()} == {"x", "z", "u", "v", "t"}
    assert {r.series for r in al.inhibit(df, within_s=60).collect()} == {"x", "z", "v", "t"}


def test_rates_of_a_busy_series_and_ragged_ranges(spark):
    rnd = random.Random(9)
    data = [("hot", i // 3 if i % 5 else i // 3 + 1, float(rnd.randint(0, 9))) for i in range(0, 900, 2)]
    data = list({(g, s): (g, s, v) for g, s, v in data}.values()) + [("thin", s, 1.0 * s) for s in (7, 95, 200)]
    rows = {}
    for g, s, v in sorted(data):
        rows.setdefault(g, []).append((s, v))
    for range_s, step in ((50, 30), (45, 15), (7, 20)):
        want, last = {}, {}
        for g, part in rows.items():
            for t in range(0, 600, step):
                seen = [(s, v) for s, v in part if t - range_s < s <= t]
                if seen:
                    last[g, t] = seen[-1][1]
                if len(seen) > 1:
                    grown = sum(b[1] if b[1] < a[1] else b[1] - a[1] for a, b in zip(seen, seen[1:], strict=False))
                    want[g, t] = round(grown / (seen[-1][0] - seen[0][0]), 6)
        for chunk in (60, 86_400):
            assert at(me.rate(samples(spark, data), range_s, step, chunk=chunk)) == want
        assert at(me.instant(samples(spark, data), step, range_s)) == last


def test_rules_match_labels_and_read_the_samples_once(spark):
    rows = [("up", {"job": j}, 30, v) for j, v in (("a", 0.0), ("b", 1.0), ("ab", 0.0))] + [("up", {}, 30, 0.0)]
    df = spark.createDataFrame(rows, "name string, labels map<string,string>, s int, value double")
    df = df.select("name", "labels", F.timestamp_seconds("s").alias("ts"), "value")

    def rule(name, match, value):
        return al.AlertRule(name, "gauge", "up", None, "job", match, value, None, "==", 0, 0, "critical", "x")

    rules = [rule("eq", "=", "a"), rule("ne", "!=", "a"), rule("re", "=~", "a|b"), rule("nr", "!~", "a.*"), rule("none", "=", "")]
    out = al.evaluate_rules(df, rules, range_s=30, step_s=30).where("ts = timestamp_seconds(30)")
    got = {(r.alert, r.series, r.state) for r in out.collect()}
    job = lambda j: f'{{"job":"{j}"}}'
    assert got == {
        ("eq", job("a"), "firing"), ("ne", job("b"), "inactive"), ("ne", job("ab"), "firing"), ("ne", "{}", "firing"),
        ("re", job("a"), "firing"), ("re", job("b"), "inactive"), ("nr", job("b"), "inactive"), ("nr", "{}", "firing"),
        ("none", "{}", "firing"),
    }


def test_alert_stream_equals_the_batch_and_empties_its_state(spark, tmp_path):
    """Conditions shuffled within the delay, twice with other values at the same time, and a series that ends early."""
    rnd = random.Random(4)
    rows = [(g, 30 * i, rnd.random() < 0.8) for g in ("a", "b") for i in range(80) if rnd.random() < 0.9]
    rows += [("short", 30 * i, True) for i in range(5)] + [("a", 30 * i, False) for i in (3, 9)]
    rows.sort(key=lambda r: r[1] + rnd.randint(0, 100))
    schema = "series string, s int, active boolean"

    def frame(part):
        return spark.createDataFrame(part, schema).select("series", F.timestamp_seconds(F.col("s") + 86_400).alias("ts"), "active")

    for part in (rows[:60], rows[60:110], rows[110:], [("", 30 * 80 + 1000, None)], [("", 30 * 80 + 2000, None)]):
        frame(part).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("series string, ts timestamp, active boolean").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    query = alert_stream(stream, f"{tmp_path}/out", f"{tmp_path}/state", 60, step_s=30, delay="150 seconds")
    query.awaitTermination()
    got = spark.read.schema(STATES).parquet(f"{tmp_path}/out/batch=*").select("series", "ts", "active", "since", "state")
    once = frame(rows).groupBy("series", "ts").agg(F.bool_or("active").alias("active"))
    want = al.alert_states(once, 60, step_s=30).select("series", "ts", "active", "since", "state")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    for name in ("waiting", "last"):
        state = spark.read.format("statestore").option("stateVarName", name).load(f"{tmp_path}/state")
        assert state.where("key.series <> ''").count() == 0


def test_alert_stream_calls_its_state_by_bucket(spark, tmp_path):
    """The state of many series lies in few rows, and their states are those of the batch, a series without a name among them."""
    rows = [(f"s{g}" if g else None, 86_400 + 30 * i + g, (g + i) % 5 > 0) for g in range(40) for i in range(12)]
    schema = "series string, ts timestamp, active boolean"
    frame = spark.createDataFrame(rows, "series string, s int, active boolean").select("series", F.timestamp_seconds("s").alias("ts"), "active")
    for part in (frame, spark.createDataFrame([("", None, None)], schema).withColumn("ts", F.timestamp_seconds(F.lit(86_400 + 180 + 150)))):
        part.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    alert_stream(stream, f"{tmp_path}/out", f"{tmp_path}/state", 60, step_s=30, delay="150 seconds", buckets=3).awaitTermination()
    got = spark.read.schema(STATES).parquet(f"{tmp_path}/out/batch=*")
    passed = got.agg(F.max("ts")).first()[0]
    want = al.alert_states(frame, 60, step_s=30).select(*got.columns).where(F.col("ts") <= F.lit(passed))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and 0 < got.count() < len(rows)
    for name in ("waiting", "last"):
        state = spark.read.format("statestore").option("stateVarName", name).load(f"{tmp_path}/state")
        assert 1 <= state.count() <= 3


def test_condition_table_has_a_winner(spark, tmp_path):
    table = condition_table(spark, str(tmp_path))
    rows = [("s", 0, False), ("s", 0, True), ("s", 5, False)]
    df = spark.createDataFrame(rows, "series string, s int, active boolean").withColumn("ts", F.timestamp_seconds("s"))
    table.put(df.where("active"), 0)
    table.put(df.where("not active"), 1)
    assert sorted((r.s, r.active) for r in table.read().withColumn("s", F.unix_timestamp("ts")).collect()) == [(0, True), (5, False)]


def test_default_grants_and_asked_users(spark):
    people = [("u", False), ("u", False), ("adm", True), ("x", None)]
    principals = spark.createDataFrame(people, "username string, is_org_admin boolean")
    flags = [("viewer", True, False), ("viewer", True, True), ("owner", False, True), ("plain", None, False)]
    roles = spark.createDataFrame(flags, "role string, platform_default boolean, admin_default boolean")
    explicit = spark.createDataFrame([("u", "viewer"), ("u", "owner"), ("adm", "owner"), ("gone", "viewer"), ("u", "plain")], "username string, role string")
    want = {("u", "viewer"), ("u", "owner"), ("u", "plain"), ("adm", "viewer"), ("adm", "owner"), ("x", "viewer"), ("gone", "viewer")}
    assert {tuple(r) for r in ro.default_grants(roles).collect()} == {("platform", "viewer"), ("admin", "owner")}
    got = [tuple(r) for r in ro.default_assignments(principals, roles, explicit).collect()]
    assert len(got) == len(want) and set(got) == want
    asked = spark.createDataFrame([("u",), ("gone",), ("nobody",)], "username string")
    got = [tuple(r) for r in ro.default_assignments(principals, roles, explicit, asked).collect()]
    assert sorted(got) == sorted(w for w in want if w[0] in ("u", "gone"))
