"""Writes, versions, change flow, streams and decision cache over data derived from the given tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions.text import decision_key, relation_key, schema_key
from ..model import TUPLE_COLS
from ..operators import cache as ca
from ..operators import relate as re
from ..operators import writes as wr
from ..session import cut, cut_table, shared_folder
from ..sources import cdc
from ..streaming import jobs
from .catalog import query
from .derived import (
    ENVELOPE_SQL, GRAPH_SQL, GROUP, HOST, LOG_SQL, USER, VERSION_SQL, WS, change_log, decisions, devices,
    envelope_json, events, flat_json, graph, op_code, relation_versions, table,
)
from .queries_sources import (
    EV_SQL, FLAT_SQL, OPERATION_SQL, messages, operation_events, run_stream, schema_envelope, tag,
)

TUP = "res_type, res_id, relation, sub_type, sub_id, sub_rel"


def scratch(spark, kind):
    return f"{shared_folder(spark)}/{kind}-{uuid.uuid4().hex}"


def memberships(spark, sf):
    """Suppliers as members of their nation's group and of the next one: half of them exist already."""
    shift = F.explode(F.array(F.lit(0), F.lit(1))).alias("shift")
    s = table(spark, sf, "supplier").select("s_suppkey", "s_nationkey", shift)
    return s.select(
        F.lit(GROUP).alias("res_type"), F.concat(F.lit("gn"), (F.col("s_nationkey") + F.col("shift")) % 25).alias("res_id"),
        F.lit("t_member").alias("relation"), F.lit(USER).alias("sub_type"), tag("u", "s_suppkey").alias("sub_id"),
        F.lit("").alias("sub_rel"),
    )


MEMBER_SQL = f"""
{GRAPH_SQL},
new AS (
  SELECT DISTINCT 'rbac/group' AS res_type, 'gn'||((s_nationkey + x) % 25) AS res_id, 't_member' AS relation,
    'rbac/principal' AS sub_type, 'u'||s_suppkey AS sub_id, '' AS sub_rel FROM supplier, (VALUES (0), (1)) v(x)
)"""


@query("w01_touch", f"WITH {MEMBER_SQL} SELECT {TUP} FROM tup UNION SELECT {TUP} FROM new")
def w01(spark, sf):
    return wr.touch(graph(spark, sf), memberships(spark, sf))


@query(
    "w02_create",
    f"""WITH {MEMBER_SQL} SELECT {TUP}, 'conflict' AS outcome FROM (SELECT {TUP} FROM new INTERSECT SELECT {TUP} FROM tup)
    UNION ALL SELECT {TUP}, 'stored' FROM (SELECT {TUP} FROM tup UNION SELECT {TUP} FROM new)""",
)
def w02(spark, sf):
    after, conflicts = wr.create(graph(spark, sf), memberships(spark, sf))
    return after.withColumn("outcome", F.lit("stored")).unionByName(conflicts.withColumn("outcome", F.lit("conflict")))


@query("w03_delete", f"WITH {MEMBER_SQL} SELECT {TUP} FROM tup EXCEPT SELECT {TUP} FROM new")
def w03(spark, sf):
    return wr.delete(graph(spark, sf), memberships(spark, sf))


@query(
    "w04_delete_where",
    f"WITH {GRAPH_SQL} SELECT {TUP} FROM tup WHERE NOT (res_type = 'rbac/group' AND relation = 't_member' AND sub_rel = 'member')",
)
def w04(spark, sf):
    return wr.delete_where(
        graph(spark, sf), resource_namespace="rbac", resource_type="group", relation="t_member", subject_relation="member"
    )


@query(
    "w05_update_by_change",
    f"""WITH {LOG_SQL}, base AS (SELECT id, arg_max(tenant_id, lsn) AS t FROM log WHERE op IN ('c', 'r') GROUP BY id),
    last AS (SELECT id, arg_max(tenant_id, lsn) AS t, arg_max(op, lsn) AS op FROM log WHERE op IN ('u', 'd') GROUP BY id)
    SELECT 'rbac/workspace' AS res_type, id AS res_id, 't_parent' AS relation, 'rbac/tenant' AS sub_type, t AS sub_id,
    '' AS sub_rel FROM (SELECT id, t FROM base WHERE id NOT IN (SELECT id FROM last)
                        UNION ALL SELECT id, t FROM last WHERE op <> 'd')""",
)
def w05(spark, sf):
    log = change_log(spark, sf)
    base = re.cdc_tuples(log.where("op in ('c', 'r')"))
    return wr.cdc_update(base, log.where("op in ('u', 'd')"))


@query(
    "w06_upsert_rows",
    """WITH base AS (SELECT 'o'||o_orderkey AS id, 'dev '||o_orderpriority AS display_name, 'c'||o_custkey AS workspace_id
      FROM orders), inc AS (SELECT 'o'||(p_partkey * 10) AS id, p_name AS display_name, 'cx' AS workspace_id FROM part)
    SELECT coalesce(b.id, i.id) AS id, coalesce(i.display_name, b.display_name) AS display_name,
    coalesce(b.workspace_id, i.workspace_id) AS workspace_id FROM base b FULL JOIN inc i ON b.id = i.id""",
)
def w06(spark, sf):
    base = devices(spark, sf).select("id", "display_name", "workspace_id")
    inc = table(spark, sf, "part").select(
        F.concat(F.lit("o"), F.col("p_partkey") * 10).alias("id"), F.col("p_name").alias("display_name"),
        F.lit("cx").alias("workspace_id"),
    )
    return wr.upsert_rows(base, inc, "id", ["display_name"])


LAST_SQL = f"""
{VERSION_SQL},
last AS (SELECT {TUP}, arg_max(op, lsn) AS op FROM wlog GROUP BY {TUP})"""


@query("w07_fold_updates", f"WITH {LAST_SQL} SELECT {TUP} FROM last WHERE op = 'TOUCH'")
def w07(spark, sf):
    log = relation_versions(spark, sf)
    start = log.where("op = 'TOUCH'").select(*TUPLE_COLS).distinct()
    return wr.fold_updates(start, log, seq="lsn")


INTERVAL_SQL = f"""
{VERSION_SQL},
step AS (
  SELECT *, op = 'TOUCH' AS live, coalesce(lag(op = 'TOUCH') OVER w, false) AS was FROM wlog
  WINDOW w AS (PARTITION BY {TUP} ORDER BY lsn)
),
span AS (
  SELECT {TUP}, live, lsn AS created_xid,
         coalesce(lead(lsn) OVER (PARTITION BY {TUP} ORDER BY lsn), 9223372036854775807) AS deleted_xid
  FROM step WHERE live <> was
)"""


@query(
    "w08_as_of_revision",
    f"WITH {INTERVAL_SQL} SELECT {TUP} FROM span WHERE live AND created_xid <= 700 AND deleted_xid > 700",
)
def w08(spark, sf):
    return wr.as_of(wr.to_versions(relation_versions(spark, sf), block=1000), 700)


@query(
    "w09_freshness_gate",
    f"""WITH {INTERVAL_SQL}, rev AS (SELECT greatest(max(created_xid),
      max(CASE WHEN deleted_xid < 9223372036854775807 THEN deleted_xid END)) AS revision FROM span WHERE live)
    SELECT revision, t AS token, revision >= t AS fresh, CASE WHEN revision < t THEN 'revision is behind the token' END
    AS error FROM rev, (VALUES (CAST(500 AS BIGINT)), (CAST(100000000 AS BIGINT))) v(t)""",
)
def w09(spark, sf):
    v = cut(wr.to_versions(relation_versions(spark, sf), block=1000))
    return wr.at_least(v, 500).unionByName(wr.at_least(v, 100_000_000))


@query("w10_version_intervals", f"WITH {INTERVAL_SQL} SELECT {TUP}, created_xid, deleted_xid FROM span WHERE live")
def w10(spark, sf):
    return wr.to_versions(relation_versions(spark, sf), block=1000)


OWNER_SQL = """
own AS (SELECT 'hbi/host' AS res_type, 'o'||o_orderkey AS res_id, 'owner' AS relation, 'rbac/principal' AS sub_type,
        'c'||o_custkey AS sub_id, '' AS sub_rel, o_orderstatus AS s FROM orders),
moved AS (SELECT res_type, res_id, relation, sub_type, 'boss' AS sub_id, '' AS sub_rel FROM own WHERE s = 'P')"""


def owners(spark, sf):
    rows = devices(spark, sf).select(
        F.lit(HOST).alias("res_type"), F.col("id").alias("res_id"), F.lit("owner").alias("relation"),
        F.lit(USER).alias("sub_type"), F.col("workspace_id").alias("sub_id"), F.lit("").alias("sub_rel"), "reporter",
    )
    moves = rows.where("reporter = 'P'").select("res_type", "res_id", "sub_type", F.lit("boss").alias("sub_id"))
    return rows.drop("reporter"), moves


@query(
    "w11_transfer_replace",
    f"WITH {OWNER_SQL} SELECT {TUP} FROM own WHERE s <> 'P' UNION SELECT {TUP} FROM moved",
)
def w11(spark, sf):
    return wr.transfer(*owners(spark, sf))


@query("w11_transfer_add", f"WITH {OWNER_SQL} SELECT {TUP} FROM own UNION SELECT {TUP} FROM moved")
def w11b(spark, sf):
    return wr.transfer(*owners(spark, sf), replace=False)


@query(
    "c01_workspace_tuples",
    f"""WITH {LOG_SQL} SELECT id AS res_id, tenant_id AS sub_id, CAST(CASE op WHEN 'd' THEN -1 ELSE 1 END AS INTEGER) AS sign,
    count(*) AS n FROM log WHERE tenant_id <> 't3' GROUP BY ALL""",
)
def c01(spark, sf):
    log = change_log(spark, sf).withColumn("tenant_id", F.when(F.col("tenant_id") != "t3", F.col("tenant_id")))
    return re.workspace_tuples(log).groupBy("res_id", "sub_id", "sign").agg(F.count("*").alias("n"))


@query(
    "c02_role_events",
    f"""WITH x AS (SELECT CASE WHEN k > 90 THEN '' ELSE 'r'||user_id END AS id, CASE WHEN k > 20 THEN 'w'||k END AS ws,
      CASE event_type WHEN 'signup' THEN 'c' WHEN 'view' THEN 'r' WHEN 'error' THEN 'd' ELSE 'u' END AS op FROM {EV_SQL})
    SELECT op, CASE WHEN id = '' THEN 'missing_id' WHEN op <> 'd' AND ws IS NULL THEN 'missing_workspace' ELSE 'ok' END
    AS outcome, count(*) AS events FROM x GROUP BY ALL""",
)
def c02(spark, sf):
    rows = events(spark, sf).select(
        F.when(F.col("k") > 90, "").otherwise(tag("r", "user_id")).alias("id"),
        F.when(F.col("k") > 20, tag("w", "k")).alias("workspace_id"), op_code().alias("op"),
    )
    return re.role_events(rows)


@query(
    "c03_resource_tuples",
    f"""WITH {OPERATION_SQL} SELECT 'edge/device' AS res_type, id AS res_id, workspace_id AS sub_id,
    CAST(CASE resolved WHEN 'deleted' THEN -1 ELSE 1 END AS INTEGER) AS sign FROM opev WHERE resolved <> 'bogus'""",
)
def c03(spark, sf):
    rows = cdc.resolve_operation(operation_events(spark, sf))
    return re.resource_tuples(rows, "edge", "device").select("res_type", "res_id", "sub_id", "sign")


@query(
    "c04_dispatch",
    f"""WITH {FLAT_SQL} SELECT CASE tbl WHEN 'roles' THEN 'role' ELSE 'workspace' END||'_'||CASE op WHEN 'u' THEN 'update'
    WHEN 'd' THEN 'delete' ELSE 'create' END AS route, count(*) AS events FROM flat WHERE NOT bad GROUP BY ALL""",
)
def c04(spark, sf):
    good, _ = cdc.decode_flat_cdc(flat_json(spark, sf))
    return re.event_counts(re.dispatch(good), ["route"])


@query(
    "c05_current_state",
    f"""WITH {LOG_SQL} SELECT id, arg_max(tenant_id, lsn) AS tenant_id, max(lsn) AS lsn FROM log GROUP BY id
    HAVING arg_max(op, lsn) <> 'd'""",
)
def c05(spark, sf):
    return re.latest_state(change_log(spark, sf), ["id"]).select("id", "tenant_id", "lsn")


@query(
    "c06_stream_to_tuples",
    f"""WITH {FLAT_SQL} SELECT id AS res_id, arg_max(tenant_id, lsn) AS sub_id FROM flat
    WHERE NOT bad AND tbl = 'workspaces' GROUP BY id HAVING arg_max(op, lsn) <> 'd'""",
)
def c06(spark, sf):
    source = jobs.read_event_stream(spark, cut_table(messages(spark, sf)).path)
    target = jobs.workspace_table(spark, scratch(spark, "tuples"))
    jobs.workspace_stream(source, target, scratch(spark, "state")).awaitTermination()
    return jobs.current_tuples(target).select("res_id", "sub_id")


@query("c06_dead_letters", f"WITH {FLAT_SQL} SELECT CAST(key AS VARCHAR) AS key, count(*) OVER () AS bad, (SELECT count(*) FROM flat) AS messages FROM flat WHERE bad")
def c06b(spark, sf):
    """Malformed messages of the running stream as a table, with the counts of its batches."""
    path = scratch(spark, "outputs")
    stream = jobs.read_event_stream(spark, cut_table(messages(spark, sf)).path)
    jobs.workspace_stream(stream, jobs.workspace_table(spark, scratch(spark, "tuples")), scratch(spark, "state"), outputs=path).awaitTermination()
    counts = spark.read.parquet(f"{path}/counts").agg(F.sum("bad").alias("bad"), F.sum(F.col("good") + F.col("bad")).alias("messages"))
    dead = spark.read.parquet(f"{path}/dead").select("key", F.lit(1).alias("one"))
    return dead.join(counts.withColumn("one", F.lit(1)), "one").drop("one")


@query(
    "c07_deduplicate",
    f"WITH {ENVELOPE_SQL} SELECT namespace, op, count(*) AS events FROM env GROUP BY ALL",
)
def c07(spark, sf):
    once = cdc.decode_envelope(envelope_json(spark, sf))
    return re.dedupe(once.unionByName(once), re.event_identity()).groupBy("namespace", "op").agg(F.count("*").alias("events"))


@query("c07_deduplicate_stream", "SELECT CAST(event_id AS VARCHAR) AS key FROM events")
def c07b(spark, sf):
    twice = messages(spark, sf).withColumn("copy", F.explode(F.array(F.lit(0), F.lit(1)))).drop("copy")
    stream = jobs.read_event_stream(spark, cut_table(twice).path)
    return run_stream(jobs.dedupe_stream(stream, ["key"], delay="60 days").select("key"))


@query(
    "c08_two_stage_flow",
    "SELECT 'o'||o_orderkey AS res_id, 'c'||o_custkey AS sub_id FROM orders WHERE o_orderstatus <> 'F'",
)
def c08(spark, sf):
    rows = devices(spark, sf).select(
        "id", "workspace_id", F.when(F.col("reporter") == "F", "deleted").otherwise("created").alias("resolved"),
        F.unix_millis("created_at").alias("seq"),
    )
    path = cut_table(rows).path
    stream = spark.readStream.schema(rows.schema).parquet(path)
    target = jobs.update_table(spark, scratch(spark, "tuples"))

    def second_outbox(batch):
        op = F.when(F.col("sign") < 0, "DELETE").otherwise("TOUCH").alias("op")
        return re.resource_tuples(batch, "hbi", "host", keep=["seq"]).select(*TUPLE_COLS, op, "seq")

    jobs.two_stage(stream, scratch(spark, "resources"), target, scratch(spark, "state"), second_outbox)
    return jobs.live_tuples(target).select("res_id", "sub_id")


@query(
    "c09_admin_notifications",
    f"""WITH {ENVELOPE_SQL} SELECT object_id AS organization, userset_object_id AS admin, operation, ts_ms FROM env
    WHERE namespace = 'organization' AND relation = 'admin'""",
)
def c09(spark, sf):
    return re.admin_changes(cdc.decode_envelope(envelope_json(spark, sf)))


@query(
    "c10_event_counts",
    f"WITH {ENVELOPE_SQL} SELECT operation, namespace, count(*) AS events FROM env GROUP BY ALL",
)
def c10(spark, sf):
    return re.event_counts(cdc.decode_envelope(envelope_json(spark, sf)), ["operation", "namespace"])


@query(
    "c10_event_counts_stream",
    """SELECT epoch_us(ts) // 86400000000 * 86400000 AS start_ms,
    CASE event_type WHEN 'view' THEN 'roles.events' ELSE 'workspaces.events' END AS topic, count(*) AS events
    FROM events GROUP BY ALL""",
)
def c10b(spark, sf):
    """Counts per day and topic from files in no order, two per micro-batch."""
    stream = jobs.read_event_stream(spark, cut_table(messages(spark, sf)).path, files_per_batch=2)
    path = scratch(spark, "counts")
    jobs.count_stream(stream, f"{path}/out", ["topic"], f"{path}/state", window="1 day").awaitTermination()
    out = jobs.window_counts(spark, f"{path}/out", ["topic"])
    return out.select(F.unix_millis("start").alias("start_ms"), "topic", "events")


LAG_SQL = """
off AS (
  SELECT l_returnflag AS g, l_linestatus AS topic, l_linenumber AS partition, count(*) AS log_end_offset,
         count(CASE WHEN l_quantity < 40 THEN 1 END) AS current_offset FROM lineitem GROUP BY ALL
)"""


@query(
    "c11_consumer_lag",
    f"""WITH {LAG_SQL} SELECT g AS "group", topic, partition, CAST(sum(log_end_offset - current_offset) AS BIGINT) AS lag,
    sum(log_end_offset - current_offset) > 1000 AS critical FROM off
    GROUP BY GROUPING SETS ((g, topic, partition), (g, topic), (g))""",
)
def c11(spark, sf):
    offsets = table(spark, sf, "lineitem").groupBy(
        F.col("l_returnflag").alias("group"), F.col("l_linestatus").alias("topic"), F.col("l_linenumber").alias("partition")
    ).agg(
        F.count("*").alias("log_end_offset"), F.count(F.when(F.col("l_quantity") < 40, 1)).alias("current_offset")
    )
    return re.consumer_lag(offsets)


@query(
    "c12_hop_latency",
    """WITH d AS (SELECT nullif(o_orderpriority, '5-LOW') AS stage, date_diff('day', o_orderdate, s) * 86400000 AS took FROM orders
      JOIN (SELECT l_orderkey, min(l_shipdate) AS s FROM lineitem GROUP BY l_orderkey) ON l_orderkey = o_orderkey)
    SELECT stage, count(*) AS events, round(avg(took)) AS mean_ms, round(quantile_cont(took, 0.5)) AS p50_ms,
    round(quantile_cont(took, 0.95)) AS p95_ms, round(quantile_cont(took, 0.99)) AS p99_ms FROM d GROUP BY stage""",
)
def c12(spark, sf):
    first = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("event_id"), F.unix_millis(F.col("o_orderdate").cast("timestamp")).alias("at_ms"),
        F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("stage"),
    )
    second = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("event_id")).agg(
        F.unix_millis(F.min("l_shipdate").cast("timestamp")).alias("at_ms")
    )
    out = re.hop_latency(first, second, ["stage"])
    return out.withColumns({c: F.round(c, 0) for c in ("mean_ms", "p50_ms", "p95_ms", "p99_ms")})


@query(
    "c13_retry_stats",
    """WITH x AS (SELECT user_id, count(*) AS attempts, count(CASE WHEN event_type = 'error' THEN 1 END) AS failures,
      bool_or(event_type <> 'error') AS succeeded FROM events GROUP BY user_id)
    SELECT user_id, attempts, failures, succeeded, CAST(coalesce((SELECT sum(least(pow(2.0, n - 1), 300.0))
      FROM range(1, 100000) r(n) WHERE n <= failures), 0) AS DOUBLE) AS backoff_sec FROM x""",
)
def c13(spark, sf):
    tries = events(spark, sf).select("user_id", (F.col("event_type") != "error").alias("ok"))
    return re.retry_stats(tries, ["user_id"])


@query(
    "c14_schema_changes",
    f"""WITH {ENVELOPE_SQL}, e AS (SELECT *, CASE WHEN value > 100 THEN NULL ELSE
      repeat('def '||event_type||' ', 20) END AS d FROM events)
    SELECT 'ns'||user_id AS namespace, operation, substr(d, 1, 100) AS preview,
    CAST(CASE WHEN d IS NULL THEN length(props) + 4 ELSE length(d) + 17 END AS INTEGER) AS size, event_id AS xid
    FROM e JOIN env ON key = event_id""",
)
def c14(spark, sf):
    return re.schema_changes(schema_envelope(spark, sf))


@query(
    "c15_change_report",
    f"""WITH {ENVELOPE_SQL} SELECT key, 'Relationship '||CASE operation WHEN 'UPDATE' THEN 'UPDATED' WHEN 'DELETE' THEN
    'DELETED' ELSE 'CREATED' END||' '||namespace||':'||object_id||'#'||relation||CASE operation WHEN 'UPDATE' THEN ''
    ELSE '@user:'||userset_object_id END||CASE WHEN operation IN ('CREATE', 'READ') THEN '#'||CASE userset_relation
    WHEN '' THEN 'self' ELSE userset_relation END ELSE '' END AS line FROM env""",
)
def c15(spark, sf):
    return re.change_report(cdc.decode_envelope(envelope_json(spark, sf))).select("key", "line")


CACHE_SQL = f"""
cache AS (
  SELECT 'rbac/workspace' AS res_type, 'w'||user_id AS res_id, event_type AS permission, 'user' AS sub_type,
         'u'||k AS sub_id, value > 50 AS allowed, event_id AS checked_at, ts AS cached_at FROM {EV_SQL}
)"""


@query(
    "k01_cache_keys",
    f"""WITH {CACHE_SQL} SELECT 'authz:perm:'||res_type||':'||res_id||':'||permission||':'||sub_type||':'||sub_id AS dkey,
    'authz:rel:'||res_type||':'||res_id||':'||permission AS rkey, 'authz:schema:'||res_type AS skey FROM cache""",
)
def k01(spark, sf):
    return decisions(spark, sf).select(
        decision_key("authz", "res_type", "res_id", "permission", "sub_type", "sub_id").alias("dkey"),
        relation_key("authz", "res_type", "res_id", "permission").alias("rkey"),
        schema_key("authz", "res_type").alias("skey"),
    )


@query(
    "k02_fresh_decisions",
    f"""WITH {CACHE_SQL} SELECT res_id, permission, sub_id, checked_at FROM cache
    WHERE cached_at + INTERVAL 2 DAY > TIMESTAMP '2024-01-20 00:00:00' AND cached_at <= TIMESTAMP '2024-01-20 00:00:00'""",
)
def k02(spark, sf):
    at = F.lit("2024-01-20 00:00:00").cast("timestamp")
    return ca.fresh(decisions(spark, sf).where(F.col("cached_at") <= at), at, ttl=2 * 86_400).select(
        "res_id", "permission", "sub_id", "checked_at"
    )


@query(
    "k03_subject_lists",
    f"""WITH {GRAPH_SQL}, names AS (
      SELECT DISTINCT res_type, res_id, relation,
        sub_type||':'||sub_id||CASE sub_rel WHEN '' THEN '' ELSE '#'||sub_rel END AS subject FROM tup),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY res_type, res_id, relation ORDER BY subject) - 1 AS place,
        count(*) OVER (PARTITION BY res_type, res_id, relation) AS n FROM names)
    SELECT res_type, res_id, relation, place // 3 AS page, (n + 2) // 3 AS pages, string_agg(subject, ',' ORDER BY subject) AS subjects
    FROM ranked GROUP BY ALL""",
)
def k03(spark, sf):
    pages = ca.subjects_list(graph(spark, sf), page=3)
    return pages.select("res_type", "res_id", "relation", "page", "pages", F.concat_ws(",", "subjects").alias("subjects"))


@query(
    "k04_invalidate_relationship",
    f"""WITH {CACHE_SQL}, hit AS (SELECT DISTINCT 'w'||user_id AS res_id FROM events WHERE event_type = 'error' AND value > 100)
    SELECT res_id, permission, sub_id, checked_at, 'decision' AS kind FROM cache WHERE res_id NOT IN (SELECT res_id FROM hit)
    UNION ALL SELECT res_id, permission, '', 0, 'list' FROM (SELECT DISTINCT res_id, permission FROM cache)
    WHERE NOT (permission = 'click' AND res_id IN (SELECT res_id FROM hit))""",
)
def k04(spark, sf):
    d = decisions(spark, sf)
    hit = d.where("permission = 'error'").join(
        events(spark, sf).where("value > 100").select(F.col("event_id").alias("checked_at")), "checked_at", "left_semi"
    ).select("res_type", "res_id", F.lit("click").alias("relation"))
    lists = d.select("res_type", "res_id", F.col("permission").alias("relation")).distinct()
    left = ca.invalidate_rel(d, hit).select("res_id", "permission", "sub_id", "checked_at", F.lit("decision").alias("kind"))
    return left.unionByName(
        ca.invalidate_lists(lists, hit).select(
            "res_id", F.col("relation").alias("permission"), F.lit("").alias("sub_id"),
            F.lit(0).cast("long").alias("checked_at"), F.lit("list").alias("kind"),
        )
    )


@query(
    "k05_invalidate_schema",
    """WITH c AS (SELECT event_type AS res_type, 'w'||user_id AS res_id FROM events)
    SELECT res_type, res_id, 'decision' AS kind FROM c WHERE res_type NOT IN ('error', 'view')
    UNION ALL SELECT DISTINCT res_type, '', 'schema' FROM c WHERE res_type NOT IN ('error', 'view')""",
)
def k05(spark, sf):
    d = decisions(spark, sf).select(F.col("permission").alias("res_type"), "res_id")
    changed = d.where("res_type in ('error', 'view')")
    left, schemas = ca.invalidate_schema(d, d.select("res_type").distinct(), changed)
    return left.withColumn("kind", F.lit("decision")).unionByName(
        schemas.select("res_type", F.lit("").alias("res_id"), F.lit("schema").alias("kind"))
    )


@query(
    "k06_invalidate_transitive",
    """SELECT 'o'||o_orderkey AS res_id, 'view' AS permission FROM orders JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey WHERE NOT (c_acctbal < 0 OR n_nationkey = 3)""",
)
def k06(spark, sf):
    d = devices(spark, sf).select(F.lit(HOST).alias("res_type"), F.col("id").alias("res_id"), F.lit("view").alias("permission"))
    poor = table(spark, sf, "customer").where("c_acctbal < 0").select(F.lit(WS).alias("res_type"), tag("c", "c_custkey").alias("res_id"))
    land = table(spark, sf, "nation").where("n_nationkey = 3").select(F.lit(WS).alias("res_type"), tag("n", "n_nationkey").alias("res_id"))
    return ca.invalidate_transitive(d, poor.unionByName(land), graph(spark, sf)).select("res_id", "permission")


@query(
    "k07_cache_stats",
    """SELECT event_type, count(CASE WHEN value > 20 THEN 1 END) AS hits, count(CASE WHEN value <= 20 THEN 1 END) AS misses,
    count(*) AS total, round(100.0 * count(CASE WHEN value > 20 THEN 1 END) / count(*), 2) AS hit_rate FROM events GROUP BY ALL""",
)
def k07(spark, sf):
    return ca.cache_stats(events(spark, sf).select("event_type", (F.col("value") > 20).alias("hit")), ["event_type"])
