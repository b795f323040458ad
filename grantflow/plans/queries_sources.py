"""Decoding, routing, sinks, filters and validation over data derived from the given tables."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import band, split_type, state_of, tuple_string
from ..model import SCHEMA_IMAGE
from ..operators import select as se
from ..session import cut_table, literal_table, shared_folder
from ..sources import cdc, directory, metrics, sinks
from ..sources.tuples import parse_tuple_text, read_tuples_nested, read_tuples_text
from ..streaming.jobs import read_event_stream
from .catalog import query
from .derived import (
    COUNTER_SQL, ENVELOPE_SQL, GRAPH_SQL, GROUP, counter_samples, devices, envelope_json, events, flat_json, graph,
    op_code, table,
)

TUP = "res_type, res_id, relation, sub_type, sub_id, sub_rel"
EV_SQL = "(SELECT *, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events)"
OP_SQL = (
    "CASE event_type WHEN 'signup' THEN 'c' WHEN 'view' THEN 'r' WHEN 'error' THEN 'd' "
    "WHEN 'click' THEN 'u' WHEN 'purchase' THEN 'u' END"
)


def tag(prefix, col):
    return F.concat(F.lit(prefix), F.col(col).cast("string"))


def run_stream(df: DataFrame) -> DataFrame:
    """Run a stream to the end of its input into a table of the shared folder and read that table."""
    root = f"{shared_folder(df.sparkSession)}/stream-{uuid.uuid4().hex}"
    q = (
        df.writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/state")
        .outputMode("append").trigger(availableNow=True).start()
    )
    q.awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(f"{root}/out")


@query(
    "s01_tuples_from_text",
    f"""WITH {GRAPH_SQL}, x AS (SELECT *, res_type = 'rbac/group' AND sub_rel = '' AND s_acctbal < 0 AS bad FROM tup
    LEFT JOIN supplier ON res_type = 'rbac/group' AND sub_id = 'u'||s_suppkey)
    SELECT res_type, res_id, relation, CASE WHEN bad THEN '' ELSE sub_type END AS sub_type,
    CASE WHEN bad THEN '' ELSE sub_id END AS sub_id, sub_rel, NOT coalesce(bad, false) AS valid FROM x""",
)
def s01(spark, sf):
    # Members with a negative balance come without a type, which must be flagged.
    poor = table(spark, sf, "supplier").where("s_acctbal < 0").select(
        tag("u", "s_suppkey").alias("sub_id"), F.lit(GROUP).alias("res_type"), F.lit(True).alias("bare")
    )
    g = graph(spark, sf).join(poor, ["sub_id", "res_type"], "left")
    full = F.concat_ws(":", "sub_type", "sub_id")
    text = g.select(
        F.concat_ws(":", "res_type", "res_id").alias("resource"), "relation",
        F.when(F.col("bare"), F.col("sub_id"))
        .when(F.col("sub_rel") != "", F.concat_ws("#", full, F.col("sub_rel"))).otherwise(full).alias("subject"),
    )
    return parse_tuple_text(text)


@query(
    "s01_tuples_read",
    f"""WITH {GRAPH_SQL} SELECT {TUP} FROM tup LEFT JOIN supplier ON res_type = 'rbac/group' AND sub_id = 'u'||s_suppkey
    WHERE NOT coalesce(res_type = 'rbac/group' AND sub_rel = '' AND s_acctbal < 0, false)""",
)
def s01b(spark, sf):
    """The same texts written as JSON Lines and read back; malformed ones are left out."""
    poor = table(spark, sf, "supplier").where("s_acctbal < 0").select(
        tag("u", "s_suppkey").alias("sub_id"), F.lit(GROUP).alias("res_type"), F.lit(True).alias("bare")
    )
    full = F.concat_ws(":", "sub_type", "sub_id")
    text = graph(spark, sf).join(poor, ["sub_id", "res_type"], "left").select(
        F.concat_ws(":", "res_type", "res_id").alias("resource"), "relation",
        F.when(F.col("sub_rel") != "", F.concat_ws("#", full, F.col("sub_rel"))).when(F.col("bare"), F.col("sub_id"))
        .otherwise(full).alias("subject"),
    )
    path = f"{shared_folder(spark)}/tuples-{uuid.uuid4().hex}"
    text.write.json(path)
    return read_tuples_text(spark, path, lines=True)


@query("s02_tuples_from_nested", f"WITH {GRAPH_SQL} SELECT {TUP} FROM tup")
def s02(spark, sf):
    def obj(kind, id_):
        t = split_type(F.col(kind))
        return F.struct(F.struct(t["ns"].alias("namespace"), t["name"].alias("name")).alias("type"), F.col(id_).alias("id"))

    one = F.struct(
        obj("res_type", "res_id").alias("resource"), F.col("relation").alias("relation"),
        F.struct(
            obj("sub_type", "sub_id").alias("subject"),
            F.when(F.col("sub_rel") != "", F.col("sub_rel")).alias("relation"),
        ).alias("subject"),
    )
    return read_tuples_nested(graph(spark, sf).select(F.to_json(F.struct(F.array(one).alias("tuples"))).alias("value")))


FLAT_SQL = f"""
flat AS (
  SELECT event_id AS key, 'w'||user_id AS id, 't'||(k % 5) AS tenant_id, {OP_SQL} AS op,
         CASE event_type WHEN 'view' THEN 'roles' ELSE 'workspaces' END AS tbl, event_id AS lsn,
         epoch_us(ts) // 1000 AS source_ms, event_type = 'error' AS deleted, event_type = 'purchase' AND value > 200 AS bad
  FROM {EV_SQL}
)"""


@query(
    "s03_decode_flat_changes",
    f"""WITH {FLAT_SQL} SELECT key, CASE WHEN bad THEN 'bad' ELSE 'good' END AS status,
    CASE WHEN NOT bad THEN id END AS id, CASE WHEN NOT bad THEN tenant_id END AS tenant_id,
    CASE WHEN NOT bad THEN op END AS op, CASE WHEN NOT bad THEN tbl END AS "table",
    CASE WHEN NOT bad THEN lsn END AS lsn, CASE WHEN NOT bad THEN source_ms END AS source_ms,
    CASE WHEN NOT bad THEN deleted END AS deleted FROM flat""",
)
def s03(spark, sf):
    good, bad = cdc.decode_flat_cdc(flat_json(spark, sf))
    cols = ["key", "id", "tenant_id", "op", "table", "lsn", "source_ms", "deleted"]
    return good.select(*cols, F.lit("good").alias("status")).unionByName(
        bad.select("key", F.lit("bad").alias("status")), allowMissingColumns=True
    )


@query(
    "s04_decode_envelope",
    f"""WITH {ENVELOPE_SQL} SELECT key, namespace, object_id, relation, userset_namespace, userset_object_id,
    userset_relation, CAST(created_xid AS VARCHAR) AS created_xid, '9223372036854775807' AS deleted_xid, op, operation,
    ts_ms FROM env""",
)
def s04(spark, sf):
    return cdc.decode_envelope(envelope_json(spark, sf))


@query(
    "s05_unwrap_change",
    f"""SELECT 'w'||user_id AS id, k AS tenant, {OP_SQL} AS __op, 'workspaces' AS __table, event_id AS __lsn,
    epoch_us(ts) // 1000 AS __source_ts_ms, CASE event_type WHEN 'error' THEN 'true' ELSE 'false' END AS __deleted
    FROM {EV_SQL}""",
)
def s05(spark, sf):
    ev = events(spark, sf)
    image = F.struct(tag("w", "user_id").alias("id"), F.col("k").alias("tenant"))
    record = ev.select(
        F.when(op_code().isin("u", "d"), image).alias("before"), F.when(op_code() != "d", image).alias("after"),
        op_code().alias("op"),
        F.struct(F.lit("workspaces").alias("table"), F.col("event_id").alias("lsn"), F.unix_millis("ts").alias("ts_ms"))
        .alias("source"),
    )
    return cdc.unwrap_cdc(record, ["id", "tenant"])


@query(
    "s06_topic_rename",
    r"""WITH t AS (SELECT 'inv.'||n_regionkey||'.'||c_name AS topic FROM customer JOIN nation ON c_nationkey = n_nationkey
    UNION ALL SELECT c_name||'.x' FROM customer)
    SELECT topic, regexp_replace(topic, '^([^.]+)\.([^.]+)\.([^.]+)$', '\1.\3.events') AS routed FROM t""",
)
def s06(spark, sf):
    c, n = table(spark, sf, "customer"), table(spark, sf, "nation")
    topics = c.join(n, c.c_nationkey == n.n_nationkey).select(
        F.concat(F.lit("inv."), "n_regionkey", F.lit("."), "c_name").alias("topic")
    ).unionByName(c.select(F.concat("c_name", F.lit(".x")).alias("topic")))
    return topics.withColumn("routed", cdc.route_regex(F.col("topic")))


def outbox(spark, sf):
    """Device outbox rows: an insert per order, and the delete of the same row that follows it."""
    payload = F.to_json(
        F.struct(
            F.lit("edge/device").alias("type"), "id", "display_name", "workspace_id", "reporter", "org_id",
            F.when(F.col("reporter") == "F", "deleted").otherwise("created").alias("operation"),
        )
    )
    rows = devices(spark, sf).select(
        F.concat(F.lit("m"), "id").alias("id"), F.lit("devices").alias("aggregatetype"), F.col("id").alias("aggregateid"),
        F.when(F.col("reporter") == "F", "DeleteResource").otherwise("ReportResource").alias("type"),
        payload.alias("payload"), F.when(F.col("reporter") == "F", "deleted").otherwise("created").alias("operation"),
        F.lit("v1beta2").alias("version"),
    )
    return rows.withColumn("op", F.explode(F.array(F.lit("c"), F.lit("d"))))


@query(
    "s07_outbox_router",
    """SELECT 'mo'||o_orderkey AS event_id, 'outbox.event.edge.devices' AS topic, 'o'||o_orderkey AS key,
    CASE o_orderstatus WHEN 'F' THEN 'DeleteResource' ELSE 'ReportResource' END AS event_type,
    'c'||o_custkey AS workspace_id, CASE o_orderstatus WHEN 'F' THEN 'deleted' ELSE 'created' END AS operation,
    'v1beta2' AS version FROM orders""",
)
def s07(spark, sf):
    """Outbox messages written by topic, once more as after a failure, and read back."""
    path = f"{shared_folder(spark)}/topics-{uuid.uuid4().hex}"
    for _ in range(2):
        sinks.write_by_topic(cdc.route_outbox(outbox(spark, sf), "edge"), path, 0)
    return spark.read.parquet(path).select(
        "event_id", "topic", "key", "event_type", F.col("payload")["workspace_id"].alias("workspace_id"),
        F.col("headers")["operation"].alias("operation"), F.col("headers")["version"].alias("version"),
    )


@query(
    "s08_resource_payload",
    """SELECT 'o'||o_orderkey AS res_id, 'my_service/widget' AS res_type, 'dev '||o_orderpriority AS display_name,
    CASE WHEN o_orderstatus <> 'F' THEN 'c'||o_custkey END AS workspace_id, o_orderstatus AS reporter, 'i1' AS instance
    FROM orders""",
)
def s08(spark, sf):
    body = F.to_json(
        F.struct(
            F.lit("my_service/widget").alias("type"), "id", F.col("display_name").alias("displayName"),
            F.when(F.col("reporter") != "F", F.col("workspace_id")).alias("workspaceId"),
            F.struct(F.col("reporter").alias("type"), F.lit("i1").alias("reporterInstanceId")).alias("reporter"),
        )
    )
    return cdc.parse_resource_event(devices(spark, sf).select(body.alias("payload")))


def operation_events(spark, sf):
    header = (
        F.when(F.col("event_type") == "signup", "created").when(F.col("event_type") == "error", "deleted")
        .when(F.col("event_type") == "click", "").when(F.col("event_type") == "purchase", "bogus")
    )
    return events(spark, sf).select(
        "event_id", tag("d", "user_id").alias("id"), tag("w", "k").alias("workspace_id"), header.alias("header"),
        F.when(F.col("k") > 60, "updated").when(F.col("k") > 30, "").alias("payload_operation"),
    )


OPERATION_SQL = f"""
opev AS (
  SELECT event_id, 'd'||user_id AS id, 'w'||k AS workspace_id,
    CASE event_type WHEN 'signup' THEN 'created' WHEN 'error' THEN 'deleted'
      ELSE CASE WHEN event_type = 'purchase' THEN 'bogus' WHEN k > 60 THEN 'updated' ELSE 'created' END END AS resolved
  FROM {EV_SQL}
)"""


@query("s09_resolve_operation", f"WITH {OPERATION_SQL} SELECT event_id, resolved FROM opev WHERE resolved <> 'bogus'")
def s09(spark, sf):
    return cdc.resolve_operation(operation_events(spark, sf)).select("event_id", "resolved")


def nested_principals(spark, sf):
    """Customers as principals: one group from the nation, one role from the segment, both nested."""
    ref = lambda name, id_: F.array(F.struct(name.alias("name"), id_.alias("uuid")))
    return table(spark, sf, "customer").select(
        F.col("c_name").alias("username"), F.col("c_mktsegment").alias("org_id"),
        (F.col("c_acctbal") > 9000).alias("is_org_admin"),
        ref(tag("group ", "c_nationkey"), tag("g", "c_nationkey")).alias("groups"),
        F.when(F.col("c_acctbal") > 0, ref(F.col("c_mktsegment"), F.lower("c_mktsegment"))).alias("roles"),
    )


@query(
    "s10_principal_directory",
    """SELECT 'membership' AS kind, c_name AS name, 'g'||c_nationkey AS ref, 'group '||c_nationkey AS detail FROM customer
    UNION ALL SELECT 'assignment', c_name, lower(c_mktsegment), c_mktsegment FROM customer WHERE c_acctbal > 0
    UNION ALL SELECT 'principals', c_name, c_mktsegment, CASE WHEN c_acctbal > 9000 THEN 'true' ELSE 'false' END FROM customer
    UNION ALL SELECT 'groups', 'group '||n_nationkey, 'g'||n_nationkey, CASE WHEN n_regionkey = 0 THEN 'true' ELSE 'false' END FROM nation
    UNION ALL SELECT 'roles', p_name, 'r'||p_partkey, p_brand FROM part
    UNION ALL SELECT 'role_permissions', p_name, 'r'||p_partkey, unnest([p_type||':*:read', p_type||':'||p_brand||':write']) FROM part WHERE p_size > 5""",
)
def s10(spark, sf):
    """Directory documents written as JSON Lines, read back, and flattened to all six tables."""
    path = f"{shared_folder(spark)}/directory-{uuid.uuid4().hex}"
    people = nested_principals(spark, sf).select(F.array(F.struct("*")).alias("principals"))
    groups = table(spark, sf, "nation").select(F.array(F.struct(
        tag("g", "n_nationkey").alias("uuid"), tag("group ", "n_nationkey").alias("name"), (F.col("n_regionkey") == 0).alias("platform_default"),
    )).alias("groups"))
    granted = F.array(F.concat("p_type", F.lit(":*:read")), F.concat_ws(":", "p_type", "p_brand", F.lit("write")))
    roles = table(spark, sf, "part").select(F.array(F.struct(
        tag("r", "p_partkey").alias("uuid"), F.col("p_name").alias("name"), F.col("p_brand").alias("description"),
        F.when(F.col("p_size") > 5, granted).alias("permissions"),
    )).alias("roles"))
    people.unionByName(groups, allowMissingColumns=True).unionByName(roles, allowMissingColumns=True).write.json(path)
    flat = directory.flatten_directory(directory.read_directory(spark, path, lines=True))

    def rows(kind, name, ref, detail):
        return flat[kind].select(F.lit(kind).alias("kind"), F.col(name).alias("name"), F.col(ref).alias("ref"), F.col(detail).cast("string").alias("detail"))

    return reduce(DataFrame.unionByName, [
        rows("membership", "username", "group_uuid", "group_name"), rows("assignment", "username", "role_uuid", "role_name"),
        rows("principals", "username", "org_id", "is_org_admin"), rows("groups", "name", "uuid", "platform_default"),
        rows("roles", "name", "uuid", "description"), rows("role_permissions", "role_name", "role_uuid", "permission"),
    ])


@query(
    "s11_role_config",
    """SELECT p_name||p_partkey AS role, p_size > 25 AS system, p_size < 5 AS platform_default, p_size = 50 AS admin_default,
    CAST(p_size AS INTEGER) AS version, unnest([lower(p_type)||':'||p_brand||':read', lower(p_type)||':*:*']) AS permission FROM part
    WHERE p_size > 1
    UNION ALL SELECT p_name||p_partkey, false, true, false, 1, NULL FROM part WHERE p_size = 1""",
)
def s11(spark, sf):
    low = F.lower("p_type")
    access = F.when(
        F.col("p_size") > 1,
        F.array(
            F.struct(F.concat(low, F.lit(":"), "p_brand", F.lit(":read")).alias("permission")),
            F.struct(F.concat(low, F.lit(":*:*")).alias("permission")),
        ),
    )
    doc = table(spark, sf, "part").select(
        F.array(
            F.struct(
                F.concat("p_name", "p_partkey").alias("name"), (F.col("p_size") > 25).alias("system"),
                (F.col("p_size") < 5).alias("platform_default"), (F.col("p_size") == 50).alias("admin_default"),
                F.col("p_size").cast("int").alias("version"), access.alias("access"),
            )
        ).alias("roles")
    )
    return directory.flatten_role_config(doc)


@query(
    "s11_permission_config",
    """SELECT 'app'||p_partkey AS app, p_type AS resource, 'read' AS verb, NULL AS requires FROM part
    UNION ALL SELECT 'app'||p_partkey, p_type, 'write', 'read' FROM part""",
)
def s11b(spark, sf):
    verbs = F.array(
        F.struct(F.lit("read").alias("verb"), F.lit(None).cast("array<string>").alias("requires")),
        F.struct(F.lit("write").alias("verb"), F.array(F.lit("read")).alias("requires")),
    )
    doc = F.concat(
        F.lit('{"_comment": "text", "'), F.col("p_type"), F.lit('": '), F.to_json(verbs), F.lit("}")
    )
    return directory.flatten_permission_config(table(spark, sf, "part").select(tag("app", "p_partkey").alias("app"), doc.alias("value")))


@query(
    "s12_metric_samples",
    """SELECT 'load' AS name, event_type AS method, 'u'||user_id AS "user", epoch_us(ts) AS at_us, value FROM events""",
)
def s12(spark, sf):
    ev = events(spark, sf).select(F.col("event_type").alias("method"), tag("u", "user_id").alias("user"), "ts", "value")
    path = f"{shared_folder(spark)}/samples-{uuid.uuid4().hex}"
    metrics.to_samples(ev, "load", ["method", "user"]).write.parquet(path)
    return metrics.read_samples(spark, path).select(
        "name", F.col("labels")["method"].alias("method"), F.col("labels")["user"].alias("user"),
        F.unix_micros("ts").alias("at_us"), "value",
    )


HEALTH_SQL = """
up AS (
  SELECT event_type AS job, 'u'||user_id AS instance, ts, event_id,
         CASE WHEN event_type IN ('signup', 'click') THEN 1.0 WHEN event_type = 'purchase' AND value < 20 THEN 1.0
              ELSE 0.0 END AS value FROM events
)"""


def health_observations(spark, sf):
    status = (
        F.when(F.col("event_type") == "signup", 200).when(F.col("event_type") == "click", 399)
        .when(F.col("event_type") == "error", 500)
        .when(F.col("event_type") == "purchase", F.when(F.col("value") < 20, 302).otherwise(400))
    )
    return events(spark, sf).select(F.col("event_type").alias("job"), "ts", status.alias("status"))


@query("s13_health_to_up", f"WITH {HEALTH_SQL} SELECT job, epoch_us(ts) AS at_us, CAST(value AS DOUBLE) AS value FROM up")
def s13(spark, sf):
    return metrics.health_to_up(health_observations(spark, sf)).select(
        F.col("labels")["job"].alias("job"), F.unix_micros("ts").alias("at_us"), "value"
    )


def messages(spark, sf):
    """The change log as messages with topic, partition, offset, time and headers."""
    return flat_json(spark, sf, "ts", "event_type", "user_id").select(
        F.when(F.col("event_type") == "view", "roles.events").otherwise("workspaces.events").alias("topic"),
        (F.col("user_id") % 3).cast("int").alias("partition"), F.col("key").alias("offset"),
        F.col("ts").alias("timestamp"), F.col("key").cast("string").alias("key"), "value",
        F.create_map(F.lit("kind"), F.col("event_type")).alias("headers"),
    )


@query(
    "s14_event_stream",
    """SELECT CASE event_type WHEN 'view' THEN 'roles.events' ELSE 'workspaces.events' END AS topic,
    CAST(user_id % 3 AS INTEGER) AS partition, event_id AS "offset", epoch_us(ts) AS at_us, event_type AS kind FROM events""",
)
def s14(spark, sf):
    stream = read_event_stream(spark, cut_table(messages(spark, sf)).path)
    return run_stream(
        stream.select("topic", "partition", "offset", F.unix_micros("timestamp").alias("at_us"), F.col("headers")["kind"].alias("kind"))
    )


@query(
    "s15_dead_letters",
    f"""WITH {FLAT_SQL} SELECT key, CASE WHEN bad THEN 'malformed' WHEN tbl = 'roles' THEN 'unhandled table' END AS error
    FROM flat""",
)
def s15(spark, sf):
    table_name = F.get_json_object("value", "$.__table")
    error = F.when(~F.col("value").endswith("}"), "malformed").when(table_name == "roles", "unhandled table")
    good, dead = sinks.split_dlq(flat_json(spark, sf), error)
    return good.select("key", F.lit(None).cast("string").alias("error")).unionByName(dead.select("key", "error"))


@query(
    "s16_audit_log",
    f"""WITH {ENVELOPE_SQL} SELECT operation AS action, namespace||':'||object_id AS resource, relation,
    userset_namespace||':'||userset_object_id AS subject, ts_ms AS time_ms,
    strftime(make_timestamp(ts_ms * 1000), '%Y-%m-%d') AS day FROM env""",
)
def s16(spark, sf):
    """Audit rows written by day, a half twice as after a failure, and read back."""
    rows, path = sinks.audit_log(cdc.decode_envelope(envelope_json(spark, sf))), f"{shared_folder(spark)}/audit-{uuid.uuid4().hex}"
    half = F.pmod(F.xxhash64("resource"), F.lit(2))
    for batch_id in (0, 1, 1):
        sinks.write_audit(rows.where(half == batch_id), path, batch_id)
    return sinks.read_batches(rows, path)


@query(
    "s17_search_index",
    f"""WITH {ENVELOPE_SQL} SELECT namespace||':'||object_id||':'||relation AS doc_id,
    arg_max(userset_namespace, key) AS userset_namespace, arg_max(userset_object_id, key) AS userset_object_id,
    arg_max(userset_relation, key) AS userset_relation, arg_max(operation, key) AS operation, max(key) AS lsn
    FROM env GROUP BY ALL""",
)
def s17(spark, sf):
    return sinks.search_index_view(cdc.decode_envelope(envelope_json(spark, sf)).withColumn("lsn", F.col("key")))


@query(
    "p01_split_type",
    """SELECT 'my/'||p_type AS t, 'my' AS ns, p_type AS name, count(*) AS n FROM part GROUP BY ALL
    UNION ALL SELECT p_type, p_type, p_type, count(*) FROM part GROUP BY ALL
    UNION ALL SELECT 'a/'||p_type||'/b', 'a', p_type||'/b', count(*) FROM part GROUP BY ALL""",
)
def p01(spark, sf):
    forms = F.array(F.concat(F.lit("my/"), "p_type"), F.col("p_type"), F.concat(F.lit("a/"), "p_type", F.lit("/b")))
    t = table(spark, sf, "part").select(F.explode(forms).alias("t"))
    return t.select("t", split_type(F.col("t")).alias("s")).groupBy("t", "s.ns", "s.name").agg(F.count("*").alias("n"))


@query(
    "p02_tuple_string",
    f"""WITH {GRAPH_SQL} SELECT res_type||':'||res_id||'#'||relation||'@'||sub_type||':'||sub_id||
    CASE WHEN sub_rel = '' THEN '' ELSE '#'||sub_rel END AS text FROM tup""",
)
def p02(spark, sf):
    return graph(spark, sf).select(tuple_string().alias("text"))


@query(
    "p03_read_relationships",
    f"WITH {GRAPH_SQL} SELECT {TUP} FROM tup WHERE res_type = 'rbac/group' AND relation = 't_member' "
    "AND sub_type LIKE 'rbac/%' AND sub_rel = ''",
)
def p03(spark, sf):
    return se.read_relationships(
        graph(spark, sf), resource_namespace="rbac", resource_type="group", relation="t_member",
        subject_namespace="rbac", subject_relation="",
    )


@query(
    "p04_list_resources",
    "SELECT 'o'||o_orderkey AS id, 'c'||o_custkey AS workspace_id FROM orders "
    "WHERE o_orderstatus = 'P' AND o_orderpriority = '5-LOW'",
)
def p04(spark, sf):
    return se.list_resources(devices(spark, sf), reporter="P", display_name="dev 5-LOW").select("id", "workspace_id")


@query(
    "p05_list_recent",
    "SELECT 'o'||o_orderkey AS id, epoch_ms(o_orderdate) AS at_ms FROM orders ORDER BY o_orderdate DESC, id LIMIT 50",
)
def p05(spark, sf):
    return se.list_recent(devices(spark, sf), 50).select("id", F.unix_millis("created_at").alias("at_ms"))


@query("p06_get_by_id", "SELECT 'o'||o_orderkey AS id, o_orderstatus AS reporter FROM orders WHERE o_orderkey = 77")
def p06(spark, sf):
    return se.get_by_id(devices(spark, sf), "o77").select("id", "reporter")


@query(
    "p07_required_fields",
    f"""WITH x AS (SELECT CASE WHEN k > 90 THEN '' ELSE 'w'||user_id END AS id,
      CASE WHEN k % 7 > 0 THEN 't'||k END AS tenant FROM {EV_SQL})
    SELECT 'id_missing' AS error, count(*) AS rows FROM x WHERE id = ''
    UNION ALL SELECT 'tenant_missing', count(*) FROM x WHERE tenant IS NULL""",
)
def p07(spark, sf):
    rows = events(spark, sf).select(
        F.when(F.col("k") > 90, "").otherwise(tag("w", "user_id")).alias("id"),
        F.when(F.col("k") % 7 > 0, tag("t", "k")).alias("tenant"),
    )
    return se.error_counts(se.require_fields(rows, {"id": "id_missing", "tenant": "tenant_missing"}))


@query(
    "p08_validate_resources",
    """WITH x AS (SELECT o_orderkey, o_orderstatus AS s, md5(CAST(o_orderkey AS VARCHAR)) AS h FROM orders)
    SELECT 'o'||o_orderkey AS id, s IN ('O', 'P') AND o_orderkey % 4 <> 3 AS valid,
      concat_ws(',', CASE WHEN o_orderkey % 4 = 3 THEN 'satellite_id:oneOf' END, CASE WHEN s = 'F' THEN 'workspace_id:required' END)
      AS errors FROM x""",
)
def p08(spark, sf):
    h = F.md5(F.col("o_orderkey").cast("string"))
    dashed = F.concat_ws(
        "-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4), F.substring(h, 17, 4), F.substring(h, 21, 12)
    )
    kind = F.col("o_orderkey") % 4
    digits = F.lpad(F.col("o_orderkey").cast("string"), 10, "0")
    rows = table(spark, sf, "orders").select(
        tag("o", "o_orderkey").alias("id"),
        F.when(kind == 0, dashed).when(kind == 1, digits).when(kind == 3, F.substring(digits, 1, 9)).alias("satellite_id"),
        dashed.alias("subscription_manager_id"), F.lit(None).cast("string").alias("insights_id"),
        F.col("o_orderpriority").alias("ansible_host"),
        F.when(F.col("o_orderstatus") != "F", tag("c", "o_custkey")).alias("workspace_id"),
    )
    return se.validate_resources(rows, se.HOST_SPEC).select("id", "valid", F.concat_ws(",", "errors").alias("errors"))


@query(
    "p09_registered_reporters",
    """SELECT 'o'||o_orderkey AS id, CASE WHEN o_orderstatus = 'O' THEN 'ns_host' WHEN o_orderstatus = 'P'
    AND o_orderpriority LIKE '1%' THEN 'ns_edge' END AS namespace FROM orders""",
)
def p09(spark, sf):
    registry = literal_table(
        spark, [("any", "O", "ns_host"), ("1-URGENT", "P", "ns_edge")],
        "resource_type string, reporter_name string, namespace string",
    )
    rows = table(spark, sf, "orders").select(
        tag("o", "o_orderkey").alias("id"),
        F.when(F.col("o_orderstatus") == "O", "any").otherwise(F.col("o_orderpriority")).alias("resource_type"),
        F.col("o_orderstatus").alias("reporter_name"),
    )
    ok, rejected = se.check_registered(rows, registry)
    return ok.select("id", "namespace").unionByName(rejected.select("id", F.lit(None).cast("string").alias("namespace")))


@query(
    "p10_label_matchers",
    f"WITH {COUNTER_SQL} SELECT method, code, value FROM counter WHERE method IN ('signup', 'view') AND code = 'OK' "
    "AND method <> 'view'",
)
def p10(spark, sf):
    m = se.match_labels(
        counter_samples(spark, sf), [("method", "=~", "sign.*|view"), ("code", "=", "OK"), ("method", "!=", "view")]
    )
    return m.select(F.col("labels")["method"].alias("method"), F.col("labels")["code"].alias("code"), "value")


@query(
    "p11_relabel",
    f"WITH {COUNTER_SQL} SELECT method AS job, code, CAST(NULL AS VARCHAR) AS method, value FROM counter WHERE code = 'OK'",
)
def p11(spark, sf):
    out = se.relabel(
        counter_samples(spark, sf),
        [
            {"action": "keep", "source": "__name__", "regex": "requests_.*|jobs_.*"},
            {"action": "keep", "source": "code", "regex": "O."},
            {"action": "copy", "source": "method", "target": "job"},
            {"action": "drop", "regex": "method"},
        ],
    )
    return out.select(*[F.col("labels")[c].alias(c) for c in ("job", "code", "method")], "value")


@query(
    "p12_state_and_band",
    """SELECT event_id, CASE WHEN event_type = 'error' THEN 'DOWN' ELSE 'UP' END AS state,
    CASE WHEN value >= 85 THEN 'green' WHEN value >= 70 THEN 'yellow' ELSE 'red' END AS band FROM events""",
)
def p12(spark, sf):
    up = F.when(F.col("event_type") == "error", 0).otherwise(1)
    return events(spark, sf).select(
        "event_id", state_of(up).alias("state"),
        band(F.col("value"), [(None, "red"), (70, "yellow"), (85, "green")]).alias("band"),
    )


def schema_envelope(spark, sf):
    """Schema changes in before/after form: the definition is long for some namespaces and no JSON for others."""
    ev = events(spark, sf)
    config = F.when(F.col("value") > 100, F.concat(F.lit("raw "), "props")).otherwise(
        F.to_json(F.struct(F.repeat(F.concat(F.lit("def "), "event_type", F.lit(" ")), 20).alias("definition")))
    )
    image = F.struct(
        tag("ns", "user_id").alias("namespace"), config.alias("serialized_config"),
        F.col("event_id").cast("string").alias("created_xid"),
    )
    body = F.to_json(
        F.struct(F.when(op_code() == "d", image).alias("before"), F.when(op_code() != "d", image).alias("after"),
                 op_code().alias("op"), F.unix_millis("ts").alias("ts_ms"))
    )
    return cdc.decode_envelope(ev.select(body.alias("value")), SCHEMA_IMAGE)
