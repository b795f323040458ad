"""Relationship graph, change log, metrics and cache derived from the given tables, in Spark and in SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ordered import sized_chunks, with_running
from ..model import TUPLE_COLS
from ..session import literal_table

DAY = 86_400


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _lit(text):
    return F.lit(text) if isinstance(text, str) else text


def _tag(prefix: str, col: str):
    return F.concat(F.lit(prefix), F.col(col).cast("string"))


def _rows(df, res_type, res_id, relation, sub_type, sub_id, sub_rel=""):
    return df.select(
        *[
            _lit(v).alias(c)
            for c, v in zip(TUPLE_COLS, (res_type, res_id, relation, sub_type, sub_id, sub_rel), strict=True)
        ]
    )


WS, TENANT, HOST, GROUP = "rbac/workspace", "rbac/tenant", "hbi/host", "rbac/group"
BINDING, ROLE, USER, PLATFORM = "rbac/role_binding", "rbac/role", "rbac/principal", "rbac/platform"

CONSTANT_TUPLES = [
    (PLATFORM, "p0", "t_binding", BINDING, "bp", ""),
    (BINDING, "bp", "t_subject", USER, "u1", ""),
    (BINDING, "bp", "t_role", ROLE, "viewer", ""),
    (ROLE, "viewer", "t_inventory_hosts_read", USER, "*", ""),
    (ROLE, "editor", "t_inventory_hosts_write", USER, "*", ""),
    (ROLE, "patcher", "t_patch_system_read", USER, "*", ""),
    (ROLE, "admin", "t_child", ROLE, "viewer", ""),
    (ROLE, "admin", "t_child", ROLE, "editor", ""),
]


def graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All relationship tuples of the derived graph."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    customer, orders = table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders")
    supplier = table(spark, sf_dir, "supplier")
    role = F.when(F.col("r_regionkey") % 2 == 0, "admin").otherwise("patcher")
    parts = [
        _rows(nation, WS, _tag("n", "n_nationkey"), "t_parent", TENANT, _tag("t", "n_regionkey")),
        _rows(customer, WS, _tag("c", "c_custkey"), "t_parent", WS, _tag("n", "c_nationkey")),
        _rows(orders, HOST, _tag("o", "o_orderkey"), "t_workspace", WS, _tag("c", "o_custkey")),
        _rows(supplier, GROUP, _tag("gn", "s_nationkey"), "t_member", USER, _tag("u", "s_suppkey")),
        _rows(nation, GROUP, _tag("gr", "n_regionkey"), "t_member", GROUP, _tag("gn", "n_nationkey"), "member"),
        _rows(nation, BINDING, _tag("bn", "n_nationkey"), "t_subject", GROUP, _tag("gn", "n_nationkey"), "member"),
        _rows(nation, BINDING, _tag("bn", "n_nationkey"), "t_role", ROLE, "viewer"),
        _rows(nation, WS, _tag("n", "n_nationkey"), "t_binding", BINDING, _tag("bn", "n_nationkey")),
        _rows(region, BINDING, _tag("bt", "r_regionkey"), "t_subject", GROUP, _tag("gr", "r_regionkey"), "member"),
        _rows(region, BINDING, _tag("bt", "r_regionkey"), "t_role", ROLE, role),
        _rows(region, TENANT, _tag("t", "r_regionkey"), "t_binding", BINDING, _tag("bt", "r_regionkey")),
        _rows(region, TENANT, _tag("t", "r_regionkey"), "t_platform", PLATFORM, "p0"),
        literal_table(spark, CONSTANT_TUPLES, ", ".join(f"{c} string" for c in TUPLE_COLS)),
    ]
    return reduce(DataFrame.unionByName, parts)


_CONST_SQL = " UNION ALL ".join("SELECT " + ", ".join(f"'{v}'" for v in row) for row in CONSTANT_TUPLES)

# The same tuples in SQL, as the body of a WITH list.
GRAPH_SQL = f"""
tup(res_type, res_id, relation, sub_type, sub_id, sub_rel) AS (
  SELECT 'rbac/workspace', 'n'||n_nationkey, 't_parent', 'rbac/tenant', 't'||n_regionkey, '' FROM nation
  UNION ALL SELECT 'rbac/workspace', 'c'||c_custkey, 't_parent', 'rbac/workspace', 'n'||c_nationkey, '' FROM customer
  UNION ALL SELECT 'hbi/host', 'o'||o_orderkey, 't_workspace', 'rbac/workspace', 'c'||o_custkey, '' FROM orders
  UNION ALL SELECT 'rbac/group', 'gn'||s_nationkey, 't_member', 'rbac/principal', 'u'||s_suppkey, '' FROM supplier
  UNION ALL SELECT 'rbac/group', 'gr'||n_regionkey, 't_member', 'rbac/group', 'gn'||n_nationkey, 'member' FROM nation
  UNION ALL SELECT 'rbac/role_binding', 'bn'||n_nationkey, 't_subject', 'rbac/group', 'gn'||n_nationkey, 'member'
    FROM nation
  UNION ALL SELECT 'rbac/role_binding', 'bn'||n_nationkey, 't_role', 'rbac/role', 'viewer', '' FROM nation
  UNION ALL SELECT 'rbac/workspace', 'n'||n_nationkey, 't_binding', 'rbac/role_binding', 'bn'||n_nationkey, ''
    FROM nation
  UNION ALL SELECT 'rbac/role_binding', 'bt'||r_regionkey, 't_subject', 'rbac/group', 'gr'||r_regionkey, 'member'
    FROM region
  UNION ALL SELECT 'rbac/role_binding', 'bt'||r_regionkey, 't_role', 'rbac/role',
    CASE WHEN r_regionkey % 2 = 0 THEN 'admin' ELSE 'patcher' END, '' FROM region
  UNION ALL SELECT 'rbac/tenant', 't'||r_regionkey, 't_binding', 'rbac/role_binding', 'bt'||r_regionkey, '' FROM region
  UNION ALL SELECT 'rbac/tenant', 't'||r_regionkey, 't_platform', 'rbac/platform', 'p0', '' FROM region
  UNION ALL {_CONST_SQL}
)"""

# Members of groups, ancestors of scopes, permissions of roles, grants at scopes: recursive SQL over ``tup``.
ACCESS_SQL = f"""
{GRAPH_SQL},
member(g, u) AS (
  SELECT res_id, sub_id FROM tup WHERE relation = 't_member' AND sub_rel = ''
  UNION SELECT t.res_id, m.u FROM tup t JOIN member m ON t.sub_id = m.g
  WHERE t.relation = 't_member' AND t.sub_rel = 'member'
),
anc(tp, id, atp, aid, depth) AS (
  SELECT res_type, res_id, sub_type, sub_id, 1 FROM tup WHERE relation IN ('t_parent', 't_platform')
  UNION SELECT a.tp, a.id, t.sub_type, t.sub_id, a.depth + 1 FROM anc a JOIN tup t
  ON t.res_type = a.atp AND t.res_id = a.aid WHERE t.relation IN ('t_parent', 't_platform')
),
subrole(r, c) AS (
  SELECT res_id, sub_id FROM tup WHERE relation = 't_child'
  UNION SELECT s.r, t.sub_id FROM subrole s JOIN tup t ON t.res_id = s.c WHERE t.relation = 't_child'
),
leafmap(leaf, permission) AS (
  VALUES ('t_inventory_hosts_read', 'inventory_host_view'), ('t_inventory_hosts_write', 'inventory_host_update'),
         ('t_patch_system_read', 'patch_system_view_assigned')
),
roleperm AS (
  SELECT t.res_id AS role, l.permission FROM tup t JOIN leafmap l ON t.relation = l.leaf
  WHERE t.res_type = 'rbac/role'
  UNION SELECT s.r, l.permission FROM subrole s JOIN tup t ON t.res_id = s.c AND t.res_type = 'rbac/role'
  JOIN leafmap l ON t.relation = l.leaf
),
bindgrant AS (
  SELECT DISTINCT s.res_id AS binding, p.permission, s.sub_type, s.sub_id, s.sub_rel
  FROM tup s JOIN tup r ON r.res_id = s.res_id AND r.relation = 't_role' JOIN roleperm p ON p.role = r.sub_id
  WHERE s.relation = 't_subject'
),
selfanc AS (
  SELECT DISTINCT tp, id, atp, aid FROM anc
  UNION SELECT DISTINCT res_type, res_id, res_type, res_id FROM tup WHERE relation = 't_binding'
),
scopegrant AS (
  SELECT DISTINCT a.tp, a.id, g.permission, g.sub_type, g.sub_id, g.sub_rel
  FROM selfanc a JOIN tup b ON b.res_type = a.atp AND b.res_id = a.aid AND b.relation = 't_binding'
  JOIN bindgrant g ON g.binding = b.sub_id
),
scopeuser AS (
  SELECT DISTINCT s.tp, s.id, s.permission, coalesce(m.u, s.sub_id) AS u
  FROM scopegrant s LEFT JOIN member m ON s.sub_rel = 'member' AND m.g = s.sub_id
  WHERE s.sub_rel = '' OR m.u IS NOT NULL
)"""


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event rows with ``ts`` as an instant and ``k`` taken from the JSON properties."""
    df = table(spark, sf_dir, "events")
    return df.withColumn("ts", F.col("ts").cast("timestamp")).withColumn(
        "k", F.get_json_object("props", "$.k").cast("long")
    )


OPS = {"signup": "c", "view": "r", "click": "u", "purchase": "u", "error": "d"}


def op_code():
    out = F.lit(None).cast("string")
    for kind, code in OPS.items():
        out = F.when(F.col("event_type") == kind, code).otherwise(out)
    return out


def change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flattened workspace changes ``(lsn, id, tenant_id, op, source_ms)``."""
    return events(spark, sf_dir).select(
        F.col("event_id").alias("lsn"),
        _tag("w", "user_id").alias("id"),
        F.concat(F.lit("t"), (F.col("k") % 5).cast("string")).alias("tenant_id"),
        op_code().alias("op"),
        F.unix_millis("ts").alias("source_ms"),
    )


LOG_SQL = """
log AS (
  SELECT event_id AS lsn, 'w'||user_id AS id,
         't'||(CAST(json_extract(props, '$.k') AS BIGINT) % 5) AS tenant_id,
         CASE event_type WHEN 'signup' THEN 'c' WHEN 'view' THEN 'r' WHEN 'error' THEN 'd'
                         WHEN 'click' THEN 'u' WHEN 'purchase' THEN 'u' END AS op,
         epoch_us(ts) // 1000 AS source_ms
  FROM events
)"""


def flat_json(spark: SparkSession, sf_dir: str, *keep: str) -> DataFrame:
    """The change log as flattened JSON messages ``(key, value)`` with the event columns to ``keep``; purchases with
    value over 200 are cut short."""
    ev = events(spark, sf_dir)
    body = F.to_json(
        F.struct(
            _tag("w", "user_id").alias("id"),
            F.concat(F.lit("ws "), F.col("event_type")).alias("name"),
            F.concat(F.lit("t"), (F.col("k") % 5).cast("string")).alias("tenant_id"),
            F.unix_millis("ts").alias("created_at"),
            op_code().alias("__op"),
            F.when(F.col("event_type") == "view", "roles").otherwise("workspaces").alias("__table"),
            F.col("event_id").alias("__lsn"),
            F.unix_millis("ts").alias("__source_ts_ms"),
            F.when(F.col("event_type") == "error", "true").otherwise("false").alias("__deleted"),
        )
    )
    broken = (F.col("event_type") == "purchase") & (F.col("value") > 200)
    return ev.withColumn("body", body).select(
        F.col("event_id").alias("key"),
        F.when(broken, F.substring("body", 1, 40)).otherwise(F.col("body")).alias("value"), *keep,
    )


def envelope_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Relationship changes in before/after form ``(key, value)``."""
    ev = events(spark, sf_dir)
    image = F.struct(
        F.when(F.col("event_type") == "signup", "organization").otherwise("workspace").alias("namespace"),
        _tag("w", "user_id").alias("object_id"),
        F.when(F.col("k") % 2 == 0, "admin").otherwise("member").alias("relation"),
        F.lit("user").alias("userset_namespace"),
        _tag("u", "k").alias("userset_object_id"),
        F.when(F.col("k") % 10 == 0, "member").otherwise("").alias("userset_relation"),
        F.col("event_id").cast("string").alias("created_xid"),
        F.lit("9223372036854775807").alias("deleted_xid"),
    )
    gone = F.col("event_type") == "error"
    body = F.to_json(
        F.struct(
            F.when(gone, image).alias("before"),
            F.when(~gone, image).alias("after"),
            op_code().alias("op"),
            F.unix_millis("ts").alias("ts_ms"),
        )
    )
    return ev.select(F.col("event_id").alias("key"), body.alias("value"))


ENVELOPE_SQL = """
env AS (
  SELECT event_id AS key, CASE event_type WHEN 'signup' THEN 'organization' ELSE 'workspace' END AS namespace,
         'w'||user_id AS object_id, CASE WHEN k % 2 = 0 THEN 'admin' ELSE 'member' END AS relation,
         'user' AS userset_namespace, 'u'||k AS userset_object_id,
         CASE WHEN k % 10 = 0 THEN 'member' ELSE '' END AS userset_relation, event_id AS created_xid,
         CASE event_type WHEN 'signup' THEN 'c' WHEN 'view' THEN 'r' WHEN 'error' THEN 'd' ELSE 'u' END AS op,
         CASE event_type WHEN 'signup' THEN 'CREATE' WHEN 'view' THEN 'READ' WHEN 'error' THEN 'DELETE'
                         ELSE 'UPDATE' END AS operation, epoch_us(ts) // 1000 AS ts_ms
  FROM (SELECT *, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events)
)"""


def relation_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log of tuple writes ``(tuple columns, op, lsn)``: error deletes, everything else touches."""
    ev = events(spark, sf_dir)
    return ev.select(
        F.lit(WS).alias("res_type"), _tag("w", "user_id").alias("res_id"),
        F.when(F.col("k") % 2 == 0, "admin").otherwise("member").alias("relation"),
        F.lit(USER).alias("sub_type"), F.concat(F.lit("u"), (F.col("k") % 10).cast("string")).alias("sub_id"),
        F.lit("").alias("sub_rel"),
        F.when(F.col("event_type") == "error", "DELETE").otherwise("TOUCH").alias("op"),
        F.col("event_id").alias("lsn"),
    )


VERSION_SQL = """
wlog AS (
  SELECT 'rbac/workspace' AS res_type, 'w'||user_id AS res_id,
         CASE WHEN k % 2 = 0 THEN 'admin' ELSE 'member' END AS relation, 'rbac/principal' AS sub_type,
         'u'||(k % 10) AS sub_id, '' AS sub_rel,
         CASE event_type WHEN 'error' THEN 'DELETE' ELSE 'TOUCH' END AS op, event_id AS lsn
  FROM (SELECT *, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events)
)"""


def counter_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A counter per event type: running number of events, label ``code`` OK unless it is an error."""
    ev = events(spark, sf_dir)
    counted = with_running(
        sized_chunks(ev.select("event_type", "ts", "event_id"), ["event_type"], "ts", DAY), ["event_type"], ["ts", "event_id"],
        {"value": ("sum", F.lit(1.0))}, F.col("_slice"),
    )
    return counted.select(
        F.lit("requests_total").alias("name"),
        F.create_map(
            F.lit("method"), F.col("event_type"),
            F.lit("code"), F.when(F.col("event_type") == "error", "Internal").otherwise("OK"),
        ).alias("labels"),
        "ts",
        "value",
    )


COUNTER_SQL = """
counter AS (
  SELECT event_type AS method, CASE event_type WHEN 'error' THEN 'Internal' ELSE 'OK' END AS code, ts,
         CAST(row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS DOUBLE) AS value
  FROM events
)"""


def reset_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A counter per user that restarts: value within 0..99 taken from the event, so drops are resets."""
    return events(spark, sf_dir).select(
        F.lit("jobs_total").alias("name"),
        F.create_map(F.lit("user"), _tag("u", "user_id")).alias("labels"),
        "ts",
        F.col("k").cast("double").alias("value"),
    )


RESET_SQL = """
counter AS (
  SELECT 'u'||user_id AS series, ts, CAST(json_extract(props, '$.k') AS DOUBLE) AS value FROM events
)"""


def gauge_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A gauge per event type: the event value at its time."""
    return events(spark, sf_dir).select(
        F.lit("load").alias("name"),
        F.create_map(F.lit("method"), F.col("event_type"), F.lit("user"), _tag("u", "user_id")).alias("labels"),
        "ts",
        "value",
    )


def decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cached decisions: resource is the user, permission the event type, cached when the event happened."""
    return events(spark, sf_dir).select(
        F.lit("rbac/workspace").alias("res_type"), _tag("w", "user_id").alias("res_id"),
        F.col("event_type").alias("permission"), F.lit("user").alias("sub_type"), _tag("u", "k").alias("sub_id"),
        (F.col("value") > 50).alias("allowed"), F.col("event_id").alias("checked_at"), F.col("ts").alias("cached_at"),
    )


def devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as devices placed in a workspace."""
    return table(spark, sf_dir, "orders").select(
        _tag("o", "o_orderkey").alias("id"),
        F.concat(F.lit("dev "), F.col("o_orderpriority")).alias("display_name"),
        _tag("c", "o_custkey").alias("workspace_id"),
        F.col("o_orderstatus").alias("reporter"),
        F.lit("org").alias("org_id"),
        F.col("o_orderdate").cast("timestamp").alias("created_at"),
    )
