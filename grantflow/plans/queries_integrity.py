"""Migration, integrity and reconciliation over data derived from the given tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..model import TUPLE_COLS
from ..operators import evaluate as ev
from ..operators import integrity as it
from ..operators import migrate as mi
from ..session import literal_table
from .catalog import query
from .derived import ACCESS_SQL, GRAPH_SQL, GROUP, HOST, PLATFORM, TENANT, USER, WS, graph, table
from .queries_changes import memberships
from .queries_graph import host_model, line_requests
from .queries_sources import tag


def link(source: str, res_type: str, id_: str, relation: str, sub_type: str, sub_id: str, sub_rel: str = "", where: str = "true"):
    """One SELECT of tuples for the SQL twins; ids are SQL expressions."""
    return (
        f"SELECT '{res_type}' AS res_type, {id_} AS res_id, '{relation}' AS relation, '{sub_type}' AS sub_type, "
        f"{sub_id} AS sub_id, '{sub_rel}' AS sub_rel FROM {source} WHERE {where}"
    )


def links(*parts: str) -> str:
    return " UNION ".join(parts)


def text(prefix, col, suffix=""):
    return F.concat(F.lit(prefix), F.col(col).cast("string"), F.lit(suffix))


@query(
    "m01_organizations",
    links(
        link("nation", "organization", "'org'||n_nationkey", "admin", "user", "'u'||n_regionkey", where="n_regionkey > 0"),
        link("nation", "organization", "'org'||n_nationkey", "member", "user", "'m'||n_nationkey"),
        link("supplier", "organization", "'sup'||s_suppkey", "member", "user", "'u'||s_suppkey"),
        link("supplier", "organization", "'sup'||s_suppkey", "member", "user", "'n'||s_nationkey"),
    ),
)
def m01(spark, sf):
    n = table(spark, sf, "nation").select(
        tag("org", "n_nationkey").alias("org_id"), F.when(F.col("n_regionkey") > 0, tag("u", "n_regionkey")).alias("admins"),
        tag("m", "n_nationkey").alias("members"),
    )
    s = table(spark, sf, "supplier").select(
        tag("sup", "s_suppkey").alias("org_id"), F.lit("").alias("admins"),
        F.concat_ws(" ", tag("u", "s_suppkey"), tag("n", "s_nationkey")).alias("members"),
    )
    return mi.accepted(mi.org_tuples(n.unionByName(s)))


@query(
    "m02_groups",
    links(
        link("supplier", "group", "'g'||s_suppkey", "org", "organization", "'org'||s_nationkey"),
        link("supplier", "group", "'g'||s_suppkey", "admin", "user", "'a'||s_suppkey", where="s_acctbal > 0"),
        link("supplier", "group", "'g'||s_suppkey", "member", "user", "'u'||s_suppkey"),
        link("supplier", "group", "'g'||s_suppkey", "member", "user", "'x'||s_nationkey"),
    ),
)
def m02(spark, sf):
    return mi.accepted(
        mi.group_tuples(
            table(spark, sf, "supplier").select(
                tag("g", "s_suppkey").alias("group_id"), tag("org", "s_nationkey").alias("org_id"),
                F.array(tag("u", "s_suppkey"), tag("x", "s_nationkey")).alias("members"),
                F.when(F.col("s_acctbal") > 0, tag("a", "s_suppkey")).alias("admin"),
            )
        )
    )


_WORKSPACE = [
    link("customer", "workspace", "'c'||c_custkey", "org", "organization", "'org'||c_nationkey"),
    link("customer", "workspace", "'c'||c_custkey", "owner", "user", "'u'||c_custkey"),
]


@query(
    "m03_workspaces",
    links(
        *_WORKSPACE,
        link("customer", "workspace", "'c'||c_custkey", "admin", "user", "'a'||c_nationkey", where="c_acctbal > 0"),
        link("customer", "workspace", "'c'||c_custkey", "editor", "group", "'g'||c_nationkey", "member"),
        link("customer", "workspace", "'c'||c_custkey", "viewer", "user", "'v'||c_nationkey"),
        link("customer", "workspace", "'c'||c_custkey", "viewer", "group", "'h'||c_nationkey", "member"),
    ),
)
def m03(spark, sf):
    return mi.accepted(
        mi.workspace_migration(
            table(spark, sf, "customer").select(
                tag("c", "c_custkey").alias("workspace_id"), tag("org", "c_nationkey").alias("org_id"),
                tag("u", "c_custkey").alias("owner"), F.when(F.col("c_acctbal") > 0, tag("a", "c_nationkey")).alias("admins"),
                text("group:g", "c_nationkey", "#member").alias("editors"),
                F.concat_ws(" ", text("user:v", "c_nationkey"), text("group:h", "c_nationkey", "#member")).alias("viewers"),
            )
        )
    )


@query(
    "m04_applications",
    "SELECT *, true AS valid FROM ("
    + links(
        link("part", "application", "'p'||p_partkey", "org", "organization", "'org'||p_size"),
        link("part", "application", "'p'||p_partkey", "owner", "user", "'u'||p_size"),
        link("part", "application", "'p'||p_partkey", "user", "group", "'g'||p_size", "member"),
    )
    + ") UNION ALL SELECT *, false FROM ("
    + link("part", "application", "'p'||p_partkey", "admin", "", "'bob'", where="p_size > 25")
    + ")",
)
def m04(spark, sf):
    # An admin without a type is malformed and must come out as not valid.
    return mi.application_migration(
        table(spark, sf, "part").select(
            tag("p", "p_partkey").alias("app_id"), tag("org", "p_size").alias("org_id"), tag("u", "p_size").alias("owner"),
            F.when(F.col("p_size") > 25, "bob").alias("admins"), text("group:g", "p_size", "#member").alias("users"),
        )
    )


@query(
    "m05_inventory_workspaces",
    links(
        *_WORKSPACE,
        link("customer", "workspace", "'c'||c_custkey", "admin", "user", "'bob'", where="c_acctbal > 5000"),
        link("customer", "workspace", "'c'||c_custkey", "operator", "group", "'g'||c_nationkey", "member"),
        link("customer", "workspace", "'c'||c_custkey", "viewer", "group", "'h'||c_nationkey", "member"),
    ),
)
def m05(spark, sf):
    return mi.accepted(
        mi.inventory_workspace_migration(
            table(spark, sf, "customer").select(
                tag("c", "c_custkey").alias("workspace_id"), tag("org", "c_nationkey").alias("org_id"),
                tag("u", "c_custkey").alias("owner"), F.when(F.col("c_acctbal") > 5000, "user:bob").alias("admins"),
                text("group:g", "c_nationkey", "#member").alias("operators"),
                text("group:h", "c_nationkey", "#member").alias("viewers"),
            )
        )
    )


@query(
    "m06_host_groups",
    links(
        link("supplier", "host_group", "'hg'||s_suppkey", "org", "organization", "'org'||s_nationkey"),
        link("supplier", "host_group", "'hg'||s_suppkey", "workspace", "workspace", "'c'||s_suppkey"),
        link("supplier", "host_group", "'hg'||s_suppkey", "owner", "user", "'u'||s_suppkey", where="s_acctbal > 0"),
        link("supplier", "host_group", "'hg'||s_suppkey", "admin", "group", "'g'||s_nationkey", "member"),
        link("supplier", "host_group", "'hg'||s_suppkey", "member", "user", "'m'||s_nationkey"),
    ),
)
def m06(spark, sf):
    return mi.accepted(
        mi.host_group_migration(
            table(spark, sf, "supplier").select(
                tag("hg", "s_suppkey").alias("group_id"), tag("org", "s_nationkey").alias("org_id"),
                tag("c", "s_suppkey").alias("workspace_id"), F.when(F.col("s_acctbal") > 0, tag("u", "s_suppkey")).alias("owner"),
                text("group:g", "s_nationkey", "#member").alias("admins"), text("user:m", "s_nationkey").alias("members"),
            )
        )
    )


_HID = "'o'||o_orderkey"


@query(
    "m07_hosts",
    links(
        link("orders", "host", _HID, "org", "organization", "'acme'"),
        link("orders", "host", _HID, "workspace", "workspace", "'c'||o_custkey"),
        link("orders", "host", _HID, "host_group", "host_group", "'hg'||o_custkey", where="o_orderstatus <> 'F'"),
        link("orders", "host", _HID, "owner", "user", "'u'||o_custkey"),
        link("orders", "host", _HID, "admin", "user", "'bob'", where="o_totalprice > 200000"),
        link("orders", "host", _HID, "operator", "group", "'sre'", "member"),
        link("orders", "host", _HID, "viewer", "group", "'dev'", "member"),
        link("orders", "host", _HID, "viewer", "user", "'v'||o_custkey"),
        link("orders", "host", _HID, "can_view_system_profile", "group", "'dev'", "member"),
        link("orders", "host", _HID, "can_view_facts", "group", "'sre'", "member"),
    ),
)
def m07(spark, sf):
    sre, dev = F.lit("group:sre#member"), F.lit("group:dev#member")
    return mi.accepted(
        mi.host_migration(
            table(spark, sf, "orders").select(
                tag("o", "o_orderkey").alias("host_id"), F.lit("acme").alias("org_id"), tag("c", "o_custkey").alias("workspace_id"),
                F.when(F.col("o_orderstatus") != "F", tag("hg", "o_custkey")).alias("host_group_id"),
                tag("u", "o_custkey").alias("owner"), F.when(F.col("o_totalprice") > 200000, "user:bob").alias("admins"),
                sre.alias("operators"), F.concat_ws(" ", dev, text("user:v", "o_custkey")).alias("viewers"),
                dev.alias("can_view_system_profile"), sre.alias("can_view_facts"),
            )
        )
    )


@query(
    "m08_tag_namespaces",
    links(
        link("part", "tag_namespace", "p_brand", "org", "organization", "'acme'"),
        link("part", "tag_namespace", "p_brand", "admin", "user", "'u'||p_size"),
    ),
)
def m08(spark, sf):
    return mi.accepted(
        mi.tag_namespace_migration(
            table(spark, sf, "part").select(
                F.col("p_brand").alias("namespace_id"), F.lit("acme").alias("org_id"), text("user:u", "p_size").alias("admins")
            )
        )
    )


@query(
    "m09_tags",
    links(
        link("part", "tag", "'p'||p_partkey", "org", "organization", "'acme'"),
        link("part", "tag", "'p'||p_partkey", "namespace", "tag_namespace", "p_brand"),
        link("part", "tag", "'p'||p_partkey", "admin", "user", "'alice'", where="p_size < 40"),
        link("part", "tag", "'p'||p_partkey", "can_apply", "user", "'u'||p_size"),
        link("part", "tag", "'p'||p_partkey", "can_apply", "role", "'r'||p_size", "assignee"),
    ),
)
def m09(spark, sf):
    return mi.accepted(
        mi.tag_migration(
            table(spark, sf, "part").select(
                tag("p", "p_partkey").alias("tag_id"), F.lit("acme").alias("org_id"), F.col("p_brand").alias("namespace_id"),
                F.when(F.col("p_size") < 40, "user:alice").alias("admin"),
                F.concat_ws(" ", text("user:u", "p_size"), text("role:r", "p_size", "#assignee")).alias("can_apply"),
            )
        )
    )


@query(
    "m10_decision_test",
    f"""WITH RECURSIVE {ACCESS_SQL}, ask AS (SELECT DISTINCT 'o'||l_orderkey AS o, 'u'||l_suppkey AS u,
      l_suppkey % 2 = 0 AS expected FROM lineitem),
    x AS (SELECT ask.*, s.u IS NOT NULL AS allowed FROM ask
      LEFT JOIN tup h ON h.res_type = 'hbi/host' AND h.res_id = ask.o AND h.relation = 't_workspace'
      LEFT JOIN scopeuser s ON s.tp = 'rbac/workspace' AND s.id = h.sub_id AND s.permission = 'inventory_host_view'
      AND s.u = ask.u) SELECT expected, allowed, expected = allowed AS ok, count(*) AS requests FROM x GROUP BY ALL""",
)
def m10(spark, sf):
    rules, _ = host_model(spark)
    even = F.substring("sub_id", 2, 20).cast("long") % 2 == 0
    ask = line_requests(spark, sf).distinct().withColumn("expected", even)
    out = ev.validate_decisions(ask, graph(spark, sf), rules)
    return out.groupBy("expected", "allowed", "ok").agg(F.count("*").alias("requests"))


@query(
    "m11_migration_report",
    f"""WITH {GRAPH_SQL}, want AS (SELECT 'hbi/host' AS name, (SELECT count(*) FROM orders) AS expected
      UNION ALL SELECT 'rbac/workspace', (SELECT count(*) FROM customer) UNION ALL SELECT 'rbac/absent', 3),
    have AS (SELECT res_type AS name, count(DISTINCT res_id) AS n FROM tup GROUP BY res_type)
    SELECT 'entities' AS kind, coalesce(have.name, want.name) AS name, coalesce(n, 0) AS n, expected,
      coalesce(coalesce(n, 0) = expected, false) AS ok FROM have FULL JOIN want ON have.name = want.name
    UNION ALL SELECT 'members', res_id, count(CASE WHEN relation IN ('member', 't_member') THEN 1 END), NULL,
      count(CASE WHEN relation IN ('member', 't_member') THEN 1 END) > 0 FROM tup WHERE res_type = 'rbac/group' GROUP BY res_id""",
)
def m11(spark, sf):
    hosts, workspaces = (table(spark, sf, t).agg(F.count("*").alias("expected")) for t in ("orders", "customer"))
    wanted = (
        hosts.select(F.lit("hbi/host").alias("name"), "expected")
        .unionByName(workspaces.select(F.lit("rbac/workspace").alias("name"), "expected"))
        .unionByName(spark.range(1).select(F.lit("rbac/absent").alias("name"), F.lit(3).cast("long").alias("expected")))
    )
    return it.migration_report(graph(spark, sf), wanted)


@query(
    "m12_cardinality",
    f"""WITH {GRAPH_SQL}, ent AS (
      SELECT 'rbac/workspace' AS tp, 'c'||c_custkey AS id FROM customer UNION SELECT 'rbac/workspace', 'z'||n_nationkey FROM nation
      UNION SELECT 'hbi/host', 'o'||(o_orderkey + o_orderkey % 7 // 6) FROM orders
      UNION SELECT 'rbac/group', 'gn'||n_nationkey FROM nation UNION SELECT 'rbac/group', 'gn'||(n_nationkey + 100) FROM nation
      UNION SELECT 'rbac/tenant', 't'||r_regionkey FROM region),
    spec(tp, relation, cardinality, least, most) AS (VALUES
      ('rbac/workspace', 't_parent', 'ExactlyOne', 1, 1), ('hbi/host', 't_workspace', 'ExactlyOne', 1, 1),
      ('rbac/tenant', 't_platform', 'AtMostOne', 0, 1), ('rbac/group', 't_member', 'AtLeastOne', 1, 1000000000)),
    held AS (SELECT res_type, res_id, relation, sub_type, sub_id, sub_rel FROM tup
      UNION SELECT 'rbac/workspace', 'c'||c_custkey, 't_parent', 'rbac/workspace', 'second', '' FROM customer WHERE c_acctbal < 0
      UNION SELECT 'rbac/tenant', 't'||r_regionkey, 't_platform', 'rbac/platform', 'p1', '' FROM region WHERE r_regionkey > 2)
    SELECT e.tp AS res_type, e.id AS res_id, s.relation, s.cardinality, count(h.res_id) AS n FROM ent e JOIN spec s ON s.tp = e.tp
    LEFT JOIN held h ON h.res_type = e.tp AND h.res_id = e.id AND h.relation = s.relation
    GROUP BY ALL HAVING count(h.res_id) < any_value(s.least) OR count(h.res_id) > any_value(s.most)""",
)
def m12(spark, sf):
    customer, nation = table(spark, sf, "customer"), table(spark, sf, "nation")
    second = customer.where("c_acctbal < 0").select(
        F.lit(WS).alias("res_type"), tag("c", "c_custkey").alias("res_id"), F.lit("t_parent").alias("relation"),
        F.lit(WS).alias("sub_type"), F.lit("second").alias("sub_id"), F.lit("").alias("sub_rel"),
    )
    region = table(spark, sf, "region")
    platform = region.where("r_regionkey > 2").select(
        F.lit(TENANT).alias("res_type"), tag("t", "r_regionkey").alias("res_id"), F.lit("t_platform").alias("relation"),
        F.lit(PLATFORM).alias("sub_type"), F.lit("p1").alias("sub_id"), F.lit("").alias("sub_rel"),
    )
    entities = [
        customer.select(F.lit(WS).alias("res_type"), tag("c", "c_custkey").alias("res_id")),
        nation.select(F.lit(WS), tag("z", "n_nationkey")),
        table(spark, sf, "orders").select(F.lit(HOST), F.concat(F.lit("o"), F.expr("o_orderkey + o_orderkey % 7 div 6"))),
        nation.select(F.lit(GROUP), tag("gn", "n_nationkey")), nation.select(F.lit(GROUP), F.concat(F.lit("gn"), F.col("n_nationkey") + 100)),
        region.select(F.lit(TENANT), tag("t", "r_regionkey")),
    ]
    spec = literal_table(spark, [
        (WS, "t_parent", "ExactlyOne"), (HOST, "t_workspace", "ExactlyOne"), (TENANT, "t_platform", "AtMostOne"),
        (GROUP, "t_member", "AtLeastOne"), (WS, "t_binding", "Any"),
    ], "res_type string, relation string, cardinality string")
    return it.check_cardinality(graph(spark, sf).unionByName(second).unionByName(platform), reduce(DataFrame.union, entities), spec)


def bad_parents(spark, sf):
    """Workspaces wrongly placed under hosts."""
    return table(spark, sf, "customer").where("c_acctbal < 0").select(
        F.lit(WS).alias("res_type"), tag("c", "c_custkey").alias("res_id"), F.lit("t_parent").alias("relation"),
        F.lit(HOST).alias("sub_type"), tag("o", "c_custkey").alias("sub_id"), F.lit("").alias("sub_rel"),
    )


# Subject types the model allows, as (type, relation, subject type, subject relation, wildcard).
ALLOWED = [
    (WS, "t_parent", WS, "", False), (WS, "t_parent", TENANT, "", False), (HOST, "t_workspace", WS, "", False),
    (WS, "t_binding", "rbac/role_binding", "", False), (TENANT, "t_binding", "rbac/role_binding", "", False),
    (TENANT, "t_platform", "rbac/platform", "", False), ("rbac/platform", "t_binding", "rbac/role_binding", "", False),
    ("rbac/group", "t_member", USER, "", False), ("rbac/group", "t_member", "rbac/group", "member", False),
    ("rbac/role_binding", "t_subject", USER, "", False), ("rbac/role_binding", "t_subject", "rbac/group", "member", False),
    ("rbac/role_binding", "t_role", "rbac/role", "", False), ("rbac/role", "t_child", "rbac/role", "", False),
    ("rbac/role", "t_inventory_hosts_read", USER, "", True), ("rbac/role", "t_inventory_hosts_write", USER, "", True),
    ("rbac/role", "t_patch_system_read", USER, "", True),
]


def allowed_subjects(spark):
    return literal_table(
        spark, ALLOWED, "res_type string, relation string, sub_type string, sub_rel string, wildcard boolean"
    )


@query("m13_subject_types", link("customer", WS, "'c'||c_custkey", "t_parent", HOST, "'o'||c_custkey", where="c_acctbal < 0"))
def m13(spark, sf):
    return it.check_subject_types(graph(spark, sf).unionByName(bad_parents(spark, sf)), allowed_subjects(spark))


@query(
    "m14_lint",
    """SELECT 'dangling parent' AS problem, 'rbac/workspace' AS res_type, 'n'||n_nationkey AS res_id,
    'rbac/tenant:missing'||n_regionkey AS detail FROM nation
    UNION ALL SELECT 'repeated tuple', 'rbac/workspace', 'c'||c_custkey, 't_parent' FROM customer WHERE c_acctbal < 0
    UNION ALL SELECT 'undefined type', 'zoo', 's'||s_suppkey, 'zoo' FROM supplier
    UNION ALL SELECT 'undefined relation', 'rbac/group', 'gn'||s_nationkey, 'odd' FROM (SELECT DISTINCT s_nationkey FROM supplier)
    UNION ALL SELECT 'cycle', 'rbac/workspace', 'x'||r_regionkey, 'length 2' FROM region
    UNION ALL SELECT 'cycle', 'rbac/workspace', 'y'||r_regionkey, 'length 2' FROM region""",
)
def m14(spark, sf):
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    supplier, customer = table(spark, sf, "supplier"), table(spark, sf, "customer")

    def rows(df, *values):
        return df.select(*[v.alias(c) for c, v in zip(TUPLE_COLS, values, strict=True)])

    none = F.lit("")
    dirt = [
        rows(nation, F.lit(WS), tag("n", "n_nationkey"), F.lit("t_parent"), F.lit(TENANT), tag("missing", "n_regionkey"), none),
        rows(customer.where("c_acctbal < 0"), F.lit(WS), tag("c", "c_custkey"), F.lit("t_parent"), F.lit(WS), tag("n", "c_nationkey"), none),
        rows(supplier, F.lit("zoo"), tag("s", "s_suppkey"), F.lit("x"), F.lit(USER), tag("u", "s_suppkey"), none),
        rows(supplier, F.lit("rbac/group"), tag("gn", "s_nationkey"), F.lit("odd"), F.lit(USER), tag("u", "s_suppkey"), none),
        rows(region, F.lit(WS), tag("x", "r_regionkey"), F.lit("t_parent"), F.lit(WS), tag("y", "r_regionkey"), none),
        rows(region, F.lit(WS), tag("y", "r_regionkey"), F.lit("t_parent"), F.lit(WS), tag("x", "r_regionkey"), none),
    ]
    t = graph(spark, sf)
    for d in dirt:
        t = t.unionByName(d)
    declared = allowed_subjects(spark).select("res_type", "relation").distinct()
    return it.lint_tuples(t, declared, ["t_parent", "t_platform"])


@query(
    "m15_reconcile",
    f"""WITH {GRAPH_SQL}, a AS (SELECT DISTINCT 'gn'||((s_nationkey + x) % 25) AS g, 'u'||s_suppkey AS u
      FROM supplier, (VALUES (0), (1)) v(x)),
    b AS (SELECT res_id AS g, sub_id AS u FROM tup WHERE res_type = 'rbac/group')
    SELECT coalesce(a.g, b.g) AS res_id, coalesce(a.u, b.u) AS sub_id,
    CASE WHEN b.g IS NULL THEN 'missing' WHEN a.g IS NULL THEN 'extra' ELSE 'matched' END AS status
    FROM a FULL JOIN b ON a.g = b.g AND a.u = b.u""",
)
def m15(spark, sf):
    actual = graph(spark, sf).where("res_type = 'rbac/group'")
    return it.reconcile(memberships(spark, sf), actual).select("res_id", "sub_id", "status")


@query(
    "m16_tuple_counts",
    f"WITH {GRAPH_SQL} SELECT res_type, relation, count(*) AS tuples FROM tup GROUP BY ALL",
)
def m16(spark, sf):
    return it.tuple_counts(graph(spark, sf))


@query(
    "m17_run_summary",
    """SELECT event_type, count(*) AS total, count(CASE WHEN value < 100 THEN 1 END) AS passed_tests,
    count(CASE WHEN value >= 100 THEN 1 END) AS failed_tests,
    round(100.0 * count(CASE WHEN value < 100 THEN 1 END) / count(*), 1) AS success_rate FROM events GROUP BY ALL""",
)
def m17(spark, sf):
    return it.run_summary(table(spark, sf, "events").select("event_type", (F.col("value") < 100).alias("passed")), ["event_type"])
