"""Permission evaluation over the derived graph."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import evaluate as ev
from ..operators import roles as ro
from ..operators.closure import ancestors, userset_members
from ..session import cut
from .catalog import query
from .derived import ACCESS_SQL, GRAPH_SQL, GROUP, HOST, PLATFORM, TENANT, USER, WS, graph, table

ALIASES = {(GROUP, "member"): ["t_member"]}


def host_model(spark):
    """Rules of the derived graph and its leaf map."""
    perms = ro.permissions_frame(spark)
    return ro.role_model_rules(perms, ro.host_rules()), ro.leaf_map(perms)


def scope_access(spark, sf_dir, tuples=None):
    """Group-level grants at every scope, and the members of groups."""
    t = graph(spark, sf_dir) if tuples is None else tuples
    _, leaves = host_model(spark)
    bindings = cut(ro.binding_grants(t, ro.role_permissions(t, leaves)))
    scopes = cut(ro.scope_grants(t, bindings))
    return t, scopes, cut(userset_members(t, ALIASES))


@query(
    "g01_direct_subjects",
    f"WITH {GRAPH_SQL} SELECT res_id, sub_type, sub_id, sub_rel FROM tup "
    "WHERE res_type = 'rbac/workspace' AND relation = 't_parent'",
)
def g01(spark, sf):
    return ev.direct_subjects(graph(spark, sf), WS, "t_parent")


@query(
    "g02_userset_expansion",
    f"WITH RECURSIVE {ACCESS_SQL} SELECT 'rbac/group' AS type, g AS id, 'member' AS name, "
    "'rbac/principal' AS sub_type, u AS sub_id FROM member",
)
def g02(spark, sf):
    return userset_members(graph(spark, sf), ALIASES)


@query(
    "g03_union_permission",
    f"WITH {GRAPH_SQL} SELECT res_id, sub_type, sub_id, sub_rel FROM tup "
    "WHERE res_type = 'rbac/workspace' AND relation = 't_parent' UNION SELECT res_id, sub_type, sub_id, sub_rel "
    "FROM tup WHERE res_type = 'rbac/workspace' AND relation = 't_binding'",
)
def g03(spark, sf):
    return ev.union_permission(graph(spark, sf), WS, ["t_parent", "t_binding"])


@query(
    "g04_arrow_permission",
    f"""WITH RECURSIVE {ACCESS_SQL} SELECT DISTINCT h.res_type AS type, h.res_id AS id, g.permission, g.sub_type,
    g.sub_id, g.sub_rel FROM tup h JOIN tup b ON b.res_type = h.sub_type AND b.res_id = h.sub_id
    AND b.relation = 't_binding' JOIN bindgrant g ON g.binding = b.sub_id
    WHERE h.res_type = 'rbac/workspace' AND h.relation = 't_parent'""",
)
def g04(spark, sf):
    t = graph(spark, sf)
    _, leaves = host_model(spark)
    own = ro.scope_grants(t.where("relation not in ('t_parent', 't_platform')"),
                          ro.binding_grants(t, ro.role_permissions(t, leaves)))
    return ev.arrow_permission(t, own, WS, "t_parent")


@query(
    "g05_ancestor_closure",
    f"WITH RECURSIVE {ACCESS_SQL} SELECT tp||':'||id AS src, atp||':'||aid AS dst, CAST(min(depth) AS INTEGER) "
    "AS depth FROM anc GROUP BY ALL",
)
def g05(spark, sf):
    return ancestors(graph(spark, sf), ro.SCOPE_RELATIONS)


@query(
    "g06_intersection_permission",
    f"WITH RECURSIVE {ACCESS_SQL} SELECT tp AS type, id, 'rbac/principal' AS sub_type, u AS sub_id FROM scopeuser "
    "WHERE permission = 'inventory_host_view' INTERSECT SELECT tp, id, 'rbac/principal', u FROM scopeuser "
    "WHERE permission = 'inventory_host_update'",
)
def g06(spark, sf):
    _, scopes, members = scope_access(spark, sf)
    return ev.intersect_grants(
        scopes.where("permission = 'inventory_host_view'"),
        scopes.where("permission = 'inventory_host_update'"),
        ["type", "id"],
        members,
    )


@query(
    "g07_wildcard_match",
    f"""WITH {GRAPH_SQL}, want AS (SELECT 'u'||s_suppkey AS u FROM supplier WHERE s_acctbal > 5000)
    SELECT res_type, res_id, relation, sub_type, sub_id FROM tup WHERE sub_rel = '' AND sub_type = 'rbac/principal'
    AND (sub_id IN (SELECT u FROM want) OR (sub_id = '*' AND EXISTS (SELECT 1 FROM want)))""",
)
def g07(spark, sf):
    want = table(spark, sf, "supplier").where("s_acctbal > 5000").select(
        F.lit(USER).alias("sub_type"), F.concat(F.lit("u"), F.col("s_suppkey")).alias("sub_id")
    )
    return ev.subject_matches(graph(spark, sf).where("sub_rel = ''").drop("sub_rel"), want)


@query("g08_role_permissions", f"WITH RECURSIVE {ACCESS_SQL} SELECT role, permission FROM roleperm")
def g08(spark, sf):
    return ro.role_permissions(graph(spark, sf), host_model(spark)[1])


@query(
    "g09_binding_grants",
    f"WITH RECURSIVE {ACCESS_SQL} SELECT binding, permission, sub_type, sub_id, sub_rel FROM bindgrant",
)
def g09(spark, sf):
    t = graph(spark, sf)
    return ro.binding_grants(t, ro.role_permissions(t, host_model(spark)[1]))


@query(
    "g10_scope_propagation",
    f"""WITH RECURSIVE {ACCESS_SQL} SELECT DISTINCT h.res_id AS host, s.permission, s.u AS principal FROM tup h
    JOIN scopeuser s ON s.tp = 'rbac/workspace' AND s.id = h.sub_id
    WHERE h.relation = 't_workspace' AND s.permission = 'inventory_host_view'""",
)
def g10(spark, sf):
    t, scopes, members = scope_access(spark, sf)
    # Hosts take the grants of their workspace, so usersets are opened there, and the sets are handed to the hosts.
    view = ev.open_usersets(scopes.where("permission = 'inventory_host_view'"), members, shared=True)
    return ro.resource_grants(t, view, HOST).select(
        F.col("id").alias("host"), "permission", F.col("sub_id").alias("principal")
    )


CONTINGENT_SQL = """
pair AS (
  SELECT tp, id, u FROM scopeuser WHERE permission = 'inventory_host_view'
  INTERSECT SELECT tp, id, u FROM scopeuser WHERE permission = 'patch_system_view_assigned'
)"""


@query(
    "g11_contingent_permission",
    f"WITH RECURSIVE {ACCESS_SQL}, {CONTINGENT_SQL} SELECT tp AS type, id, 'patch_system_view' AS permission, "
    "u AS principal FROM pair",
)
def g11(spark, sf):
    _, scopes, members = scope_access(spark, sf)
    out = ro.contingent(scopes, "inventory_host_view", "patch_system_view_assigned", "patch_system_view", members)
    return out.select("type", "id", "permission", F.col("sub_id").alias("principal"))


@query(
    "g12_gate_on_view",
    f"""WITH RECURSIVE {ACCESS_SQL}, {CONTINGENT_SQL} SELECT h.res_id AS host, b.u AS principal FROM tup h
    JOIN pair b ON b.tp = 'rbac/workspace' AND b.id = h.sub_id
    JOIN scopeuser v ON v.tp = b.tp AND v.id = b.id AND v.u = b.u AND v.permission = 'inventory_host_view'
    WHERE h.relation = 't_workspace'""",
)
def g12(spark, sf):
    t, scopes, members = scope_access(spark, sf)
    patch = ro.contingent(
        scopes, "inventory_host_view", "patch_system_view_assigned", "patch_system_view", members, shared=True)
    view = scopes.where("permission = 'inventory_host_view'")
    # Hosts take their grants from one workspace, so gating per set of workspaces first keeps the host join last.
    gated = ro.gate_on_view(view, patch, members)
    gated = gated._replace(objects=gated.objects.where(F.col("type") == WS))
    return ro.resource_grants(t, [gated], HOST).select(F.col("id").alias("host"), F.col("sub_id").alias("principal"))


def line_requests(spark, sf):
    """One request per order line: may the supplier view the host of the order."""
    return table(spark, sf, "lineitem").select(
        F.lit(HOST).alias("res_type"), F.concat(F.lit("o"), F.col("l_orderkey")).alias("res_id"),
        F.lit("view").alias("permission"), F.lit(USER).alias("sub_type"),
        F.concat(F.lit("u"), F.col("l_suppkey")).alias("sub_id"),
    )


@query(
    "g13_check_bulk",
    f"""WITH RECURSIVE {ACCESS_SQL} SELECT 'o'||l_orderkey AS res_id, 'u'||l_suppkey AS sub_id,
    s.u IS NOT NULL AS allowed, count(*) AS requests FROM lineitem
    LEFT JOIN tup h ON h.res_type = 'hbi/host' AND h.res_id = 'o'||l_orderkey AND h.relation = 't_workspace'
    LEFT JOIN scopeuser s ON s.tp = 'rbac/workspace' AND s.id = h.sub_id AND s.permission = 'inventory_host_view'
    AND s.u = 'u'||l_suppkey GROUP BY ALL""",
)
def g13(spark, sf):
    rules, _ = host_model(spark)
    out = ev.check_bulk(line_requests(spark, sf), graph(spark, sf), rules)
    return out.groupBy("res_id", "sub_id", "allowed").agg(F.count("*").alias("requests"))


@query(
    "g14_lookup_resources",
    f"""WITH RECURSIVE {ACCESS_SQL} SELECT DISTINCT s.u AS sub_id, h.res_id FROM tup h JOIN scopeuser s
    ON s.tp = 'rbac/workspace' AND s.id = h.sub_id AND s.permission = 'inventory_host_update'
    JOIN supplier ON s.u = 'u'||s_suppkey AND s_suppkey % 5 = 0 WHERE h.relation = 't_workspace'""",
)
def g14(spark, sf):
    rules, _ = host_model(spark)
    subjects = table(spark, sf, "supplier").where("s_suppkey % 5 = 0").select(
        F.lit(USER).alias("sub_type"), F.concat(F.lit("u"), F.col("s_suppkey")).alias("sub_id")
    )
    return ev.lookup_resources(graph(spark, sf), rules, HOST, "update", subjects).select("sub_id", "res_id")


@query(
    "g15_lookup_subjects",
    f"""WITH RECURSIVE {ACCESS_SQL} SELECT DISTINCT h.res_id, s.u AS sub_id FROM orders
    JOIN tup h ON h.res_type = 'hbi/host' AND h.res_id = 'o'||o_orderkey AND h.relation = 't_workspace'
    JOIN scopeuser s ON s.tp = 'rbac/workspace' AND s.id = h.sub_id AND s.permission = 'inventory_host_update'
    WHERE o_totalprice > 400000""",
)
def g15(spark, sf):
    rules, _ = host_model(spark)
    wanted = table(spark, sf, "orders").where("o_totalprice > 400000").select(
        F.lit(HOST).alias("res_type"), F.concat(F.lit("o"), F.col("o_orderkey")).alias("res_id")
    )
    return ev.lookup_subjects(graph(spark, sf), rules, wanted, "update").select("res_id", "sub_id")


@query(
    "g16_explain_path",
    f"""WITH RECURSIVE {ACCESS_SQL}, ask AS (SELECT DISTINCT 'o'||l_orderkey AS o, 'u'||l_suppkey AS u FROM lineitem),
    place AS (SELECT a.o, a.u, h.sub_id AS c, n.sub_id AS n, t.sub_id AS t FROM ask a
      JOIN tup h ON h.res_type = 'hbi/host' AND h.res_id = a.o AND h.relation = 't_workspace'
      JOIN tup n ON n.res_type = 'rbac/workspace' AND n.res_id = h.sub_id AND n.relation = 't_parent'
      JOIN tup t ON t.res_type = 'rbac/workspace' AND t.res_id = n.sub_id AND t.relation = 't_parent'),
    head AS (SELECT *, ['hbi/host:'||o||'#view', 'rbac/workspace:'||c||'#inventory_host_view',
      'rbac/workspace:'||n||'#inventory_host_view'] AS h FROM place),
    cand AS (
      SELECT o, u, list_concat(h, ['rbac/role_binding:b'||n||'#inventory_host_view', 'rbac/role_binding:b'||n||'#t_subject',
        'rbac/group:g'||n||'#member', 'rbac/group:g'||n||'#t_member']) AS path FROM head
      JOIN tup m ON m.res_type = 'rbac/group' AND m.res_id = 'g'||n AND m.sub_id = u AND m.sub_rel = ''
      UNION ALL
      SELECT o, u, list_concat(h, ['rbac/tenant:'||t||'#inventory_host_view',
        'rbac/role_binding:b'||t||'#inventory_host_view', 'rbac/role_binding:b'||t||'#t_subject',
        'rbac/group:gr'||substr(t, 2)||'#member', 'rbac/group:gr'||substr(t, 2)||'#t_member',
        'rbac/group:'||k.sub_id||'#member', 'rbac/group:'||k.sub_id||'#t_member']) FROM head
      JOIN tup r ON r.res_id = 'b'||t AND r.relation = 't_role'
      JOIN roleperm p ON p.role = r.sub_id AND p.permission = 'inventory_host_view'
      JOIN tup k ON k.res_type = 'rbac/group' AND k.res_id = 'gr'||substr(t, 2)
      JOIN tup m ON m.res_type = 'rbac/group' AND m.res_id = k.sub_id AND m.sub_id = u AND m.sub_rel = ''
      UNION ALL
      SELECT o, u, list_concat(h, ['rbac/tenant:'||t||'#inventory_host_view', 'rbac/platform:p0#inventory_host_view',
        'rbac/role_binding:bp#inventory_host_view', 'rbac/role_binding:bp#t_subject']) FROM head WHERE u = 'u1')
    SELECT o AS host, u AS principal, CAST(len(path) - 1 AS INTEGER) AS hops, array_to_string(path, ' > ') AS path
    FROM (SELECT *, row_number() OVER (PARTITION BY o, u ORDER BY len(path), path) AS rn FROM cand) WHERE rn = 1""",
)
def g16(spark, sf):
    rules, _ = host_model(spark)
    out = ev.explain(line_requests(spark, sf).distinct(), graph(spark, sf), rules)
    return out.select(
        F.col("res_id").alias("host"), F.col("sub_id").alias("principal"), "hops",
        F.concat_ws(" > ", "path").alias("path"),
    )


@query(
    "g17_effective_access",
    f"""WITH RECURSIVE {ACCESS_SQL}, {CONTINGENT_SQL}, every AS (
      SELECT tp, id, permission, u FROM scopeuser UNION ALL SELECT tp, id, 'patch_system_view', u FROM pair)
    SELECT tp AS type, id, permission, u AS principal FROM every
    UNION ALL SELECT DISTINCT 'hbi/host', h.res_id, CASE s.permission WHEN 'inventory_host_view' THEN 'view'
      WHEN 'inventory_host_update' THEN 'update' ELSE s.permission END, s.u FROM tup h JOIN every s ON s.tp = h.sub_type AND s.id = h.sub_id
    WHERE h.relation = 't_workspace' AND s.permission <> 'patch_system_view_assigned'""",
)
def g17(spark, sf):
    """Access at every scope and on every host, host permissions with an intersection among them."""
    access = ev.effective_access(graph(spark, sf), host_model(spark)[0])
    scoped = F.col("res_type").isin(WS, TENANT, PLATFORM) & ~F.col("permission").startswith("t_")
    host = (F.col("res_type") == HOST) & F.col("permission").isin("view", "update", "patch_system_view")
    return access.where(scoped | host).select(F.col("res_type").alias("type"), F.col("res_id").alias("id"), "permission", F.col("sub_id").alias("principal"))


V1_SQL = """
v1role AS (
  SELECT p_brand AS role, lower(p_type) AS a,
         CASE WHEN p_size < 10 THEN '*' ELSE split_part(p_name, ' ', 2) END AS r,
         CASE WHEN p_size > 40 THEN '*' ELSE split_part(p_name, ' ', 1) END AS v FROM part
),
v1map AS (
  SELECT DISTINCT lower(p_type) AS app, split_part(p_name, ' ', 2) AS resource, split_part(p_name, ' ', 1) AS verb,
         lower(p_type)||'_'||split_part(p_name, ' ', 2)||'_'||split_part(p_name, ' ', 1) AS permission FROM part
)"""


def v1_map(spark, sf):
    app, word = F.lower("p_type"), F.split("p_name", " ")
    return table(spark, sf, "part").select(
        app.alias("app"), word[1].alias("resource"), word[0].alias("verb"),
        F.concat_ws("_", app, word[1], word[0]).alias("permission"),
    ).distinct()


@query(
    "g18_map_v1_to_v2",
    f"""WITH {V1_SQL} SELECT DISTINCT role, permission FROM v1role JOIN v1map
    ON (a = app OR a = '*') AND (r = resource OR r = '*') AND (v = verb OR v = '*')""",
)
def g18(spark, sf):
    word = F.split("p_name", " ")
    roles = table(spark, sf, "part").select(
        F.col("p_brand").alias("role"),
        F.concat_ws(
            ":", F.lower("p_type"), F.when(F.col("p_size") < 10, "*").otherwise(word[1]),
            F.when(F.col("p_size") > 40, "*").otherwise(word[0]),
        ).alias("v1"),
    )
    return ro.map_v1_to_v2(roles, v1_map(spark, sf))


@query(
    "g19_permission_macro",
    f"""WITH {V1_SQL} SELECT DISTINCT tp AS type, permission, CAST(g AS INTEGER) AS and_group, kind,
    relation, CASE WHEN kind = 'arrow' THEN permission ELSE '' END AS target FROM (
      SELECT 'rbac/role' AS tp, permission, 0 AS g, 'rel' AS kind,
        unnest(['t_'||app||'_'||resource||'_'||verb, 't_'||app||'_'||resource||'_all', 't_'||app||'_all_'||verb,
                't_'||app||'_all_all', 't_all_all_all']) AS relation FROM v1map
      UNION ALL SELECT x.tp, permission, x.g, x.kind, x.relation FROM v1map, (VALUES
        ('rbac/role', 0, 'arrow', 't_child'), ('rbac/role_binding', 1, 'rel', 't_subject'),
        ('rbac/role_binding', 1, 'arrow', 't_role'), ('rbac/platform', 0, 'arrow', 't_binding'),
        ('rbac/tenant', 0, 'arrow', 't_binding'), ('rbac/tenant', 0, 'arrow', 't_platform'),
        ('rbac/workspace', 0, 'arrow', 't_binding'), ('rbac/workspace', 0, 'arrow', 't_parent')
      ) x(tp, g, kind, relation))""",
)
def g19(spark, sf):
    return ro.expand_permission_macro(v1_map(spark, sf))


@query(
    "g20_default_assignments",
    """SELECT c_name AS username, n_name AS role FROM customer, nation
    WHERE n_regionkey = 0 OR (n_regionkey = 1 AND c_acctbal > 9000)
    UNION SELECT c_name, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey""",
)
def g20(spark, sf):
    customer, nation = table(spark, sf, "customer"), table(spark, sf, "nation")
    people = customer.select(F.col("c_name").alias("username"), (F.col("c_acctbal") > 9000).alias("is_org_admin"))
    flagged = nation.select(
        F.col("n_name").alias("role"), (F.col("n_regionkey") == 0).alias("platform_default"),
        (F.col("n_regionkey") == 1).alias("admin_default"),
    )
    explicit = customer.join(nation, customer.c_nationkey == nation.n_nationkey).select(
        F.col("c_name").alias("username"), F.col("n_name").alias("role")
    )
    return ro.default_assignments(people, flagged, explicit)


@query(
    "g21_verb_prerequisites",
    """WITH RECURSIVE verb AS (SELECT DISTINCT p_brand||'|'||(p_partkey % 2) AS app, p_type AS resource, p_size AS n FROM part),
    inc AS (SELECT app, resource, n, n AS m FROM verb
            UNION SELECT i.app, i.resource, i.n, i.m // 2 FROM inc i
            JOIN verb v ON v.app = i.app AND v.resource = i.resource AND v.n = i.m WHERE i.m > 1)
    SELECT app, resource, 'v'||n AS verb, 'v'||m AS includes FROM inc""",
)
def g21(spark, sf):
    verbs = table(spark, sf, "part").select(
        F.concat("p_brand", F.lit("|"), F.col("p_partkey") % 2).alias("app"), F.col("p_type").alias("resource"),
        F.concat(F.lit("v"), F.col("p_size")).alias("verb"),
        F.when(F.col("p_size") > 1, F.concat(F.lit("v"), F.expr("p_size div 2"))).alias("requires"),
    ).distinct()
    return ro.close_requires(verbs)


@query(
    "g22_access_diff",
    f"""WITH RECURSIVE {ACCESS_SQL}, member2(g, u) AS (
      SELECT res_id, sub_id FROM tup WHERE relation = 't_member' AND sub_rel = ''
      UNION SELECT t.res_id, m.u FROM (
        SELECT res_id, sub_id FROM tup WHERE relation = 't_member' AND sub_rel = 'member' AND res_id <> 'gr0'
        UNION ALL SELECT 'gr1', 'gn0') t JOIN member2 m ON t.sub_id = m.g),
    after AS (SELECT DISTINCT s.tp, s.id, s.permission, coalesce(m.u, s.sub_id) AS u FROM scopegrant s
      LEFT JOIN member2 m ON s.sub_rel = 'member' AND m.g = s.sub_id WHERE s.sub_rel = '' OR m.u IS NOT NULL),
    diff AS (SELECT tp, id, permission, u, 'lost' AS change FROM (SELECT tp, id, permission, u FROM scopeuser EXCEPT SELECT * FROM after)
      UNION ALL SELECT tp, id, permission, u, 'gained' FROM (SELECT * FROM after EXCEPT SELECT tp, id, permission, u FROM scopeuser))
    SELECT tp AS type, id, permission, u AS principal, change FROM diff
    UNION ALL SELECT 'hbi/host', h.res_id, CASE d.permission WHEN 'inventory_host_view' THEN 'view' ELSE 'update' END, d.u, d.change
    FROM tup h JOIN diff d ON d.tp = h.sub_type AND d.id = h.sub_id
    WHERE h.relation = 't_workspace' AND d.permission <> 'patch_system_view_assigned'""",
)
def g22(spark, sf):
    """What one regrouping changes at scopes and on hosts, from the changed tuples on."""
    t, rules = graph(spark, sf), host_model(spark)[0]
    removed = t.where((F.col("relation") == "t_member") & (F.col("sub_rel") == "member") & (F.col("res_id") == "gr0"))
    added = table(spark, sf, "nation").where("n_nationkey = 0").select(
        F.lit(GROUP).alias("res_type"), F.lit("gr1").alias("res_id"), F.lit("t_member").alias("relation"),
        F.lit(GROUP).alias("sub_type"), F.concat(F.lit("gn"), F.col("n_nationkey")).alias("sub_id"),
        F.lit("member").alias("sub_rel"),
    )
    leaves = [p for *_, p in ro.HOST_PERMISSIONS]
    targets = {(scope, p) for scope in (WS, TENANT, PLATFORM) for p in leaves} | {(HOST, "view"), (HOST, "update")}
    diff = ev.access_changes(t, removed, added, rules, targets)
    return diff.select(F.col("res_type").alias("type"), F.col("res_id").alias("id"), "permission", F.col("sub_id").alias("principal"), "change")
