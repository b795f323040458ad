"""Two migrations with their expected decisions, and the role-binding walk-through."""

from pyspark.sql import functions as F

from grantflow.model import TUPLE_COLS
from grantflow.operators import evaluate as ev
from grantflow.operators import integrity as it
from grantflow.operators import migrate as mi
from grantflow.operators import roles as ro
from grantflow.operators import writes as wr
from grantflow.session import cut, literal_table

from . import models as m

G = "550e8400-e29b-41d4-a716-44665544000"
SRE, DEV = f"group:{G}2#member", f"group:{G}3#member"


def frame(spark, columns, rows):
    return literal_table(spark, rows, ", ".join(f"{c} string" for c in columns.split()))


def rbac_links(spark):
    orgs = frame(spark, "org_id admins members", [("acme-corp", "alice", "bob carol dave"), ("partner-corp", "", "eve")])
    groups = frame(
        spark, "group_id org_id members admin",
        [(G + "1", "acme-corp", "alice", "alice"), (G + "2", "acme-corp", "bob dave", "bob"),
         (G + "3", "acme-corp", "bob carol", "alice"), (G + "4", "acme-corp", "carol", "carol"),
         (G + "5", "partner-corp", "eve", "")],
    )
    spaces = frame(
        spark, "workspace_id org_id owner admins editors viewers",
        [("production", "acme-corp", "alice", "bob", SRE, DEV), ("staging", "acme-corp", "bob", "", DEV, ""),
         ("development", "acme-corp", "carol", "", DEV, "")],
    )
    apps = frame(
        spark, "app_id org_id owner admins users",
        [("advisor", "acme-corp", "alice", "bob", DEV), ("vulnerability", "acme-corp", "alice", "", SRE),
         ("patch", "acme-corp", "bob", "", SRE)],
    )
    return [mi.org_tuples(orgs), mi.group_tuples(groups), mi.workspace_migration(spaces), mi.application_migration(apps)]


def union(parts):
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def test_role_migration(spark):
    every = union(rbac_links(spark))
    bad = mi.rejected(every).collect()
    assert [(r.res_id, r.relation, r.sub_id) for r in bad] == [("advisor", "admin", "bob")]
    t = cut(mi.accepted(every).distinct())
    assert t.count() == 41
    golden = [
        ("user:alice", "organization:acme-corp", "manage", True), ("user:bob", "organization:acme-corp", "view", True),
        ("user:alice", "organization:partner-corp", "manage", False), ("user:alice", "workspace:production", "manage", True),
        ("user:bob", "workspace:production", "edit", True), ("user:carol", "workspace:production", "view", True),
        ("user:carol", "application:advisor", "access", True), ("user:dave", "application:vulnerability", "access", True),
        ("user:bob", "application:advisor", "manage", False), ("user:eve", "workspace:production", "view", False),
    ]
    assert all(r.ok for r in ev.validate_decisions(m.requests(spark, golden), t, m.RBAC).collect())
    bob = frame(spark, "sub_type sub_id", [("user", "bob")])
    carol = frame(spark, "sub_type sub_id", [("user", "carol")])
    got = ev.lookup_resources(t, m.RBAC, "workspace", "view", bob)
    assert {r.res_id for r in got.collect()} == {"development", "production", "staging"}
    got = ev.lookup_resources(t, m.RBAC, "application", "access", carol)
    assert {r.res_id for r in got.collect()} == {"advisor"}
    who = ev.lookup_subjects(t, m.RBAC, frame(spark, "res_type res_id", [("workspace", "production")]), "view")
    assert {r.sub_id for r in who.collect()} == {"alice", "bob", "carol", "dave"}
    joined = wr.touch(t, m.tuples(spark, [(f"group:{G}3", "member", "user:eve")]))
    ask = m.requests(spark, [("user:eve", "workspace:production", "view", True)])
    assert ev.check_bulk(ask, joined, m.RBAC).first().allowed
    report = {(r.kind, r.name): r.n for r in it.migration_report(t).collect()}
    assert report["entities", "workspace"] == 3 and report["entities", "group"] == 5 and report["members", G + "2"] == 2


def test_inventory_migration(spark):
    spaces = frame(
        spark, "workspace_id org_id owner admins operators viewers",
        [("production", "acme-corp", "alice", "user:bob", SRE, DEV), ("staging", "acme-corp", "bob", "", DEV, "")],
    )
    groups = frame(
        spark, "group_id org_id workspace_id owner admins members",
        [("web-servers", "acme-corp", "production", "alice", SRE, DEV), ("databases", "acme-corp", "production", "alice", SRE, SRE),
         ("cache-servers", "acme-corp", "production", "bob", SRE, "")],
    )
    hosts = frame(
        spark, "host_id org_id workspace_id host_group_id owner admins operators viewers can_view_system_profile can_view_facts",
        [("web-01.acme.com", "acme-corp", "production", "web-servers", "alice", "", SRE, DEV, DEV, SRE),
         ("web-02.acme.com", "acme-corp", "production", "web-servers", "alice", "", SRE, DEV, DEV, SRE),
         ("db-01.acme.com", "acme-corp", "production", "databases", "alice", "user:bob", SRE, "", SRE, SRE)],
    )
    names = frame(
        spark, "namespace_id org_id admins",
        [("environment", "acme-corp", "user:alice"), ("cost-center", "acme-corp", "user:alice"), ("application", "acme-corp", "user:bob")],
    )
    tags = frame(
        spark, "tag_id org_id namespace_id admin can_apply",
        [("production", "acme-corp", "environment", "user:alice", SRE), ("staging", "acme-corp", "environment", "user:alice", DEV),
         ("engineering", "acme-corp", "cost-center", "user:alice", "user:alice user:bob")],
    )
    parts = [mi.inventory_workspace_migration(spaces), mi.host_group_migration(groups), mi.host_migration(hosts),
             mi.tag_namespace_migration(names), mi.tag_migration(tags), *rbac_links(spark)[:2]]
    t = cut(mi.accepted(union(parts)).distinct())
    assert t.count() == 86
    golden = [
        ("user:carol", "workspace:production", "view", True), ("user:bob", "workspace:production", "operate", True),
        ("user:carol", "host_group:web-servers", "view", True), ("user:alice", "host_group:web-servers", "add_host", True),
        ("user:carol", "host:web-01.acme.com", "read", True), ("user:bob", "host:web-01.acme.com", "update", True),
        ("user:bob", "host:db-01.acme.com", "read_facts", True), ("user:bob", "tag:production", "apply", True),
        ("user:eve", "host:web-01.acme.com", "read", False), ("user:carol", "host:web-01.acme.com", "read_system_profile", True),
        ("user:carol", "host:web-01.acme.com", "read_facts", False), ("user:alice", "host:web-01.acme.com", "delete", True),
        ("user:bob", "host:web-01.acme.com", "delete", True), ("user:carol", "host:web-01.acme.com", "delete", False),
        ("user:alice", "host_group:web-servers", "manage", True), ("user:bob", "host_group:web-servers", "add_host", True),
        ("user:carol", "tag:staging", "apply", True), ("user:carol", "tag:production", "apply", False),
        ("user:carol", "host:db-01.acme.com", "read", True),
    ]
    assert all(r.ok for r in ev.validate_decisions(m.requests(spark, golden), t, m.INVENTORY).collect())
    full = cut(ev.effective_access(t, m.INVENTORY))

    def who(**f):
        return {(r.sub_id, r.res_id) for r in full.where(" and ".join(f"{k} = '{v}'" for k, v in f.items())).collect()}

    assert {i for _, i in who(res_type="host", permission="read", sub_id="bob")} == {
        "db-01.acme.com", "web-01.acme.com", "web-02.acme.com"}
    assert not who(res_type="host", permission="update", sub_id="carol")
    assert {i for _, i in who(res_type="host_group", permission="view", sub_id="carol")} == {
        "cache-servers", "databases", "web-servers"}
    assert {s for s, _ in who(res_type="host", res_id="web-01.acme.com", permission="read")} == {"alice", "bob", "carol", "dave"}
    assert {s for s, _ in who(res_type="host", res_id="web-01.acme.com", permission="update")} == {"alice", "bob", "dave"}
    # Usersets left closed and opened at the end give the same answer.
    closed = ev.effective_access(t, m.INVENTORY, expand=False)
    members = ev.access_members(t, m.INVENTORY)
    opened = ev.open_usersets(
        closed.select(F.col("res_type").alias("type"), F.col("res_id").alias("id"), "permission", "sub_type", "sub_id", "sub_rel"),
        members,
    )
    assert opened.count() == full.count()


def test_role_binding_walk_through(spark):
    perms = literal_table(
        spark,
        [("inventory", "hosts", "read", "inventory_host_view"), ("inventory", "hosts", "write", "inventory_host_delete")],
        "app string, resource string, verb string, permission string",
    )
    from grantflow.model import Rule

    rules = ro.role_model_rules(
        perms,
        [Rule("hbi/host", "view", 0, "arrow", "t_workspace", "inventory_host_view"),
         Rule("hbi/host", "delete", 0, "arrow", "t_workspace", "inventory_host_delete")],
    )
    alice = "rbac/principal:alice"

    def asked(tuples, *golden):
        out = ev.validate_decisions(m.requests(spark, [(alice, *g) for g in golden]), tuples, rules)
        return [r for r in out.collect() if not r.ok]

    t = cut(m.tuples(spark, m.ROLE_DEMO_TUPLES))
    steps = [("rbac/group:engineering", "member"), ("rbac/workspace:production", "inventory_host_view"), ("hbi/host:web-server-01", "view")]
    assert not asked(t, *[(o, p, True) for o, p in steps], ("hbi/host:web-server-01", "delete", False))
    t = cut(wr.delete(t, m.tuples(spark, m.ROLE_DEMO_TUPLES[:1])))
    assert not asked(t, *[(o, p, False) for o, p in steps])
    t = cut(wr.touch(t, m.tuples(spark, m.ROLE_DEMO_STEP5)))
    assert not asked(t, *[(o, p, False) for o, p in steps], ("hbi/host:staging-app-01", "view", True))
    assert t.columns == TUPLE_COLS
