"""Objects that share grants: opened once per set, rows handed out without a shuffle of the result."""

from __future__ import annotations

from pyspark.sql import functions as F

from grantflow import model as m
from grantflow.functions import sets
from grantflow.functions.sets import by_set, hand_out
from grantflow.operators import evaluate as ev
from grantflow.operators import migrate as mi
from grantflow.operators import roles as ro
from grantflow.session import cut_table

GRANTS = "type string, id string, permission string, sub_type string, sub_id string, sub_rel string"
MEMBERS = "type string, id string, name string, sub_type string, sub_id string"


def shared(spark):
    rows = [("ws", f"w{i}", "p", "group", g, "member") for i in range(6) for g in ("a", "b")[: 1 + i % 2]]
    rows += [("ws", f"w{i}", "q", "group", "b", "member") for i in range(6)]
    rows += [("ws", "w0", "p", "user", "x", ""), ("ws", "w0", "p", "user", "x", ""), ("ws", "w1", "p", "user", "lone", ""),
             ("ws", "w9", "p", "user", "*", ""), ("ws", "w9", "q", "user", "y", ""), ("ws", None, "p", "group", "a", "member")]
    members = [("group", "a", "member", "user", u) for u in ("x", "y")] + [("group", "b", "member", "user", u) for u in ("y", "z")]
    return spark.createDataFrame(rows, GRANTS), spark.createDataFrame(members, MEMBERS)


def rows_of(df):
    return sorted(df.collect(), key=str)


def made_distinct_last(df):
    return df._jdf.queryExecution().optimizedPlan().toString().startswith("Aggregate")


def plainly(grants, members):
    m_ = members.select(F.col("type").alias("sub_type"), F.col("id").alias("sub_id"), F.col("name").alias("sub_rel"),
                        F.col("sub_type").alias("t"), F.col("sub_id").alias("i"))
    opened = grants.join(m_, ["sub_type", "sub_id", "sub_rel"]).select(
        "type", "id", "permission", F.col("t").alias("sub_type"), F.col("i").alias("sub_id"), F.lit("").alias("sub_rel"))
    return grants.where("sub_rel = ''").unionByName(opened).distinct()


def test_open_usersets_once_per_set(spark):
    grants, members = shared(spark)
    got = ev.open_usersets(grants, members)
    assert rows_of(got) == rows_of(plainly(grants, members))
    assert not made_distinct_last(got)


def test_intersection_once_per_set(spark):
    grants, members = shared(spark)
    first, second = (grants.where(F.col("permission") == p) for p in "pq")
    got = ev.intersect_grants(first, second, ["type", "id"], members)
    opened = plainly(grants, members)
    want = ev.intersect_permission(opened.where("permission = 'p'"), opened.where("permission = 'q'"), ["type", "id"])
    assert rows_of(got) == rows_of(want) and want.count() == 10
    assert not made_distinct_last(got)


def test_contingent_hands_out_sets(spark):
    grants, members = shared(spark)
    got = ro.contingent(grants, "p", "q", "both", members)
    assert {(r.id, r.sub_id) for r in got.where("id in ('w0', 'w1', 'w9')").collect()} == {
        ("w0", "y"), ("w1", "y"), ("w1", "z"), ("w9", "y")}
    assert not made_distinct_last(got)


def test_gate_with_closed_usersets(spark):
    grants, members = shared(spark)
    view, scoped = grants.where("permission = 'p'"), grants.where("permission = 'q'")
    opened = plainly(grants, members)
    want = ro.gate_on_view(opened.where("permission = 'p'"), opened.where("permission = 'q'"))
    assert rows_of(ro.gate_on_view(view, scoped, members).select(*want.columns)) == rows_of(want)


def test_arrow_of_one_place_is_not_made_distinct(spark):
    grants, _ = shared(spark)
    links = [("host", f"h{i}", "at", "ws", f"w{i % 6}", "") for i in range(12)]
    one = m.tuples_frame(spark, links)
    assert not made_distinct_last(ev.arrow_permission(one, grants, "host", "at"))
    two = m.tuples_frame(spark, [*links, ("host", "h0", "at", "ws", "w1", ""), ("host", "h0", "at", "ws", "w2", "")])
    got = ev.arrow_permission(two, grants, "host", "at")
    assert got.count() == got.distinct().count()
    assert got.where("id = 'h0' and permission = 'q'").count() == 1


def test_hand_out_spreads_large_sets(spark):
    facts = [(f"o{i}", f"s{j}") for i in range(40) for j in range(7)] + [("lone", f"s{j}") for j in range(90)]
    df = spark.createDataFrame(facts, "o string, s string")
    objects, rows = by_set(df, ["o"])
    assert rows.count() == 97
    got = hand_out(objects, rows, rows_per_task=20)
    assert rows_of(got.select("o", "s")) == rows_of(df)
    assert got.rdd.getNumPartitions() >= 2 * (370 // 20)


def test_hand_out_bounds_partitions_and_packs_rows(spark, monkeypatch):
    monkeypatch.setattr(sets, "MOST_TASKS", 8)
    monkeypatch.setattr(sets, "LIST_ROWS", 16)
    facts = [(f"o{i}", f"s{j}", None if j % 2 else "t") for i in range(30) for j in range(50)] + [(f"p{i}", f"s{j}", "t") for i in range(3) for j in range(2)]
    df = spark.createDataFrame(facts, "o string, s string, t string")
    objects, rows = by_set(df, ["o"])
    got = hand_out(objects, rows, rows_per_task=20)
    assert got.columns == ["o", "s", "t"] and rows_of(got) == rows_of(df)
    assert got.rdd.getNumPartitions() <= 8


def test_shared_grants_reach_objects_as_plain_ones(spark):
    grants, members = shared(spark)
    links = [("host", f"h{i}", "at", "ws", f"w{i % 10}", "") for i in range(20)]
    links += [("host", "h0", "at", "ws", "w1", ""), ("host", "h0", "at", "ws", "w1", ""), ("host", None, "at", "ws", "w2", ""), ("host", "h5", "at", "ws", None, "")]
    t = m.tuples_frame(spark, links)
    want = plainly(ro.resource_grants(t, grants, "host", "at"), members)
    parts = ev.open_usersets(grants, members, shared=True)
    assert parts[0].rows.where("sub_id = 'z'").count() < want.where("sub_id = 'z'").count()
    assert rows_of(ro.resource_grants(t, parts, "host", "at").select(*want.columns)) == rows_of(want)


def test_gate_keeps_sets(spark):
    grants, members = shared(spark)
    view, asked = grants.where("permission = 'p'"), ro.contingent(grants, "p", "q", "both", members)
    want = ro.gate_on_view(view, asked, members)
    got = ro.gate_on_view(view, ro.contingent(grants, "p", "q", "both", members, shared=True), members)
    assert got.rows.select("_set").distinct().count() < got.objects.count()
    assert rows_of(hand_out(got.objects, got.rows).select(*want.columns)) == rows_of(want)


def test_cut_tables_are_counted_as_they_are_written(spark):
    jobs = lambda: len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
    before = jobs()
    made = cut_table(spark.range(10))
    assert jobs() == before + 1
    assert made.rows == 10 == made.df.count() and cut_table(spark.range(10).where("id > 20")).rows == 0


def test_lookups_hand_out_sets(spark):
    t = m.tuples_frame(spark, [("folder", "f", "viewer", "group", "g", "member"), ("group", "g", "member", "user", "u", ""), ("group", "g", "member", "user", "v", "")]
                 + [("doc", f"d{i}", "parent", "folder", "f", "") for i in range(5)])
    rules = [*m.any_of("folder", "view", m.rel("viewer")), *m.any_of("doc", "view", m.arrow("parent", "view"))]
    who = spark.createDataFrame([("user", "u"), ("user", "w")], "sub_type string, sub_id string")
    got = ev.lookup_resources(t, rules, "doc", "view", who)
    assert {(r.sub_id, r.res_id) for r in got.collect()} == {("u", f"d{i}") for i in range(5)}
    assert not made_distinct_last(got)
    docs = spark.createDataFrame([("doc", f"d{i}") for i in range(3)], "res_type string, res_id string")
    got = ev.lookup_subjects(t, rules, docs, "view")
    assert {(r.res_id, r.sub_id) for r in got.collect()} == {(f"d{i}", u) for i in range(3) for u in "uv"}
    assert got.count() == 6 and not made_distinct_last(got)


def test_effective_access_keeps_one_copy_of_a_set(spark, monkeypatch):
    t = m.tuples_frame(spark, [("folder", f"f{i}", r, "group", g, "member") for i in range(8) for r, g in (("viewer", "g"), ("owner", "h"))]
                 + [("group", g, "member", "user", u, "") for g, us in (("g", "uv"), ("h", "vw")) for u in us]
                 + [("doc", f"d{i}", "parent", "folder", f"f{i % 8}", "") for i in range(16)])
    rules = [*m.all_of("folder", "both", m.rel("viewer"), m.rel("owner")), *m.any_of("doc", "both", m.arrow("parent", "both"))]
    seen, kept = [], ev._on_top

    def on_top(opened, *rest):
        seen.append(opened.where("type = 'folder'").select("id").distinct().count())
        return kept(opened, *rest)

    monkeypatch.setattr(ev, "_on_top", on_top)
    got = {(r.res_id, r.sub_id) for r in ev.effective_access(t, rules).where("permission = 'both'").collect()}
    assert got == {(f"f{i}", "v") for i in range(8)} | {(f"d{i}", "v") for i in range(16)}
    assert seen == [1]


def test_migration_shuffles_entities_not_links(spark):
    rows = [("w1", "o", "a", "x", "user:e user:e", "group:g#m"), ("w1", "o", "a", "y", "user:e", None), (None, "o", "a", "x", None, None), (None, "o", "a", "x", None, None)]
    df = spark.createDataFrame(rows, "workspace_id string, org_id string, owner string, admins string, editors string, viewers string")
    out = mi.workspace_migration(df)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(res_id" in plan and "hashpartitioning(relation" not in plan
    assert out.columns == [*mi.TUPLE_COLS, "valid"]
    got = out.collect()
    assert len(got) == len(set(got)) == 6 + 3, got


def test_bulk_checks_ask_a_set_once(spark, monkeypatch):
    t = m.tuples_frame(spark, [("folder", "f", "viewer", "group", "g", "member"), ("group", "g", "member", "user", "u", ""), ("folder", "f", "viewer", "user", None, "")]
                       + [("doc", f"d{i}", "parent", "folder", "f", "") for i in range(5)])
    rules = [*m.any_of("folder", "view", m.rel("viewer")), *m.any_of("doc", "view", m.arrow("parent", "view"))]
    ask = [("doc", f"d{i}", "view", "user", u) for i in range(6) for u in ("u", "w", None)]
    requests = spark.createDataFrame(ask + ask[:1], "res_type string, res_id string, permission string, sub_type string, sub_id string")
    seen, join = [], ev.spread_join

    def spread_join(big, other, on, **how):
        if on == [*ev.SET, *ev.HOLDER]:
            seen.append(big.select(*ev.SET, "sub_type", "sub_id").distinct().count())
        return join(big, other, on, **how)

    monkeypatch.setattr(ev, "spread_join", spread_join)
    got = ev.check_bulk(requests, t, rules).collect()
    assert len(got) == 19 and sum(r.allowed for r in got) == 6
    assert {(r.res_id, r.sub_id) for r in got if r.allowed} == {(f"d{i}", "u") for i in range(5)}
    assert seen == [2]


def test_placed_resources_get_the_sets_of_their_places(spark, monkeypatch):
    t = m.tuples_frame(spark, [("folder", f, "viewer", "group", f"g{f}", "member") for f in "ab"] + [("group", f"g{f}", "member", "user", f"u{f}", "") for f in "ab"]
                       + [("doc", f"d{i}", "parent", "folder", "ab"[i % 2], "") for i in range(6)] + [("doc", "d0", "parent", "folder", "b", ""), ("folder", "b", "viewer", "user", "*", "")])
    rules = [*m.any_of("folder", "view", m.rel("viewer")), *m.any_of("doc", "view", m.arrow("parent", "view"))]
    columns = "res_type string, res_id string, permission string, sub_type string, sub_id string"
    requests = spark.createDataFrame([(*o, p, "user", u) for o in [*[("doc", f"d{i}") for i in range(7)], ("folder", "a")] for p in ("view", "none") for u in ("ua", "ub", "x")], columns)
    seen, kept = [], ev.saturate

    def saturate(*args, **how):
        found = kept(*args, **how)
        seen.append(found.where("type = 'doc'").count())
        return found

    monkeypatch.setattr(ev, "saturate", saturate)
    got = {(r.res_id, r.sub_id) for r in ev.check_bulk(requests, t, rules).where("allowed").collect()}
    odd = {(f"d{i}", u) for i in (1, 3, 5) for u in ("ua", "ub", "x")}
    assert got == odd | {("d0", u) for u in ("ua", "ub", "x")} | {("d2", "ua"), ("d4", "ua"), ("a", "ua")}
    seen.clear()
    who = spark.createDataFrame([("user", "ua"), ("user", "ub")], "sub_type string, sub_id string")
    found = sorted((r.sub_id, r.res_id) for r in ev.lookup_resources(t, rules, "doc", "view", who).collect())
    every = [(u, d) for u, ds in (("*", "0135"), ("ua", "024"), ("ub", "0135")) for d in (f"d{i}" for i in ds)]
    assert found == every
    assert set(seen) == {0}


def test_changes_reach_placed_objects_at_the_end(spark, monkeypatch):
    t = m.tuples_frame(spark, [("folder", f, "viewer", "group", "g", "member") for f in "ab"] + [("group", "g", "member", "user", u, "") for u in "uv"]
                       + [("doc", f"d{i}", "parent", "folder", "ab"[i % 2], "") for i in range(6)])
    rules = [*m.any_of("folder", "view", m.rel("viewer")), *m.any_of("doc", "view", m.arrow("parent", "view"))]
    targets = {("doc", "view"), ("folder", "view")}
    removed = m.tuples_frame(spark, [("group", "g", "member", "user", "u", "")])
    moved_doc = m.tuples_frame(spark, [("doc", "d0", "parent", "folder", "a", "")])
    second = m.tuples_frame(spark, [("doc", "d0", "parent", "folder", "b", "")])
    none = removed.where("false")
    seen, kept = [], ev.saturate

    def saturate(*args, **how):
        found = kept(*args, **how)
        seen.append(found.where("type = 'doc'").count())
        return found

    monkeypatch.setattr(ev, "saturate", saturate)

    def changes(before, removed, added):
        seen.clear()
        return sorted((r.res_type, r.res_id, r.sub_id, r.change) for r in ev.access_changes(before, removed, added, rules, targets).collect())

    all_docs = [("doc", f"d{i}") for i in range(6)]
    assert changes(t, removed, none) == [(*o, "u", "lost") for o in [*all_docs, ("folder", "a"), ("folder", "b")]]
    assert set(seen) == {0}
    # A doc that moves, or has two places, is looked at itself.
    assert changes(t, moved_doc, none) == [("doc", "d0", u, "lost") for u in "uv"]
    assert changes(t, moved_doc, second) == []
    two = t.unionByName(second)
    assert changes(two, t.where("res_type = 'folder' and res_id = 'a'"), none) == [
        *[("doc", d, u, "lost") for d in ("d2", "d4") for u in "uv"], *[("folder", "a", u, "lost") for u in "uv"]]
