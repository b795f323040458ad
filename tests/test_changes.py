import json

import pytest
from pyspark.sql import functions as F

from grantflow.model import LIVE_XID
from grantflow.operators import cache as ca
from grantflow.operators import integrity as it
from grantflow.operators import relate as re
from grantflow.operators import select as se
from grantflow.operators import writes as wr
from grantflow.sources import cdc, directory
from grantflow.sources.tuples import read_tuples_nested, read_tuples_text
from grantflow.streaming import jobs

from . import models as m

CHANGE = "id string, tenant_id string, op string, lsn long"


def keys(df):
    return sorted((r.res_id, r.sub_id) for r in df.collect())


def test_read_text_and_nested(spark, tmp_path):
    rows = [{"resource": r, "relation": rel, "subject": s} for r, rel, s in m.CODE_HOSTING_TUPLES]
    (tmp_path / "t.json").write_text(json.dumps(rows + [{"resource": "a:b", "relation": "x", "subject": "bob"}], indent=2))
    got = read_tuples_text(spark, str(tmp_path / "t.json"))
    assert sorted(map(tuple, got.collect())) == sorted(m.rows(m.CODE_HOSTING_TUPLES))
    body = {
        "tuples": [
            {
                "resource": {"type": {"namespace": "rbac", "name": "role_binding"}, "id": "b"}, "relation": "t_subject",
                "subject": {"subject": {"type": {"namespace": "rbac", "name": "group"}, "id": "g"}, "relation": "member"},
            }
        ]
    }
    got = read_tuples_nested(spark.createDataFrame([(json.dumps(body),)], "value string"))
    assert tuple(got.first()) == ("rbac/role_binding", "b", "t_subject", "rbac/group", "g", "member")


def test_directory_and_permission_documents(spark, tmp_path):
    doc = {
        "principals": [{"username": "alice", "org_id": "acme", "is_org_admin": True,
                        "groups": [{"name": "admins", "uuid": "g1"}], "roles": [{"name": "Admin", "uuid": "r1"}]}],
        "groups": [{"uuid": "g1", "name": "admins"}],
        "roles": [{"uuid": "r1", "name": "Admin", "permissions": ["*:*:*", "host:read:*"]}],
    }
    (tmp_path / "d.json").write_text(json.dumps(doc, indent=1))
    flat = directory.flatten_directory(directory.read_directory(spark, str(tmp_path / "d.json")))
    assert {n: df.count() for n, df in flat.items()} == {
        "principals": 1, "membership": 1, "assignment": 1, "groups": 1, "roles": 1, "role_permissions": 2}
    text = '{"_comment": "x", "*": [{"verb": "read"}], "things": [{"verb": "write", "requires": ["read"]}]}'
    got = directory.flatten_permission_config(spark.createDataFrame([("app", text)], "app string, value string"))
    assert {tuple(r) for r in got.collect()} == {("app", "*", "read", None), ("app", "things", "write", "read")}


def test_end_state_ignores_order_and_repeats(spark):
    log = [("w1", "A", "c", 1), ("w1", "B", "u", 5), ("w2", "A", "r", 2), ("w2", "A", "d", 7), ("w3", None, "c", 3)]
    want = [("w1", "B")]
    for rows in (log, log[::-1], log + log):
        assert keys(re.cdc_tuples(spark.createDataFrame(rows, CHANGE))) == want
    base = re.cdc_tuples(spark.createDataFrame(log[:1], CHANGE))
    assert keys(wr.cdc_update(base, spark.createDataFrame(log[1:2], CHANGE))) == want  # no stale parent


def test_malformed_and_unknown_events(spark):
    good = json.dumps({"id": "w1", "tenant_id": "t", "__op": "c", "__table": "workspaces", "__lsn": 1, "__deleted": "false"})
    odd = json.dumps({"id": "w2", "__op": "x", "__table": "workspaces"})
    other = json.dumps({"id": "w3", "__op": "c", "__table": "users"})
    df = spark.createDataFrame([("1", good), ("2", '{"id": "w'), ("3", odd), ("4", other)], "key string, value string")
    ok, bad = cdc.decode_flat_cdc(df)
    assert [r.key for r in bad.collect()] == ["2"]
    assert {r.key: r.route for r in re.dispatch(ok).collect()} == {"1": "workspace_create", "3": "skipped", "4": "skipped"}


def test_operation_header(spark):
    df = spark.createDataFrame(
        [(1, None, "deleted"), (2, "", "updated"), (3, "deleted", None), (4, None, None), (5, "odd", None)],
        "n int, header string, payload_operation string",
    )
    assert {r.n: r.resolved for r in cdc.resolve_operation(df).collect()} == {1: "deleted", 2: "updated", 3: "deleted", 4: "created"}
    strict = {r.n: r.resolved for r in cdc.resolve_operation(df, strict_header=True).collect()}
    assert strict == {1: "created", 2: "updated", 3: "deleted", 4: "created"}


def test_versions(spark):
    t = ("ws", "w", "owner", "user", "u", "")
    log = [(*t, "TOUCH", 3), (*t, "TOUCH", 5), (*t, "DELETE", 9), (*t, "DELETE", 11), (*t, "TOUCH", 25)]
    df = spark.createDataFrame(
        log, "res_type string, res_id string, relation string, sub_type string, sub_id string, sub_rel string, op string, lsn long"
    )
    v = wr.to_versions(df, block=4)
    assert sorted((r.created_xid, r.deleted_xid) for r in v.collect()) == [(3, 9), (25, LIVE_XID)]
    assert [wr.as_of(v, x).count() for x in (2, 3, 8, 9, 24, 25)] == [0, 1, 1, 0, 0, 1]
    assert wr.at_least(v, 25).first().fresh and not wr.at_least(v, 26).first().fresh


def test_create_reports_conflicts_and_delete_needs_a_filter(spark):
    import pytest

    t = m.tuples(spark, m.CODE_HOSTING_TUPLES)
    new = m.tuples(spark, [("organization:acmecorp", "member", "user:bob"), ("organization:acmecorp", "member", "user:zoe")])
    after, conflicts = wr.create(t, new)
    assert after.count() == 17 and [r.sub_id for r in conflicts.collect()] == ["bob"]
    assert wr.delete_where(t, resource_type="team").count() == 13
    with pytest.raises(ValueError):
        wr.delete_where(t)


def test_cache_edges(spark):
    d = spark.createDataFrame([("a", 0), ("b", 1)], "res_id string, s int").withColumn("cached_at", F.timestamp_seconds("s"))
    assert [r.res_id for r in ca.fresh(d, F.timestamp_seconds(F.lit(60))).collect()] == ["b"]
    empty = spark.createDataFrame([], "hit boolean")
    assert ca.cache_stats(empty).first().asDict() == {"hits": 0, "misses": 0, "total": 0, "hit_rate": 0.0}


def test_validation_cases(spark):
    u = "550e8400-e29b-41d4-a716-446655440001"
    rows = [("a", u), ("b", "0123456789"), ("c", None), ("d", "123456789")]
    df = spark.createDataFrame(rows, "id string, satellite_id string")
    for c in ("subscription_manager_id", "insights_id", "ansible_host"):
        df = df.withColumn(c, F.lit(None).cast("string"))
    df = df.withColumn("workspace_id", F.lit("w"))
    assert {r.id: r.valid for r in se.validate_resources(df, se.HOST_SPEC).collect()} == {"a": True, "b": True, "c": True, "d": False}


def test_lint_and_cardinality(spark):
    t = m.tuples(spark, [("d:1", "t_workspace", "w:1"), ("d:1", "t_workspace", "w:2"), ("w:1", "t_parent", "d:1")])
    ents = spark.createDataFrame([("d", "1"), ("d", "2")], "res_type string, res_id string")
    kinds = {"ExactlyOne": {("1", 2), ("2", 0)}, "AtMostOne": {("1", 2)}, "AtLeastOne": {("2", 0)}, "Any": set()}
    for kind, wrong in kinds.items():
        spec = spark.createDataFrame([("d", "t_workspace", kind), ("w", "t_parent", "ExactlyOne")], "res_type string, relation string, cardinality string")
        assert {(r.res_id, r.n) for r in it.check_cardinality(t.unionByName(t), ents, spec).collect()} == wrong
    unknown = spark.createDataFrame([("d", "t_workspace", "Some")], "res_type string, relation string, cardinality string")
    with pytest.raises(ValueError, match="unknown cardinality"):
        it.check_cardinality(t, ents, unknown)
    allowed = spark.createDataFrame(
        [("d", "t_workspace", "w", "", False), ("w", "t_parent", "w", "", False)],
        "res_type string, relation string, sub_type string, sub_rel string, wildcard boolean",
    )
    assert [(r.res_type, r.sub_type) for r in it.check_subject_types(t, allowed).collect()] == [("w", "d")]


def write_messages(spark, path, rows):
    df = spark.createDataFrame(rows, "key string, value string").select(
        F.lit("workspaces.events").alias("topic"), F.lit(0).alias("partition"), F.lit(0).cast("long").alias("offset"),
        F.current_timestamp().alias("timestamp"), "key", "value",
        F.create_map(F.lit("a"), F.lit("b")).alias("headers"),
    )
    df.coalesce(1).write.mode("append").parquet(path)


def message(id_, tenant, op, lsn):
    return (id_, json.dumps({"id": id_, "tenant_id": tenant, "__op": op, "__table": "workspaces", "__lsn": lsn}))


def test_stream_equals_batch_over_restarts_replay_and_compaction(spark, tmp_path):
    src, state = str(tmp_path / "in"), str(tmp_path / "state")
    table = jobs.workspace_table(spark, str(tmp_path / "table"))
    bad = []
    keep_bad = lambda df, _: bad.extend(r.key for r in df.collect())

    def go():
        jobs.workspace_stream(jobs.read_event_stream(spark, src), table, state, on_bad=keep_bad).awaitTermination()

    write_messages(spark, src, [message("w1", "A", "c", 1), message("w2", "A", "c", 2), ("x", "{")])
    go()
    write_messages(spark, src, [message("w1", "B", "u", 9), message("w2", "A", "d", 8), message("w1", "A", "c", 1)])
    go()
    assert keys(jobs.current_tuples(table)) == [("w1", "B")] and bad == ["x"]
    again = spark.createDataFrame([("w1", "B", "u", 9), ("w2", "A", "d", 8)], CHANGE)
    table.put(again, 1)  # a replayed batch
    assert keys(jobs.current_tuples(table)) == [("w1", "B")]
    table.compact()
    write_messages(spark, src, [message("w3", "C", "c", 10), message("w1", "A", "u", 3)])
    go()
    assert keys(jobs.current_tuples(table)) == [("w1", "B"), ("w3", "C")]


def test_failure_between_outputs_changes_nothing(spark, tmp_path):
    """The table fails after the dead letters were written; the batch is done again and every output has it once."""
    src, state, out = str(tmp_path / "in"), str(tmp_path / "state"), str(tmp_path / "out")
    table = jobs.workspace_table(spark, str(tmp_path / "table"))
    put, calls = table.put, []

    def failing(changes, batch_id):
        calls.append(batch_id)
        if len(calls) == 1:
            raise RuntimeError("lost")
        put(changes, batch_id)

    table.put = failing

    def go():
        jobs.workspace_stream(jobs.read_event_stream(spark, src), table, state, outputs=out).awaitTermination()

    write_messages(spark, src, [message("w1", "A", "c", 1), ("x", "{"), ("y", "{")])
    with pytest.raises(Exception, match="lost"):
        go()
    assert spark.read.parquet(f"{out}/dead").count() == 2
    go()
    write_messages(spark, src, [message("w2", "B", "c", 2), ("z", "nothing")])
    go()
    assert calls == [0, 0, 1] and keys(jobs.current_tuples(table)) == [("w1", "A"), ("w2", "B")]
    assert sorted(r.key for r in spark.read.parquet(f"{out}/dead").collect()) == ["x", "y", "z"]
    counts = spark.read.parquet(f"{out}/counts").orderBy("batch_id").collect()
    assert [(r.batch_id, r.good, r.bad) for r in counts] == [(0, 1, 2), (1, 1, 1)]


def test_batches_written_again_count_once(spark, tmp_path):
    from grantflow.sources import sinks

    rows = spark.createDataFrame([("t1", "a"), ("t2", "b")], "topic string, key string")
    path = str(tmp_path / "topics")
    for batch in (0, 1, 1, 0):
        sinks.write_by_topic(rows, path, batch)
    assert sorted(map(tuple, sinks.read_batches(rows, path).collect())) == [("t1", "a"), ("t1", "a"), ("t2", "b"), ("t2", "b")]
