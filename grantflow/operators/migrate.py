"""Relational entities to relationship tuples.

Every entity row names its links in columns. A column of users or subjects holds one value, a blank-separated text
or an array; a column that points to another entity holds one id. All links of a row are listed in one pass.
Subjects given as text (``type:id`` or ``type:id#rel``) may be malformed; such links come out with
``valid = false`` and are never stored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.skew import estimated_bytes
from ..functions.text import parse_object
from ..model import TUPLE_COLS


def _values(df: DataFrame, col: str) -> Column:
    if isinstance(df.schema[col].dataType, T.ArrayType):
        return F.coalesce(F.col(col), F.array().cast("array<string>"))
    return F.split(F.trim(F.coalesce(F.col(col).cast("string"), F.lit(""))), r"\s+")


def entity_tuples(
    df: DataFrame, res_type: str, id_: str, *, refs: dict[str, str], users: dict[str, str], subjects: dict[str, str]
) -> DataFrame:
    """Links of entities as tuples plus ``valid``.

    ``refs`` maps a relation to the type it points to, with the id in column ``<type>_id`` (or given as
    ``type@column``). ``users`` and ``subjects`` map a relation to the column of user names or subject texts.
    """
    # Each link is (relation, type or null, text); texts without a known type are parsed after the explode.
    links = []
    for relation, target in refs.items():
        type_, _, col = target.partition("@")
        links.append(F.array(_link(relation, type_)(F.coalesce(F.col(col or f"{type_}_id").cast("string"), F.lit("")))))
    for relation, col in users.items():
        links.append(F.transform(_values(df, col), _link(relation, "user")))
    for relation, col in subjects.items():
        links.append(F.transform(_values(df, col), _link(relation, None)))
    # Links repeat only among rows of one entity, so entities are brought together before their links are listed, and
    # these are made distinct where they are.
    used = {col.partition("@")[2] or f"{col}_id" for col in refs.values()} | set(users.values()) | set(subjects.values())
    key = F.col(id_).cast("string")
    spread = F.when(key.isNull(), F.xxhash64(*sorted(used))).otherwise(F.lit(0)).alias("_spread")
    df = df.select(key.alias("res_id"), spread, *[F.col(c).alias(c) for c in sorted(used)])
    df = df.repartition(_tasks(df), "res_id", "_spread")
    rows = df.select("res_id", "_spread", F.explode(F.concat(*links)).alias("l")).where("l.text <> ''")
    known = F.col("l.type").isNotNull()
    parsed = rows.withColumn("s", F.when(~known, parse_object(F.col("l.text"))))
    sub_type = F.when(known, F.col("l.type")).otherwise(F.col("s.type"))
    return parsed.select(
        "_spread", F.lit(res_type).alias("res_type"), "res_id", F.col("l.relation").alias("relation"), sub_type.alias("sub_type"),
        F.when(known | (F.col("s.type") == ""), F.col("l.text")).otherwise(F.col("s.id")).alias("sub_id"),
        F.when(known, "").otherwise(F.col("s.rel")).alias("sub_rel"), (sub_type != "").alias("valid"),
    ).distinct().drop("_spread")


def _tasks(df: DataFrame) -> int:
    """Partitions of about eight megabytes by the optimizer's estimate, where it has one."""
    size = estimated_bytes(df)
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), size // (8 << 20) if size < 1 << 50 else 0)


def _link(relation: str, type_: str | None):
    return lambda v: F.struct(
        F.lit(relation).alias("relation"), F.lit(type_).cast("string").alias("type"), v.alias("text")
    )


def accepted(df: DataFrame) -> DataFrame:
    return df.where("valid").select(*TUPLE_COLS)


def rejected(df: DataFrame) -> DataFrame:
    return df.where("not valid").select(*TUPLE_COLS)


def org_tuples(df: DataFrame) -> DataFrame:
    """``(org_id, admins, members)``; users."""
    return entity_tuples(df, "organization", "org_id", refs={}, users={"admin": "admins", "member": "members"}, subjects={})


def group_tuples(df: DataFrame) -> DataFrame:
    """``(group_id, org_id, members, admin)``; users."""
    return entity_tuples(
        df, "group", "group_id", refs={"org": "organization@org_id"}, users={"admin": "admin", "member": "members"}, subjects={}
    )


def workspace_migration(df: DataFrame) -> DataFrame:
    """``(workspace_id, org_id, owner, admins, editors, viewers)``; editors and viewers are subject texts."""
    return entity_tuples(
        df, "workspace", "workspace_id", refs={"org": "organization@org_id"}, users={"owner": "owner", "admin": "admins"},
        subjects={"editor": "editors", "viewer": "viewers"},
    )


def application_migration(df: DataFrame) -> DataFrame:
    """``(app_id, org_id, owner, admins, users)``; admins and users are subject texts."""
    return entity_tuples(
        df, "application", "app_id", refs={"org": "organization@org_id"}, users={"owner": "owner"},
        subjects={"admin": "admins", "user": "users"},
    )


def inventory_workspace_migration(df: DataFrame) -> DataFrame:
    """``(workspace_id, org_id, owner, admins, operators, viewers)``; all but the owner are subject texts."""
    return entity_tuples(
        df, "workspace", "workspace_id", refs={"org": "organization@org_id"}, users={"owner": "owner"},
        subjects={"admin": "admins", "operator": "operators", "viewer": "viewers"},
    )


def host_group_migration(df: DataFrame) -> DataFrame:
    """``(group_id, org_id, workspace_id, owner, admins, members)``; admins and members are subject texts."""
    return entity_tuples(
        df, "host_group", "group_id", refs={"org": "organization@org_id", "workspace": "workspace"},
        users={"owner": "owner"}, subjects={"admin": "admins", "member": "members"},
    )


def host_migration(df: DataFrame) -> DataFrame:
    """``(host_id, org_id, workspace_id, host_group_id, owner, admins, operators, viewers, can_view_system_profile,
    can_view_facts)``; the last five are subject texts, the host group is optional."""
    texts = ("can_view_system_profile", "can_view_facts")
    return entity_tuples(
        df, "host", "host_id",
        refs={"org": "organization@org_id", "workspace": "workspace", "host_group": "host_group"}, users={"owner": "owner"},
        subjects={"admin": "admins", "operator": "operators", "viewer": "viewers"} | {c: c for c in texts},
    )


def tag_namespace_migration(df: DataFrame) -> DataFrame:
    """``(namespace_id, org_id, admins)``; admins are subject texts."""
    return entity_tuples(
        df, "tag_namespace", "namespace_id", refs={"org": "organization@org_id"}, users={}, subjects={"admin": "admins"}
    )


def tag_migration(df: DataFrame) -> DataFrame:
    """``(tag_id, org_id, namespace_id, admin, can_apply)``; the last two are subject texts."""
    return entity_tuples(
        df, "tag", "tag_id", refs={"org": "organization@org_id", "namespace": "tag_namespace@namespace_id"}, users={},
        subjects={"admin": "admin", "can_apply": "can_apply"},
    )
