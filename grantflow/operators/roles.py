"""Role model: role permissions, bindings, scopes, and the permission macro as data.

Leaves on a role are wildcards, so a role either has a permission or not; a binding then grants its subjects the
permissions of its roles. Both facts are small and are joined before any hierarchy or group is opened. Grants
stay at the level of groups until the last step.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.sets import SET, by_set, hand_out
from ..functions.skew import spread_join
from ..model import Rule, rules_list
from ..session import cut, literal_table
from .closure import closure, node_id, node_type, tuple_edges
from .evaluate import Shared, arrow_permission, intersect_grants, open_usersets

SUBJECT = ["sub_type", "sub_id", "sub_rel"]
SCOPE_RELATIONS = ["t_parent", "t_platform"]


def v1_leaves(app: Column, resource: Column, verb: Column) -> Column:
    """Names of the role leaves that give ``app:resource:verb``: itself and its wildcard forms."""
    return F.array(
        F.concat_ws("_", app, resource, verb),
        F.concat_ws("_", app, resource, F.lit("all")),
        F.concat_ws("_", app, F.lit("all"), verb),
        F.concat_ws("_", app, F.lit("all"), F.lit("all")),
        F.lit("all_all_all"),
    )


def leaf_map(permissions: DataFrame, prefix: str = "t_") -> DataFrame:
    """``(app, resource, verb, permission)`` to ``(leaf, permission)``."""
    return permissions.select(
        F.explode(v1_leaves(F.col("app"), F.col("resource"), F.col("verb"))).alias("leaf"), "permission"
    ).select(F.concat(F.lit(prefix), "leaf").alias("leaf"), "permission").distinct()


def expand_permission_macro(permissions: DataFrame, prefix: str = "t_") -> DataFrame:
    """Rule rows for every ``(app, resource, verb, permission)``: role, binding, platform, tenant, workspace."""

    def term(type_: str, group: int, kind: str, relation: Column, target: Column) -> Column:
        return F.struct(
            F.lit(type_).alias("type"), F.col("permission"), F.lit(group).alias("and_group"),
            F.lit(kind).alias("kind"), relation.alias("relation"), target.alias("target"),
        )

    same, none = F.col("permission"), F.lit("")
    leaves = F.transform(
        v1_leaves(F.col("app"), F.col("resource"), F.col("verb")),
        lambda leaf: term("rbac/role", 0, "rel", F.concat(F.lit(prefix), leaf), none),
    )

    def via(type_: str, relation: str, group: int = 0) -> Column:
        return term(type_, group, "arrow", F.lit(prefix + relation), same)

    scopes = F.array(
        via("rbac/role", "child"),
        term("rbac/role_binding", 1, "rel", F.lit(f"{prefix}subject"), none),
        via("rbac/role_binding", "role", 1),
        via("rbac/platform", "binding"),
        via("rbac/tenant", "binding"),
        via("rbac/tenant", "platform"),
        via("rbac/workspace", "binding"),
        via("rbac/workspace", "parent"),
    )
    rows = permissions.select("app", "resource", "verb", "permission").distinct()
    return rows.select(F.explode(F.concat(leaves, scopes)).alias("r")).select("r.*").distinct()


def contingent_rules(first: str, second: str, out: str) -> list[Rule]:
    """Rules of a permission that needs two inherited permissions, on every scope type."""
    return [
        Rule(t, out, 1, "perm", p)
        for t in ("rbac/platform", "rbac/tenant", "rbac/workspace")
        for p in (first, second)
    ]


def role_model_rules(permissions: DataFrame, extra: list[Rule] | None = None) -> list[Rule]:
    """Macro rules plus ``group.member = t_member`` and caller's rules, as the evaluator's rule list."""
    base = [Rule("rbac/group", "member", 0, "rel", "t_member"), Rule("rbac/group", "owner", 0, "rel", "t_owner")]
    return base + rules_list(expand_permission_macro(permissions)) + (extra or [])


def role_permissions(tuples: DataFrame, leaves: DataFrame) -> DataFrame:
    """``(role, permission)`` through child roles."""
    own = tuples.where("res_type = 'rbac/role' and sub_type = 'rbac/principal' and sub_id = '*'").select(
        F.col("res_id").alias("role"), F.col("relation").alias("leaf")
    )
    own = cut(own.join(leaves, "leaf").select("role", "permission").distinct())
    inner = closure(tuple_edges(tuples, ["t_child"], res_types=["rbac/role"])).select(
        node_id("src").alias("parent"), node_id("dst").alias("role")
    )
    inherited = inner.join(own, "role").select(F.col("parent").alias("role"), "permission")
    return own.unionByName(inherited).distinct()


def binding_grants(tuples: DataFrame, role_perms: DataFrame) -> DataFrame:
    """``(binding, permission, subject)``: binding subjects times the permissions of the binding's roles."""
    bindings = tuples.where("res_type = 'rbac/role_binding'")
    roles = bindings.where("relation = 't_role'").select(
        F.col("res_id").alias("binding"), F.col("sub_id").alias("role")
    )
    subjects = bindings.where("relation = 't_subject'").select(F.col("res_id").alias("binding"), *SUBJECT)
    perms = spread_join(roles, role_perms, ["role"]).select("binding", "permission").distinct()
    return spread_join(subjects, perms, ["binding"]).select("binding", "permission", *SUBJECT)


def scope_ancestors(tuples: DataFrame, relations: list[str] = SCOPE_RELATIONS) -> DataFrame:
    """``(type, id, anc_type, anc_id, depth)`` for every scope node that has ancestors."""
    pairs = closure(tuple_edges(tuples, relations))
    return pairs.select(
        node_type("src").alias("type"), node_id("src").alias("id"),
        node_type("dst").alias("anc_type"), node_id("dst").alias("anc_id"), "depth",
    )


def scope_grants(tuples: DataFrame, bindings: DataFrame, ancestors: DataFrame | None = None) -> DataFrame:
    """Grants ``(type, id, permission, subject)`` at every scope, its own and inherited ones.

    Each binding's grants are attached to the scope that carries it and copied down one ancestor closure that
    serves all permissions.
    """
    attached = tuples.where("relation = 't_binding'").select(
        F.col("res_type").alias("anc_type"), F.col("res_id").alias("anc_id"), F.col("sub_id").alias("binding")
    )
    own = cut(spread_join(attached, bindings, ["binding"]).drop("binding").distinct())
    if ancestors is None:
        ancestors = scope_ancestors(tuples)
    inherited = spread_join(ancestors.drop("depth"), own, ["anc_type", "anc_id"]).select(
        "type", "id", "permission", *SUBJECT
    )
    here = own.select(F.col("anc_type").alias("type"), F.col("anc_id").alias("id"), "permission", *SUBJECT)
    return here.unionByName(inherited).distinct()


def resource_grants(
    tuples: DataFrame, scopes: DataFrame | list[Shared], res_type: str, relation: str = "t_workspace"
) -> DataFrame:
    """Grants of resources from the scope they are placed in, still at group level or, kept once per set, opened."""
    return arrow_permission(tuples, scopes, res_type, relation)


def contingent(
    grants: DataFrame, first: str, second: str, out: str, members: DataFrame, *, shared: bool = False
) -> DataFrame | Shared:
    """``out`` = ``first`` and ``second`` for the same principal, both taken after inheritance; with ``shared`` not handed
    out to the objects."""
    keys = ["type", "id"]
    both = intersect_grants(
        grants.where(F.col("permission") == first), grants.where(F.col("permission") == second), keys, members, shared=shared)
    rest = [F.lit(out).alias("permission"), "sub_type", "sub_id", F.lit("").alias("sub_rel")]
    return both._replace(rows=both.rows.select(*SET, *rest)) if shared else both.select(*keys, *rest)


def gate_on_view(view: DataFrame, scoped: DataFrame | Shared, members: DataFrame | None = None) -> DataFrame | Shared:
    """``view & workspace.X``; ``scoped`` keeps its permission name. Both sides are opened grants, or, with ``members``
    given, may hold usersets, which are opened once for all objects with the same grants. Opened grants in ``scoped`` may
    be kept once per set, and then the result is too."""
    on = ["type", "id"]
    if isinstance(scoped, Shared):
        seen, rows = by_set(view.select(*on, *SUBJECT).dropna(subset=on), on)
        both = seen.withColumnsRenamed({c: f"v{c}" for c in SET}).join(scoped.objects, on)
        pair = [f"v{c}" for c in SET] + SET
        met = [F.xxhash64(*pair).alias("m_set"), F.xxhash64(F.lit("check"), *pair).alias("m_check")]
        both = cut(both.select(*on, *met, *pair))
        pairs = cut(both.select("m_set", "m_check", *pair).distinct())
        named = {"m_set": "type", "m_check": "id"}
        opened = open_usersets(rows.withColumnsRenamed(dict(zip(SET, on))), members) if members is not None else rows.withColumnsRenamed(dict(zip(SET, on)))
        opened = opened.withColumnsRenamed({c: f"v{s}" for c, s in zip(on, SET)})
        sides = [cut(pairs.join(df, by).select(*named, *[c for c in df.columns if c not in by]).withColumnsRenamed(named))
                 for df, by in ((cut(opened), pair[:2]), (scoped.rows, pair[2:]))]
        gated = gate_on_view(*sides).withColumnsRenamed(dict(zip(on, SET)))
        return Shared(both.select(*on, F.col("m_set").alias("_set"), F.col("m_check").alias("_check")), cut(gated))
    if members is not None:
        sides = [
            df.select(*on, p.alias("permission"), *SUBJECT, F.lit(i).alias("_side")).dropna(subset=on)
            for i, (df, p) in enumerate(((view, F.lit("")), (scoped, F.col("permission"))))
        ]
        objects, rows = by_set(sides[0].unionByName(sides[1]), on)
        opened = cut(open_usersets(rows.withColumnsRenamed(dict(zip(SET, on))), members))
        gated = gate_on_view(opened.where("_side = 0"), opened.where("_side = 1"))
        return hand_out(objects, cut(gated.withColumnsRenamed(dict(zip(on, SET))))).select(*on, "permission", "sub_type", "sub_id")
    who = ["type", "id", "sub_type"]
    seen = view.select(*who, "sub_id").distinct()
    asked = scoped.select("type", "id", "permission", "sub_type", "sub_id").distinct()
    same = spread_join(asked, seen, [*who, "sub_id"], how="left_semi")
    open_view = spread_join(asked, seen.where("sub_id = '*'").select(*who), who, how="left_semi")
    open_scope = spread_join(seen, asked.where("sub_id = '*'").select(*who, "permission"), who).select(*asked.columns)
    return same.unionByName(open_view).unionByName(open_scope).distinct()


def map_v1_to_v2(
    roles: DataFrame, mapping: DataFrame, parts: tuple[str, str, str] = ("app", "resource", "verb")
) -> DataFrame:
    """``(role, v1)`` strings to ``(role, permission)`` with ``*`` allowed in any part of the string.

    Every mapped permission is listed under the eight strings that cover it, which makes the wildcard match an
    equality join.
    """

    def either(c: str) -> Column:
        return F.array(F.col(c), F.lit("*"))

    covering = F.flatten(
        F.transform(
            either(parts[0]),
            lambda a: F.flatten(
                F.transform(
                    either(parts[1]),
                    lambda b: F.transform(either(parts[2]), lambda c: F.concat_ws(":", a, b, c)),
                )
            ),
        )
    )
    listed = mapping.select("permission", F.explode(covering).alias("v1")).distinct()
    return spread_join(roles.select("role", "v1"), listed, ["v1"]).select("role", "permission").distinct()


def default_grants(roles: DataFrame) -> DataFrame:
    """``(flag, role)``: one grant of a default role to all its holders, ``platform`` for everybody and ``admin`` for org
    admins only. This closed form does not grow with the principals."""
    flags = roles.groupBy("role").agg(
        F.coalesce(F.bool_or("platform_default"), F.lit(False)).alias("all"),
        F.coalesce(F.bool_or("admin_default"), F.lit(False)).alias("admins"),
    )
    flag = F.when(F.col("all"), "platform").when(F.col("admins"), "admin")
    return flags.select(flag.alias("flag"), "role").where("flag is not null")


def default_assignments(
    principals: DataFrame, roles: DataFrame, explicit: DataFrame, asked: DataFrame | None = None
) -> DataFrame:
    """``(username, role)``: explicit ones, platform defaults for everybody, admin defaults for org admins.

    The grants of :func:`default_grants` are opened for the principals, or only for the ``asked`` usernames. Rows are
    made distinct in the inputs and explicit roles held by default are left out, so the result is not shuffled again.
    """
    people = principals.groupBy("username").agg(F.coalesce(F.bool_or("is_org_admin"), F.lit(False)).alias("admin"))
    explicit = explicit.select("username", "role").distinct()
    if asked is not None:
        names = asked.select("username").distinct()
        people, explicit = (df.join(names, "username", "left_semi") for df in (people, explicit))
    grants = default_grants(roles)
    held = F.when(F.col("admin"), F.array(F.lit("platform"), F.lit("admin"))).otherwise(F.array(F.lit("platform")))
    given = spread_join(people.select("username", F.explode(held).alias("flag")), grants, ["flag"])
    by_default = spread_join(explicit, grants, ["role"])
    known = by_default.alias("e").join(people.alias("p"), F.col("e.username").eqNullSafe(F.col("p.username")))
    known = known.where("e.flag = 'platform' or p.admin").select(
        F.col("e.username").alias("_u"), F.col("e.role").alias("_r"))
    more = explicit.join(known, explicit.username.eqNullSafe(F.col("_u")) & (explicit.role == F.col("_r")), "left_anti")
    return given.select("username", "role").unionByName(more)


def close_requires(verbs: DataFrame) -> DataFrame:
    """``(app, resource, verb, requires)`` to all verbs each verb includes, itself among them."""
    def node(verb: str) -> Column:
        return F.struct("app", "resource", F.col(verb).alias("verb"))

    edges = verbs.where("requires is not null").select(node("verb").alias("src"), node("requires").alias("dst"))
    more = closure(edges).select("src.app", "src.resource", "src.verb", F.col("dst.verb").alias("includes"))
    own = verbs.select("app", "resource", "verb", F.col("verb").alias("includes"))
    return own.unionByName(more).distinct()


# Permissions the derived graph and the bench use, as (app, resource, verb, permission).
HOST_PERMISSIONS = [
    ("inventory", "hosts", "read", "inventory_host_view"),
    ("inventory", "hosts", "write", "inventory_host_update"),
    ("patch", "system", "read", "patch_system_view_assigned"),
]


def permissions_frame(spark, rows=None) -> DataFrame:
    return literal_table(
        spark, rows or HOST_PERMISSIONS, "app string, resource string, verb string, permission string"
    )


def host_rules() -> list[Rule]:
    """Rules on hosts over the scope permissions of :data:`HOST_PERMISSIONS`."""
    return (
        [
            Rule("hbi/host", "view", 0, "arrow", "t_workspace", "inventory_host_view"),
            Rule("hbi/host", "update", 0, "arrow", "t_workspace", "inventory_host_update"),
            Rule("hbi/host", "patch_system_view", 1, "perm", "view"),
            Rule("hbi/host", "patch_system_view", 1, "arrow", "t_workspace", "patch_system_view"),
        ]
        + contingent_rules("inventory_host_view", "patch_system_view_assigned", "patch_system_view")
    )
