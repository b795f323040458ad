"""Permission models and sample relationships the operators are checked against."""

from grantflow.model import all_of, any_of, arrow, perm, rel


def plus(type_, permission, text):
    """``a + b + c->d`` as rules; every plain word names a relation or permission of the same type."""
    terms = []
    for word in text.split(" + "):
        terms.append(arrow(*word.split("->")) if "->" in word else rel(word))
    return any_of(type_, permission, *terms)


def model(spec):
    return [r for type_, perms in spec.items() for name, text in perms.items() for r in plus(type_, name, text)]


CODE_HOSTING = model(
    {
        "organization": {"create_repo": "admin", "view_repo": "member + admin"},
        "team": {"view": "member + org->admin", "manage": "org->admin"},
        "repository": {
            "read": "reader + writer + admin + org->admin",
            "write": "writer + admin + org->admin",
            "delete": "admin + org->admin",
            "manage_access": "admin + org->admin",
        },
        "issue": {"view": "repo->read", "edit": "author + repo->write", "close": "repo->write", "assign": "repo->write"},
        "pr": {"view": "repo->read", "comment": "repo->read", "approve": "reviewer + repo->write", "merge": "repo->write"},
    }
)

CODE_HOSTING_TUPLES = [
    ("organization:acmecorp", "admin", "user:alice"),
    ("organization:acmecorp", "member", "user:bob"),
    ("organization:acmecorp", "member", "user:charlie"),
    ("team:acmecorp/engineering", "org", "organization:acmecorp"),
    ("team:acmecorp/engineering", "member", "user:bob"),
    ("team:acmecorp/engineering", "member", "user:charlie"),
    ("repository:acmecorp/backend", "org", "organization:acmecorp"),
    ("repository:acmecorp/backend", "admin", "user:alice"),
    ("repository:acmecorp/backend", "writer", "team:acmecorp/engineering#member"),
    ("repository:acmecorp/frontend", "org", "organization:acmecorp"),
    ("repository:acmecorp/frontend", "reader", "team:acmecorp/engineering#member"),
    ("issue:acmecorp/backend/123", "repo", "repository:acmecorp/backend"),
    ("issue:acmecorp/backend/123", "author", "user:bob"),
    ("pr:acmecorp/backend/456", "repo", "repository:acmecorp/backend"),
    ("pr:acmecorp/backend/456", "author", "user:charlie"),
    ("pr:acmecorp/backend/456", "reviewer", "user:bob"),
]

CODE_HOSTING_GOLDEN = [
    ("user:alice", "organization:acmecorp", "create_repo", True),
    ("user:bob", "organization:acmecorp", "create_repo", False),
    ("user:bob", "repository:acmecorp/backend", "read", True),
    ("user:bob", "repository:acmecorp/backend", "write", True),
    ("user:bob", "repository:acmecorp/frontend", "read", True),
    ("user:bob", "repository:acmecorp/frontend", "write", False),
    ("user:alice", "repository:acmecorp/backend", "delete", True),
    ("user:bob", "repository:acmecorp/backend", "delete", False),
    ("user:bob", "issue:acmecorp/backend/123", "edit", True),
    ("user:charlie", "issue:acmecorp/backend/123", "edit", True),
    ("user:bob", "pr:acmecorp/backend/456", "approve", True),
    ("user:alice", "pr:acmecorp/backend/456", "merge", True),
    ("user:stranger", "repository:acmecorp/backend", "read", False),
    ("user:charlie", "repository:acmecorp/frontend", "read", True),
    ("user:alice", "repository:acmecorp/frontend", "delete", True),
    ("user:stranger", "issue:acmecorp/backend/123", "view", False),
    ("user:bob", "pr:acmecorp/backend/456", "comment", True),
]

FILES = model(
    {
        "folder": {
            "view": "viewer + editor + owner + parent->view",
            "edit": "editor + owner + parent->edit",
            "delete": "owner + parent->delete",
            "share": "owner",
            "create_child": "editor + owner",
        },
        "document": {
            "view": "viewer + commenter + editor + owner + parent->view",
            "comment": "commenter + editor + owner",
            "edit": "editor + owner + parent->edit",
            "delete": "owner",
            "share": "owner",
            "move": "owner + parent->edit",
        },
        "shared_link": {"view": "document->owner", "revoke": "document->owner"},
    }
)

RBAC = model(
    {
        "organization": {"manage": "admin", "view": "member + admin", "invite_user": "admin"},
        "workspace": {
            "manage": "owner + admin + org->admin",
            "edit": "editor + manage",
            "view": "viewer + edit + org->view",
            "delete": "owner + org->admin",
            "invite": "owner + admin",
        },
        "group": {
            "add_member": "admin + org->admin",
            "remove_member": "admin + org->admin",
            "view": "member + admin + org->view",
        },
        "application": {
            "manage": "owner + admin + org->admin",
            "access": "user + manage",
            "configure": "admin + owner",
        },
    }
)

INVENTORY = model(
    {
        "organization": {
            "manage": "admin",
            "view_all_hosts": "admin + member",
            "manage_billing": "billing_admin + admin",
        },
        "workspace": {
            "manage": "owner + admin + org->admin",
            "operate": "operator + manage",
            "view": "viewer + operate + org->view_all_hosts",
            "delete": "owner + org->admin",
            "create_host": "operator + admin + owner",
            "delete_host": "admin + owner",
        },
        "host_group": {
            "manage": "owner + admin + workspace->admin",
            "add_host": "admin + owner + workspace->create_host",
            "remove_host": "admin + owner",
            "view": "member + manage + workspace->view",
            "operate_hosts": "member + admin + workspace->operate",
        },
        "host": {
            "delete": "owner + workspace->delete_host + org->admin",
            "update": "admin + owner + operator + workspace->operate",
            "read": "viewer + update + workspace->view",
            "read_system_profile": "can_view_system_profile + admin + owner",
            "read_facts": "can_view_facts + owner + org->admin",
            "assign_to_group": "admin + owner + workspace->admin",
            "apply_tags": "operator + admin + owner",
        },
        "tag": {
            "apply": "can_apply + admin + org->admin",
            "remove": "admin + org->admin",
            "view": "can_apply + admin + org->view_all_hosts",
        },
        "tag_namespace": {"manage": "admin + org->admin", "create_tag": "admin + org->admin"},
        "group": {
            "add_member": "admin + org->admin",
            "remove_member": "admin + org->admin",
            "view": "member + admin + org->view_all_hosts",
        },
    }
)

# The role-binding demo: see ROLE_DEMO_* for its tuples and steps.
ROLE_DEMO_TUPLES = [
    ("rbac/group:engineering", "t_member", "rbac/principal:alice"),
    ("rbac/role:host_viewer", "t_inventory_hosts_read", "rbac/principal:*"),
    ("rbac/role_binding:eng_prod_binding", "t_subject", "rbac/group:engineering#member"),
    ("rbac/role_binding:eng_prod_binding", "t_role", "rbac/role:host_viewer"),
    ("rbac/tenant:techcorp", "t_platform", "rbac/platform:techcorp_defaults"),
    ("rbac/workspace:production", "t_parent", "rbac/tenant:techcorp"),
    ("rbac/workspace:production", "t_binding", "rbac/role_binding:eng_prod_binding"),
    ("hbi/host:web-server-01", "t_workspace", "rbac/workspace:production"),
]
ROLE_DEMO_STEP5 = [
    ("rbac/workspace:staging", "t_parent", "rbac/tenant:techcorp"),
    ("rbac/role_binding:alice_staging_binding", "t_subject", "rbac/principal:alice"),
    ("rbac/role_binding:alice_staging_binding", "t_role", "rbac/role:host_viewer"),
    ("rbac/workspace:staging", "t_binding", "rbac/role_binding:alice_staging_binding"),
    ("hbi/host:staging-app-01", "t_workspace", "rbac/workspace:staging"),
]


def split(text):
    head, _, sub_rel = text.partition("#")
    type_, _, id_ = head.partition(":")
    return type_, id_, sub_rel


def rows(texts):
    out = []
    for res, relation, sub in texts:
        rt, ri, _ = split(res)
        st, si, sr = split(sub)
        out.append((rt, ri, relation, st, si, sr))
    return out


def tuples(spark, texts):
    from grantflow.model import tuples_frame

    return tuples_frame(spark, rows(texts))


def requests(spark, golden):
    """Golden rows ``(subject, resource, permission, expected)`` as a request table."""
    data = []
    for sub, res, permission, expected in golden:
        rt, ri, _ = split(res)
        st, si, _ = split(sub)
        data.append((rt, ri, permission, st, si, expected))
    from grantflow.session import literal_table

    return literal_table(
        spark, data, "res_type string, res_id string, permission string, sub_type string, sub_id string, expected boolean"
    )


__all__ = ["all_of", "perm"]
