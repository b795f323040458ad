"""Filters, lookups, validation and label handling."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.skew import conj
from ..functions.text import split_type

# Fields of a relationship filter and the columns or type parts they test.
_FILTER = {
    "resource_namespace": ("res_type", "ns"), "resource_type": ("res_type", "name"), "resource_id": ("res_id", None),
    "relation": ("relation", None), "subject_namespace": ("sub_type", "ns"), "subject_type": ("sub_type", "name"),
    "subject_id": ("sub_id", None), "subject_relation": ("sub_rel", None),
}


def relationship_filter(**fields: str) -> Column:
    """Condition for any subset of the filter fields; namespace and type together test the column directly."""
    conds = []
    for side, col in (("resource", "res_type"), ("subject", "sub_type")):
        ns, name = fields.pop(f"{side}_namespace", None), fields.pop(f"{side}_type", None)
        if ns is not None and name is not None:
            conds.append(F.col(col) == (ns if ns == name else f"{ns}/{name}"))
        elif ns is not None:
            conds.append(split_type(F.col(col))["ns"] == ns)
        elif name is not None:
            conds.append(split_type(F.col(col))["name"] == name)
    for field, value in fields.items():
        if field not in _FILTER:
            raise ValueError(f"unknown filter field {field}")
        conds.append(F.col(_FILTER[field][0]) == value)
    return conj(conds)


def read_relationships(tuples: DataFrame, **fields: str) -> DataFrame:
    """Tuples matching a partial filter."""
    return tuples.where(relationship_filter(**fields))


def list_resources(df: DataFrame, **fields: str) -> DataFrame:
    """Resources equal on every given column (workspace, type, display name, ...)."""
    return df.where(conj([F.col(c) == v for c, v in fields.items()]))


def list_recent(df: DataFrame, n: int, *, time: str = "created_at", id_: str = "id") -> DataFrame:
    """Newest ``n`` rows, ids breaking ties."""
    return df.orderBy(F.col(time).desc(), F.col(id_)).limit(n)


def get_by_id(df: DataFrame, value, *, id_: str = "id") -> DataFrame:
    return df.where(F.col(id_) == value)


def require_fields(df: DataFrame, spec: dict[str, str]) -> DataFrame:
    """Add ``errors``: codes of required columns that are missing or empty. ``spec = {column: code}``."""
    checks = [F.when(F.coalesce(F.col(c), F.lit("")) == "", F.lit(code)) for c, code in spec.items()]
    return df.withColumn("errors", F.array_compact(F.array(*checks)))


def error_counts(df: DataFrame) -> DataFrame:
    """``(error, rows)`` over column ``errors``."""
    return df.select(F.explode("errors").alias("error")).groupBy("error").agg(F.count("*").alias("rows"))


UUID = r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"


def _branch(col: Column, rule: dict) -> Column:
    if rule.get("type") == "null":
        return col.isNull()
    ok = col.isNotNull()
    if rule.get("format") == "uuid":
        ok &= col.rlike(UUID)
    if "pattern" in rule:
        ok &= col.rlike(rule["pattern"])
    if "maxLength" in rule:
        ok &= F.length(col) <= rule["maxLength"]
    return ok


def validate_resources(df: DataFrame, spec: dict[str, dict]) -> DataFrame:
    """Add ``errors`` and ``valid`` from declared constraints.

    ``spec[column]`` has ``required`` and either one rule or ``oneOf`` rules (``type``, ``format``, ``pattern``,
    ``maxLength``). Exactly one branch of ``oneOf`` must hold. An optional column without ``oneOf`` may be null.
    """
    checks = []
    for c, rule in spec.items():
        col = F.col(c)
        if rule.get("required"):
            checks.append(F.when(col.isNull(), F.lit(f"{c}:required")))
        branches = rule.get("oneOf")
        if branches:
            hits = reduce(lambda a, b: a + b, [F.coalesce(_branch(col, b), F.lit(False)).cast("int") for b in branches])
            checks.append(F.when(hits != 1, F.lit(f"{c}:oneOf")))
        elif set(rule) - {"required", "type"}:
            checks.append(F.when(col.isNotNull() & ~_branch(col, rule), F.lit(f"{c}:format")))
    return df.withColumn("errors", F.array_compact(F.array(*checks))).withColumn("valid", F.size("errors") == 0)


# Declared constraints of the host and edge device reports.
HOST_SPEC = {
    "satellite_id": {
        "oneOf": [{"type": "string", "format": "uuid"}, {"type": "string", "pattern": r"^\d{10}$"}, {"type": "null"}]
    },
    "subscription_manager_id": {"oneOf": [{"type": "string", "format": "uuid"}, {"type": "null"}]},
    "insights_id": {"oneOf": [{"type": "string", "format": "uuid"}, {"type": "null"}]},
    "ansible_host": {"oneOf": [{"type": "string", "maxLength": 255}, {"type": "null"}]},
    "workspace_id": {"type": "string", "required": True},
}
EDGE_DEVICE_SPEC = {
    "display_name": {"type": "string"},
    "workspace_id": {"type": "string", "required": True},
    "org_id": {"type": "string", "required": True},
}


def check_registered(df: DataFrame, registry: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(accepted with namespace, rejected)`` by ``(resource_type, reporter_name)``."""
    keys = ["resource_type", "reporter_name"]
    return df.join(registry, keys), df.join(registry, keys, "left_anti")


def match_labels(df: DataFrame, spec: list[tuple[str, str, str]]) -> DataFrame:
    """Keep samples whose labels satisfy every ``(label, op, value)``; ops ``= != =~ !~``.

    A missing label counts as empty and patterns are anchored at both ends.
    """
    conds = []
    for label, op, value in spec:
        col = F.coalesce(F.col("labels")[label], F.lit(""))
        if op in ("=", "!="):
            hit = col == value
        elif op in ("=~", "!~"):
            hit = col.rlike(f"^(?:{value})$")
        else:
            raise ValueError(f"unknown matcher {op}")
        conds.append(~hit if op.startswith("!") else hit)
    return df.where(conj(conds))


def _without_labels(pattern: str) -> Column:
    return F.map_filter("labels", lambda k, _: ~k.rlike(f"^(?:{pattern})$"))


def relabel(df: DataFrame, rules: list[dict]) -> DataFrame:
    """Apply relabelling steps in order: ``keep``, ``copy`` and ``drop`` (labels by pattern)."""
    for r in rules:
        if r["action"] == "keep":
            source = F.col("name") if r["source"] == "__name__" else F.coalesce(F.col("labels")[r["source"]], F.lit(""))
            df = df.where(source.rlike(f"^(?:{r['regex']})$"))
        elif r["action"] == "copy":
            value = F.col("labels")[r["source"]]
            rest = _without_labels(r["target"])
            df = df.withColumn(
                "labels",
                F.when(
                    value.rlike("^.+$"), F.map_concat(rest, F.create_map(F.lit(r["target"]), value))
                ).otherwise(F.col("labels")),
            )
        elif r["action"] == "drop":
            df = df.withColumn("labels", _without_labels(r["regex"]))
        else:
            raise ValueError(f"unknown action {r['action']}")
    return df
