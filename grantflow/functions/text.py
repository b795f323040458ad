"""String and value expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def split_type(col: Column) -> Column:
    """``ns/name`` as a struct; without a slash both parts are the whole."""
    parts = F.split(col, "/", 2)
    return F.struct(
        parts.getItem(0).alias("ns"),
        F.when(F.size(parts) == 2, F.try_element_at(parts, F.lit(2))).otherwise(col).alias("name"),
    )


def tuple_string(
    res_type="res_type", res_id="res_id", relation="relation", sub_type="sub_type", sub_id="sub_id", sub_rel="sub_rel"
) -> Column:
    """Canonical text ``res#rel@sub`` or ``res#rel@sub#rel``."""
    head = F.concat(
        F.col(res_type), F.lit(":"), F.col(res_id), F.lit("#"), F.col(relation), F.lit("@"),
        F.col(sub_type), F.lit(":"), F.col(sub_id),
    )
    userset = F.coalesce(F.col(sub_rel), F.lit(""))
    return F.when(userset == "", head).otherwise(F.concat(head, F.lit("#"), userset))


def parse_object(col: Column) -> Column:
    """``type:id`` or ``type:id#rel`` as a struct; all fields are empty when the text is malformed."""
    text = F.coalesce(col, F.lit(""))
    head = F.substring_index(text, "#", 1)
    type_ = F.substring_index(head, ":", 1)
    id_ = F.substring(head, F.length(type_) + 2, F.length(head))
    rel = F.substring(text, F.length(head) + 2, F.length(text))
    colon, hash_ = F.instr(head, ":"), F.instr(text, "#")
    ok = (colon > 1) & (id_ != "") & ((hash_ == 0) | (rel != "")) & (F.instr(rel, "#") == 0) & ~text.rlike(r"\s")
    return F.struct(*[F.when(ok, part).otherwise("").alias(n) for part, n in ((type_, "type"), (id_, "id"), (rel, "rel"))])


def decision_key(prefix: str, res_type: str, res_id: str, permission: str, sub_type: str, sub_id: str) -> Column:
    return F.concat_ws(
        ":", F.lit(prefix), F.lit("perm"), F.col(res_type), F.col(res_id), F.col(permission),
        F.col(sub_type), F.col(sub_id),
    )


def relation_key(prefix: str, res_type: str, res_id: str, relation: str) -> Column:
    return F.concat_ws(":", F.lit(prefix), F.lit("rel"), F.col(res_type), F.col(res_id), F.col(relation))


def schema_key(prefix: str, res_type: str) -> Column:
    return F.concat_ws(":", F.lit(prefix), F.lit("schema"), F.col(res_type))


def state_of(col: Column) -> Column:
    """``up`` value to its display text."""
    return F.when(col == 0, "DOWN").when(col == 1, "UP")


def band(col: Column, steps: list[tuple[float | None, str]]) -> Column:
    """Name of the last threshold step reached. ``steps`` are ``(lower bound or None, name)`` in rising order."""
    out = F.lit(None).cast("string")
    for bound, name in steps:
        hit = F.lit(True) if bound is None else col >= F.lit(float(bound))
        out = F.when(hit & col.isNotNull(), F.lit(name)).otherwise(out)
    return out
