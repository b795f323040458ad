"""Writes, versions and set operations on tuple tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ordered import block_chunk, with_next, with_previous
from ..model import LIVE_XID, TUPLE_COLS
from .relate import latest_state, workspace_tuples
from .select import relationship_filter


def touch(tuples: DataFrame, new: DataFrame) -> DataFrame:
    """Upsert of a batch into a table of distinct tuples: what is new is added, the table itself is not moved when the
    batch is small enough to be broadcast."""
    base = tuples.select(*TUPLE_COLS)
    asked = new.select(*TUPLE_COLS).distinct()
    known = base.join(asked, TUPLE_COLS, "left_semi")
    return base.unionByName(asked.join(known, TUPLE_COLS, "left_anti"))


def create(tuples: DataFrame, new: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(table after, conflicts)``: tuples that already exist are reported and not written again."""
    asked = new.select(*TUPLE_COLS).distinct()
    fresh = asked.join(tuples, TUPLE_COLS, "left_anti")
    return tuples.select(*TUPLE_COLS).unionByName(fresh), asked.join(tuples, TUPLE_COLS, "left_semi")


def delete(tuples: DataFrame, gone: DataFrame) -> DataFrame:
    """Remove exact tuples."""
    return tuples.join(gone.select(*TUPLE_COLS).distinct(), TUPLE_COLS, "left_anti").select(*TUPLE_COLS)


def delete_where(tuples: DataFrame, **fields: str) -> DataFrame:
    """Remove every tuple matching a partial filter."""
    if not fields:
        raise ValueError("an empty filter would delete everything")
    return tuples.where(~relationship_filter(**fields))


def cdc_update(tuples: DataFrame, changes: DataFrame) -> DataFrame:
    """Rebuild the parent tuples of changed workspaces from their newest image.

    All parents of a changed workspace are removed first, so a move leaves no stale parent behind.
    """
    newest = latest_state(changes, ["id"], drop_deleted=False)
    touched = newest.select(F.lit("rbac/workspace").alias("res_type"), F.col("id").alias("res_id"),
                            F.lit("t_parent").alias("relation"))
    kept = tuples.select(*TUPLE_COLS).join(touched, ["res_type", "res_id", "relation"], "left_anti")
    return kept.select(*TUPLE_COLS).unionByName(workspace_tuples(newest.where("op <> 'd'")).select(*TUPLE_COLS))


def upsert_rows(base: DataFrame, incoming: DataFrame, key: str, update: list[str]) -> DataFrame:
    """Insert new keys; for known keys replace only the ``update`` columns."""
    inc = incoming.select(key, *[F.col(c).alias(f"_n_{c}") for c in incoming.columns if c != key], F.lit(True).alias("_in"))
    old = base.withColumn("_old", F.lit(True))
    both = old.join(inc, key, "full_outer")
    cols = []
    for c in base.columns:
        if c == key:
            cols.append(F.col(c))
        elif c in update:
            cols.append(F.when(F.col("_in"), F.col(f"_n_{c}")).otherwise(F.col(c)).alias(c))
        else:
            cols.append(F.when(F.col("_old"), F.col(c)).otherwise(F.col(f"_n_{c}")).alias(c))
    return both.select(*cols)


def last_operations(updates: DataFrame, seq: str = "seq") -> DataFrame:
    """Last operation per tuple."""
    return updates.groupBy(*TUPLE_COLS).agg(F.max_by("op", F.col(seq)).alias("op"))


def fold_updates(tuples: DataFrame, updates: DataFrame, seq: str = "seq") -> DataFrame:
    """Apply an ordered batch of TOUCH, CREATE and DELETE operations; the last one per tuple wins."""
    last = last_operations(updates, seq)
    kept = tuples.select(*TUPLE_COLS).join(last, TUPLE_COLS, "left_anti")
    return kept.unionByName(last.where("op <> 'DELETE'").select(*TUPLE_COLS))


def as_of(versions: DataFrame, xid: int | Column) -> DataFrame:
    """Tuples visible at a revision."""
    at = F.lit(xid) if isinstance(xid, int) else xid
    return versions.where((F.col("created_xid") <= at) & (F.col("deleted_xid") > at)).select(*TUPLE_COLS)


def newest_revision(versions: DataFrame) -> DataFrame:
    """One row ``revision``: the last transaction in the table."""
    gone = F.when(F.col("deleted_xid") < LIVE_XID, F.col("deleted_xid"))
    return versions.agg(F.greatest(F.max("created_xid"), F.max(gone)).alias("revision"))


def at_least(versions: DataFrame, token: int) -> DataFrame:
    """Freshness gate: one row ``(revision, token, fresh, error)`` telling whether answers may be given."""
    return newest_revision(versions).select(
        "revision", F.lit(token).cast("long").alias("token"),
        F.coalesce(F.col("revision") >= token, F.lit(False)).alias("fresh"),
        F.when(F.coalesce(F.col("revision") >= token, F.lit(False)), F.lit(None).cast("string"))
        .otherwise(F.lit("revision is behind the token")).alias("error"),
    )


def to_versions(log: DataFrame, block: int = 1_000_000) -> DataFrame:
    """Write log ``(tuple, op, lsn)`` to intervals ``created_xid`` to ``deleted_xid``.

    Repeated touches of a live tuple and deletes of an absent one change nothing. Keys are cut into blocks of
    LSNs, so one tuple that is written all the time is not one task.
    """
    keys = TUPLE_COLS
    df = log.withColumn("live", F.col("op") != "DELETE")
    df = _changes(df, keys, block)
    nxt = with_next(df, keys, ["lsn"], ["lsn"], block_chunk(F.col("lsn"), block))
    return nxt.where("live").select(
        *TUPLE_COLS, F.col("lsn").alias("created_xid"),
        F.coalesce("next_lsn", F.lit(LIVE_XID)).alias("deleted_xid"),
    )


def _changes(df: DataFrame, keys: list[str], block: int) -> DataFrame:
    """Only the operations that change whether the tuple is live."""
    prev = with_previous(df, keys, ["lsn"], ["live"], block_chunk(F.col("lsn"), block))
    return prev.where(F.col("live") != F.coalesce("prev_live", F.lit(False))).drop("prev_live")


def transfer(tuples: DataFrame, moves: DataFrame, *, replace: bool = True, relation: str = "owner") -> DataFrame:
    """Give resources ``(res_type, res_id, sub_type, sub_id)`` a new owner; with ``replace`` old ones are removed."""
    new = moves.select(
        "res_type", "res_id", F.lit(relation).alias("relation"), "sub_type", "sub_id", F.lit("").alias("sub_rel")
    )
    base = tuples.select(*TUPLE_COLS)
    if replace:
        base = base.join(new.select("res_type", "res_id", "relation").distinct(), ["res_type", "res_id", "relation"], "left_anti")
    return touch(base.select(*TUPLE_COLS), new)
