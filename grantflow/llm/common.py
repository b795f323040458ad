"""Helpers shared by the operators: flat text buffers for numpy and bounded groups of Arrow rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes of text that one numpy step works on; a longer single text is a step of its own.
BLOCK_BYTES = 1 << 21

#: What counts as white space between words: 0x20 and 0x09-0x0D.
WORD = r"[^\x20\x09-\x0D]+"

#: Null ids sort before all others and are joined under this value.
NULL_ID = -(1 << 63)


def text_of(docs: DataFrame, column: str = "text") -> Column:
    """The text with null as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def text_bytes(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string array in one buffer, and the offsets of its texts (one more than texts)."""
    array = array.cast(pa.large_binary())
    if array.null_count:
        array = array.fill_null(b"")
    _, offsets, data = array.buffers()
    offsets = np.frombuffer(offsets, np.int64)[array.offset : array.offset + len(array) + 1]
    flat = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return flat[offsets[0] : offsets[-1]], offsets - offsets[0]


def text_blocks(batches: Iterator[pa.RecordBatch], column: str, limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that the texts of each piece hold about ``limit`` bytes."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = text_bytes(batch.column(column))
        start = 0
        while start < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[start] + limit, "right")) - 1
            end = min(max(end, start + 1), batch.num_rows)
            yield batch.slice(start, end - start)
            start = end


def key_runs(batches: Iterator[pa.RecordBatch], keys: list[str], limit: int = 200_000) -> Iterator[pa.Table]:
    """Regroup rows sorted by ``keys`` into tables of about ``limit`` rows that never cut a key in two."""
    held: list[pa.RecordBatch] = []
    rows = 0

    def tail(batch: pa.RecordBatch) -> int:
        """Row at which the last key of the batch begins."""
        start = 0
        for k in keys:
            column = batch.column(k)
            same = column.slice(start).equals(pa.array([column[-1].as_py()] * (len(column) - start), column.type))
            if not same:
                values = column.to_numpy(zero_copy_only=False)
                other = np.flatnonzero(values[start:] != values[-1])
                start += int(other[-1]) + 1
        return start

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows += batch.num_rows
        if rows >= limit:
            table = pa.Table.from_batches(held).combine_chunks()
            whole = table.to_batches()[0] if table.num_rows else batch
            cut = tail(whole)
            if cut:
                yield table.slice(0, cut)
                held = [whole.slice(cut)]
                rows = held[0].num_rows
            else:
                held = [whole]
    if rows:
        yield pa.Table.from_batches(held).combine_chunks()


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """``starts[i], starts[i] + 1, ...`` for ``counts[i]`` values each, one after the other."""
    counts = counts.astype(np.int64)
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total, dtype=np.int64) + np.repeat(starts.astype(np.int64) - (ends - counts), counts)


def fresh(name: str, columns: list[str]) -> str:
    """``name``, made longer until no column is called so."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def sums(values: np.ndarray, offsets: np.ndarray, dtype=None) -> np.ndarray:
    """Sums of ``values[offsets[i]:offsets[i + 1]]`` along the first axis; empty pieces give zero."""
    shape = (len(offsets) - 1, *values.shape[1:])
    out = np.zeros(shape, dtype or values.dtype)
    full = np.flatnonzero(offsets[1:] > offsets[:-1])
    if len(full):
        out[full] = np.add.reduceat(values, offsets[:-1][full], axis=0, dtype=dtype)
    return out
