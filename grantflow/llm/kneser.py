"""Interpolated modified Kneser-Ney language model of any order from two on.

Counting is Spark work: tasks count the words of their documents, and then the runs of ``order`` words, and deal the
counts in packed blocks to shards. Each shard is summed, sorted and written as arrays to the shared folder, and passes
on in how many contexts the shorter runs occur, which are the counts of the level below. Scoring tasks memory-map these
arrays and find words and runs by binary search. A word is found by its 64-bit hash and is a dense 32-bit number in
runs; contexts of one or two words are these numbers, longer ones a 64-bit hash of them. A run lies in the shard of the
word before its last one; if that is very frequent and would drown a shard, in that of the two words before, and so on,
and if the whole context is as frequent, in a second family of shards by the last word.

The first words of a text have fewer words before them. Their contexts begin with the beginning of the text, and their
own counts count at the level of that length.
"""

from __future__ import annotations

import math
import os
import uuid
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grantflow.session import cut, shared_folder

from .common import mix64, ranges, sums, text_blocks, text_bytes, text_of
from .simhash import LOWER, SPACE
from .suffixes import Hashes

#: Tokens counted in one go, and bytes of text scored in one go.
COUNTED, SCORED = 5 << 19, 1 << 21

#: Bytes of training text per shard, and the most shards of a family (a power of two).
SHARD_BYTES, MOST_SHARDS = 12_000_000, 1 << 16

#: A context with more than this share of all tokens is dealt by more words.
HOT_SHARE = 1e-3

#: Frequent words that each shard reports as possibly hot.
REPORTED = 64

#: Bytes of text from which frequent contexts are sought in a sample of about that size; it affects balance alone.
HOT_SAMPLE = 1 << 26

#: Contexts of more words than this have the sums of their counts stored.
SUMMED = 16

#: Hash of the end of a text. Numbers of the beginning (which is only a context) and of words not in the model.
END, BEGIN, UNKNOWN = np.uint64(0x9D39247E33776D41), np.uint32(0xFFFFFFFE), np.uint32(0xFFFFFFFF)


class Meta(NamedTuple):
    """What scoring needs besides the arrays: totals, discounts per level, and hot contexts with their sums.

    ``first`` has the number of the first word of each shard of words. ``hot`` and ``hot_sums`` are by length of the
    context, ``discounts`` by length of the run.
    """

    folder: str
    bits: int
    first: np.ndarray
    order: int
    tokens: int
    types: int
    pairs: int
    discounts: list[list[float]]
    levels: list[int]
    hot: list[np.ndarray]
    hot_sums: list[tuple[np.ndarray, np.ndarray]]


def tokens(flat: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tokens of all texts, an end after each text, and the offsets of the texts."""
    n, texts = len(flat), len(offsets) - 1
    space = SPACE[flat]
    first, last = ~space, ~space
    if n:
        inner = offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < n)]
        first[1:] &= space[:-1]
        last[:-1] &= space[1:]
        first[inner] = ~space[inner]
        last[inner - 1] = ~space[inner - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    words = np.searchsorted(start, offsets)
    at = words + np.arange(texts + 1)
    out = np.full(len(start) + texts, END, np.uint64)
    out[np.arange(len(start)) + np.repeat(np.arange(texts), np.diff(words))] = Hashes(LOWER[flat]).of(start, end - start)
    return out, at


def runs_of(ids: np.ndarray, at: np.ndarray, order: int) -> list[np.ndarray]:
    """Columns of the ``order`` words up to each token, with the beginning before the first of a text."""
    place = np.arange(len(ids)) - np.repeat(at[:-1], np.diff(at))
    return [np.where(place < d, BEGIN, np.roll(ids, d)) for d in range(order - 1, 0, -1)] + [ids]


def context_key(columns: list[np.ndarray]) -> np.ndarray:
    """One word as it is, two words with the last one first, more as a hash."""
    if len(columns) == 2:
        return columns[1].astype(np.uint64) << np.uint64(32) | columns[0]
    key = columns[0].astype(np.uint64)
    for c in columns[1:]:
        key = mix64(key) * np.uint64(0x9E3779B97F4A7C15) + c
    return key


def among(values: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which ``values`` are among the sorted ``keys``."""
    return keys[np.minimum(np.searchsorted(keys, values), len(keys) - 1)] == values if len(keys) else np.zeros(len(values), bool)


def distinct(columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """An order of the runs by context and word, and where a new run begins in it."""
    if len(columns) < 3:
        key = context_key(columns[::-1])
        order = np.argsort(key)
        key = key[order]
    else:
        # Two plain sorts are faster than one by two keys: contexts are numbered before the second.
        key = context_key(columns[:-1])
        order = np.argsort(key)
        key = key[order]
        number = np.zeros(len(key), np.uint64)
        np.cumsum(key[1:] != key[:-1], out=number[1:])
        key = number << np.uint64(32) | columns[-1][order]
        again = np.argsort(key)
        order, key = order[again], key[again]
    return order, np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(order) else np.zeros(0, np.int64)


def counted_runs(columns: list[np.ndarray], times: np.ndarray | None = None) -> tuple[list[np.ndarray], np.ndarray]:
    """Sorted distinct runs and how often they occur, or the sums of ``times``."""
    order, first = distinct(columns)
    bounds = np.append(first, len(order))
    return [c[order[first]] for c in columns], (np.diff(bounds) if times is None else sums(times[order], bounds))


def counted(keys: np.ndarray, times: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and how often they occur, or the sums of ``times``."""
    if times is None:
        keys = np.sort(keys)
    else:
        order = np.argsort(keys)
        keys, times = keys[order], times[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    bounds = np.append(first, len(keys))
    return keys[first], (np.diff(bounds) if times is None else sums(times, bounds))


def planes(x: np.ndarray) -> bytes:
    """Bytes of numbers, all first bytes, then all second bytes and so on: sorted numbers compress well so."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.dtype.itemsize).T).tobytes()


def unplanes(raw: bytes, dtype) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(size, -1).T).view(dtype).ravel()


def squeezed(raw: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(raw)


def unsqueezed(raw) -> bytes:
    return zstandard.ZstdDecompressor().decompress(raw)


def packed_counts(keys: np.ndarray, n: np.ndarray, shard: np.ndarray) -> pa.RecordBatch:
    """One row per shard with its keys and counts; keys come sorted by shard."""
    shards, first = np.unique(shard, return_index=True)
    bounds = np.append(first, len(keys)).tolist()
    pieces = [slice(a, b) for a, b in zip(bounds, bounds[1:])]
    return pa.RecordBatch.from_arrays([
        pa.array(shards.astype(np.int32)), pa.array([squeezed(planes(keys[p])) for p in pieces], pa.binary()),
        pa.array([squeezed(planes(n[p].astype(np.uint32))) for p in pieces], pa.binary()),
    ], names=["shard", "keys", "n"])


PACKED = "shard int, keys binary, n binary"


def stepped(width: int) -> int:
    """Number of columns of which steps are kept."""
    return max(width - 1, 1)


def packed_runs(columns: list[np.ndarray], n: np.ndarray, shard: np.ndarray) -> pa.RecordBatch:
    """One row per shard with its runs, column after column, and their counts; runs come sorted.

    Of the words of the context, which rise or nearly do, the steps are kept.
    """
    order = np.argsort(shard.astype(np.int32), kind="stable")
    shards, first = np.unique(shard[order], return_index=True)
    pieces = [order[a:b] for a, b in zip(first, [*first[1:], len(order)])]

    def keys(p: np.ndarray) -> bytes:
        return squeezed(b"".join(planes(np.diff(c[p], prepend=np.uint32(0)) if i < stepped(len(columns)) else c[p]) for i, c in enumerate(columns)))

    return pa.RecordBatch.from_arrays([
        pa.array(shards.astype(np.int32)), pa.array([keys(p) for p in pieces], pa.binary()),
        pa.array([squeezed(planes(n[p].astype(np.uint32))) for p in pieces], pa.binary()),
    ], names=["shard", "keys", "n"])


def unpacked_runs(raw: bytes, width: int) -> list[np.ndarray]:
    raw = unsqueezed(raw)
    size = len(raw) // width
    columns = [unplanes(raw[i * size : (i + 1) * size], np.uint32) for i in range(width)]
    return [np.cumsum(c, dtype=np.uint32) if i < stepped(width) else c for i, c in enumerate(columns)]


def shards_of(batches: Iterator[pa.RecordBatch], width: int = 0) -> Iterator[tuple]:
    """Summed counts of each shard, from rows sorted by shard: of words, or of runs of ``width`` words."""
    shard, held = None, []

    def done():
        times = np.concatenate([unplanes(unsqueezed(n), np.uint32) for _, n in held]).astype(np.int64)
        if width:
            columns = [np.concatenate(c) for c in zip(*(unpacked_runs(k, width) for k, _ in held))]
            held.clear()
            return (shard, *counted_runs(columns, times))
        keys = np.concatenate([unplanes(unsqueezed(k), np.uint64) for k, _ in held])
        held.clear()
        return (shard, *counted(keys, times))

    for batch in batches:
        # Values are views of the batch, not copies of it.
        for s, *parts in zip(batch.column("shard").to_pylist(), batch.column("keys"), batch.column("n")):
            if s != shard and held:
                yield done()
            shard = s
            held.append(tuple(x.as_buffer() for x in parts))
    if held:
        yield done()


def write_arrays(path: str, *arrays: np.ndarray) -> None:
    """Arrays one after the other in one file, which appears only when complete."""
    temporary = f"{path}.{uuid.uuid4().hex}"
    with open(temporary, "wb") as f:
        np.array([len(a) for a in arrays], np.int64).tofile(f)
        for a in arrays:
            a.tofile(f)
            f.write(b"\0" * (-a.nbytes % 8))
    os.replace(temporary, path)


def read_arrays(path: str, *dtypes) -> list[np.ndarray]:
    """Memory-mapped arrays of such a file; empty ones if there is none."""
    if not os.path.exists(path):
        return [np.zeros(0, d) for d in dtypes]
    raw = np.memmap(path, np.uint8, "r")
    lengths = raw[: 8 * len(dtypes)].view(np.int64).tolist()
    out, at = [], 8 * len(dtypes)
    for n, d in zip(lengths, dtypes):
        size = n * np.dtype(d).itemsize
        out.append(raw[at : at + size].view(d))
        at += size + -size % 8
    return out


def local_path(folder: str) -> str:
    """The shared folder as a path; workers map files, so it must be mounted on all machines."""
    scheme, colon, rest = folder.partition(":")
    if not colon:
        return folder
    if scheme != "file":
        raise ValueError("the language model needs a mounted shared folder (file:) in spark.checkpoint.dir")
    return "/" + rest.lstrip("/")


#: Contexts per stored bound, as a power of two, where their runs are few enough.
BLOCK = 8


def packed_bounds(bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rising numbers as one for each block and small steps from it: the block's power of two, blocks, steps.

    Blocks are as small as it takes for the steps to fit into two bytes.
    """
    for power in range(BLOCK, -1, -1):
        first = bounds[:: 1 << power]
        steps = bounds - np.repeat(first, 1 << power)[: len(bounds)]
        if steps.max() < 1 << 16:
            return np.array([power]), first.astype(np.uint32), steps.astype(np.uint16)
    raise ValueError("numbers do not rise")


def split_contexts(context: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct contexts of runs of ``width`` words as last words, where the contexts of each begin, and the rest.

    Single words and hashes have no last word; they are all under zero.
    """
    if width != 3:
        return np.zeros(1, np.uint32), np.array([0, len(context)], np.uint32), context.astype(rest_type(width))
    last = (context >> np.uint64(32)).astype(np.uint32)
    head = np.flatnonzero(np.append(True, last[1:] != last[:-1])) if len(last) else np.zeros(0, np.int64)
    return last[head], np.append(head, len(last)).astype(np.uint32), context.astype(np.uint32)


def rest_type(width: int):
    return np.uint64 if width > 3 else np.uint32


def place_of(values: np.ndarray, low: np.ndarray, high: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of the ``asked`` are in their sorted slice ``low`` to ``high`` of ``values``, and where."""
    at, end, open_ = low.copy(), high.copy(), np.flatnonzero(low < high)
    while len(open_):
        a, b = at[open_], end[open_]
        middle = (a + b) >> 1
        below = values[middle] < asked[open_]
        a, b = np.where(below, middle + 1, a), np.where(below, b, middle)
        at[open_], end[open_] = a, b
        open_ = open_[a < b]
    hit = np.flatnonzero(at < high)
    hit = hit[values[at[hit]] == asked[hit]]
    return hit, at[hit]


def count_of_counts(n: np.ndarray) -> list[int]:
    return [int(np.count_nonzero(n == k)) for k in (1, 2, 3, 4)]


def discounts(levels: list[int], positive: bool = False) -> list[float]:
    """Discounts for counts of one, two, and three or more; kept between zero and the count where counts are scarce.

    With ``positive``, a zero becomes the usual discount: contexts with such counts alone would leave new words no chance.
    """
    usual = [0.5, 0.75, 0.9]
    n1, n2, n3, n4 = levels
    if not n1 or not n2:
        return usual
    y = n1 / (n1 + 2 * n2)
    raw = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 1.5]
    kept = [min(max(d, 0.0), k) for k, d in enumerate(raw, 1)]
    return [d or u for d, u in zip(kept, usual)] if positive else kept


def run_shard(columns: list[np.ndarray], bits: int, hot: list[np.ndarray]) -> np.ndarray:
    """Shard of runs: by the shortest end of the context that is not hot, or else by the word, in the second family."""
    shift = np.uint64(64 - bits)
    shard = (1 << bits) + (mix64(columns[-1]) >> shift).astype(np.int64)
    left = np.arange(len(shard))
    for length in range(1, len(columns)):
        key = context_key([c[left] for c in columns[-1 - length : -1]])
        alone = among(key, hot[length])
        shard[left[~alone]] = (mix64(key[~alone]) >> shift).astype(np.int64)
        left = left[alone]
    return shard


def in_pieces(emit):
    """``emit`` for about ``COUNTED`` tokens at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in text_blocks(batches, "_text"):
            held.append(tokens(*text_bytes(batch.column("_text"))))
            rows += len(held[-1][0])
            if rows >= COUNTED:
                out = emit(held)
                held, rows = [], 0
                yield out
        if held:
            yield emit(held)

    return run


def _count_words(bits: int):
    """Packed counts of the words of a task's documents."""

    def emit(held):
        keys, n = counted(np.concatenate([t for t, _ in held]))
        return packed_counts(keys, n, keys >> np.uint64(64 - bits))

    return in_pieces(emit)


def joined(held: list, words: Words, order: int) -> list[np.ndarray]:
    """Runs of all texts of ``held``."""
    ids = words.ids(np.concatenate([t for t, _ in held]))
    before = np.cumsum([0, *(len(t) for t, _ in held)])
    return runs_of(ids, np.concatenate([[0], *(at[1:] + b for (_, at), b in zip(held, before))]), order)


def _count_runs(place: tuple, order: int, hot: list[np.ndarray]):
    """Packed counts of the runs of a task's documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(*place)

        def emit(held):
            columns, n = counted_runs(joined(held, words, order))
            return packed_runs(columns, n, run_shard(columns, words.bits, hot))

        return in_pieces(emit)(batches)

    return run


def _hot_contexts(place: tuple, length: int):
    """Contexts with at least half of ``HOT_SHARE`` of the tokens counted in one go, and their counts."""
    share = HOT_SHARE

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(*place)

        def emit(held):
            keys, n = counted(context_key(joined(held, words, length + 1)[:-1]))
            often = n > n.sum() * share / 2
            return pa.RecordBatch.from_arrays([pa.array(keys[often].view(np.int64)), pa.array(n[often].astype(np.int64))], names=["key", "n"])

        return in_pieces(emit)(batches)

    return run


def _store_words(folder: str):
    """Write the words of each shard; report tokens, types and the most frequent words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, keys, n in shards_of(batches):
            write_arrays(f"{folder}/words-{shard}", keys, n)
            top = np.sort(np.argsort(-n, kind="stable")[:REPORTED])
            yield pa.RecordBatch.from_arrays([
                pa.array([shard], pa.int32()), pa.array([int(n.sum())]), pa.array([len(n)]),
                pa.array([keys[top].view(np.int64).tolist()]), pa.array([n[top].tolist()]),
            ], names=["shard", "tokens", "types", "top", "top_n"])

    return run


def _store_runs(folder: str, bits: int, width: int, hot: list[np.ndarray], first: np.ndarray):
    """Write the runs of each shard by context; pass on in how many contexts the runs without the first word occur."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, columns, n in shards_of(batches, width):
            rest = columns[1:]
            # Runs padded with more than one beginning belong to the level below, with their own counts.
            padded = (columns[0] == BEGIN) & (columns[1] == BEGIN) if width > 2 else np.zeros(len(n), bool)
            below = counted_runs(rest, np.where(padded, n, 1))
            below = packed_runs(*below, run_shard(below[0], bits, hot) if width > 2 else word_shard(below[0][0], first))
            context, second, n = context_key(columns[:-1])[~padded], columns[-1][~padded], n[~padded]
            head = np.flatnonzero(np.append(True, context[1:] != context[:-1])) if len(n) else np.zeros(0, np.int64)
            bounds = np.append(head, len(n))
            total = sums(np.stack([n, n == 1, n == 2, n > 2], 1).astype(np.int64), bounds)
            large, many = np.flatnonzero(n > 255), np.flatnonzero(np.diff(bounds) > SUMMED)
            write_arrays(f"{folder}/runs-{width}-{shard}", *split_contexts(context[head], width), *packed_bounds(bounds), many.astype(np.int64),
                         total[many].ravel(), second, np.minimum(n, 255).astype(np.uint8), large, n[large])
            alone = shard >= 1 << bits
            write_arrays(f"{folder}/totals-{width}-{shard}", np.array([*count_of_counts(n), len(n)], np.int64),
                         context[head] if alone else context[:0], total.ravel() if alone else total[:0].ravel())
            del columns, rest, context, second, n, head, bounds, total, padded
            yield below

    return run


def _totals(folder: str, bits: int):
    """Totals per shard, and the sums of contexts that are split over shards."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in batch.column("id").to_pylist():
                width, shard = divmod(at, 2 << bits)
                levels, key, total = read_arrays(f"{folder}/totals-{width + 2}-{shard}", np.int64, np.uint64, np.int64)
                if len(levels):
                    yield pa.RecordBatch.from_arrays([
                        pa.array([width + 2], pa.int32()), pa.array([levels.tolist()]), pa.array([key.view(np.int64).tolist()], pa.list_(pa.int64())),
                        pa.array([total.tolist()], pa.list_(pa.int64())),
                    ], names=["width", "levels", "hot", "hot_sums"])

    return run


def word_shard(ids: np.ndarray, first: np.ndarray) -> np.ndarray:
    return np.searchsorted(first, ids, "right") - 1


def _store_continuations(folder: str, first: np.ndarray):
    """Write in how many contexts each word of a shard occurs; report counts of these counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, (ids,), n in shards_of(batches, 1):
            times = np.zeros(first[shard + 1] - first[shard], np.int64)
            times[ids - first[shard]] = n
            write_arrays(f"{folder}/continuations-{shard}", times)
            yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([[*count_of_counts(n), int(np.count_nonzero(n > 2)), int(n.sum())]])], names=["shard", "levels"])

    return run


def dealt(rows: DataFrame, shards: int) -> DataFrame:
    """Rows of a shard together, about one shard a task, so that a task's memory is that of a shard."""
    return rows.repartition(shards, "shard").sortWithinPartitions("shard")


def fit(docs: DataFrame, text: str = "text", order: int = 2) -> Meta:
    """Count a model of runs of ``order`` words over all rows of ``docs`` and store it in the shared folder.

    Null texts are empty. Driver and broadcasts hold totals, discounts, one number per shard of words, and the hot
    contexts (at most ``2 / HOT_SHARE`` of each length) alone.
    """
    if order < 2:
        raise ValueError("a model needs runs of at least two words")
    spark = docs.sparkSession
    folder = f"{local_path(shared_folder(spark))}/ngrams-{uuid.uuid4().hex}"
    os.makedirs(folder)
    texts = docs.select(text_of(docs, text).alias("_text"))
    size = texts.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    bits = max(2, min(MOST_SHARDS.bit_length() - 1, math.ceil(math.log2(max(1, size / SHARD_BYTES)))))
    words = dealt(texts.mapInArrow(_count_words(bits), PACKED), 1 << bits).mapInArrow(
        _store_words(folder), "shard int, tokens long, types long, top array<long>, top_n array<long>").collect()
    total, types = sum(r["tokens"] for r in words), sum(r["types"] for r in words)
    if types >= BEGIN:
        raise ValueError("more distinct words than 32-bit numbers")
    first = np.zeros((1 << bits) + 1, np.int64)
    for r in words:
        first[r["shard"] + 1] = r["types"]
    first = np.cumsum(first)
    place = (folder, bits, first)
    often = max(total * HOT_SHARE, COUNTED / 100)
    top = np.unique(np.array([w for r in words for w, n in zip(r["top"], r["top_n"]) if n > often], np.int64).view(np.uint64))
    hot_words = Words(*place).ids(top)
    hot = [np.zeros(0, np.uint64), np.unique(np.append(hot_words, [BEGIN] if END in top else []).astype(np.uint64))]
    parts = max(1, size // HOT_SAMPLE)
    some = texts.where(F.pmod(F.xxhash64("_text"), F.lit(parts)) == 0) if parts > 1 else texts
    for length in range(2, order):
        frequent = some.mapInArrow(_hot_contexts(place, length), "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
        found_ = frequent.where(F.col("n") > often / parts / 2).orderBy(F.desc("n"), "key").limit(int(2 / HOT_SHARE)).collect()
        hot.append(np.unique(np.array([r["key"] for r in found_], np.int64).view(np.uint64)))
    rows = texts.mapInArrow(_count_runs(place, order, hot), PACKED)
    for width in range(order, 1, -1):
        rows = dealt(rows, 2 << bits).mapInArrow(_store_runs(folder, bits, width, hot, first), PACKED)
    levels = dealt(rows, 1 << bits).mapInArrow(_store_continuations(folder, first), "shard int, levels array<long>").collect()
    upper = [sum(r["levels"][i] for r in levels) for i in range(6)]
    part = cut(spark.range((order - 1) * (2 << bits)).mapInArrow(_totals(folder, bits), "width int, levels array<long>, hot array<long>, hot_sums array<long>"))
    by_width = {r["width"]: r for r in part.groupBy("width").agg(*[F.sum(F.col("levels")[i]).alias(f"n{i}") for i in range(4)]).collect()}
    split = part.where(F.size("hot") > 0).select("width", F.posexplode("hot").alias("i", "key"), "hot_sums").groupBy("width", "key").agg(
        *[F.sum(F.col("hot_sums")[F.col("i") * 4 + k]).alias(f"s{k}") for k in range(4)]).collect()
    hot_sums = [(np.zeros(0, np.uint64), np.zeros((0, 4)))]
    for width in range(2, order + 1):
        mine = [r for r in split if r["width"] == width]
        key = np.array([r["key"] for r in mine], np.int64).view(np.uint64)
        by_key = np.argsort(key)
        hot_sums.append((key[by_key], np.array([[r[f"s{k}"] for k in range(4)] for r in mine], np.float64).reshape(-1, 4)[by_key]))
    counts = [upper[:4], *([by_width[w][f"n{i}"] for i in range(4)] if w in by_width else [0] * 4 for w in range(2, order + 1))]
    return Meta(folder, bits, first, order, total, types, upper[5], [discounts(c, order > 2) for c in counts], [*upper[:2], upper[4]], hot, hot_sums)


class Words:
    """Numbers and counts of words from the stored arrays."""

    def __init__(self, folder: str, bits: int, first: np.ndarray):
        self.folder, self.bits, self.first, self.open = folder, bits, first, {}

    def arrays(self, name: str, shard: int, *dtypes) -> list[np.ndarray]:
        key = (name, shard)
        if key not in self.open:
            if len(self.open) > 20_000:
                self.open.clear()
            self.open[key] = read_arrays(f"{self.folder}/{name}-{shard}", *dtypes)
        return self.open[key]

    @staticmethod
    def runs(shard: np.ndarray):
        """Slices of equal values of a sorted array."""
        shards, first = np.unique(shard, return_index=True)
        return zip(shards.tolist(), (slice(a, b) for a, b in zip(first.tolist(), [*first[1:].tolist(), len(shard)])))

    def words(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Numbers and counts of sorted distinct words, and in how many contexts they occur."""
        ids, n, contexts = np.full(len(words), UNKNOWN), np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        for shard, part in self.runs(words >> np.uint64(64 - self.bits)):
            keys, values = self.arrays("words", shard, np.uint64, np.int64)
            if not len(keys):
                continue
            at = np.minimum(np.searchsorted(keys, words[part]), len(keys) - 1)
            known = np.flatnonzero(keys[at] == words[part])
            at, known = at[known], known + part.start
            ids[known], n[known] = self.first[shard] + at, values[at]
            (times,) = self.arrays("continuations", shard, np.int64)
            if len(times):
                contexts[known] = times[at]
        return ids, n, contexts

    def ids(self, token: np.ndarray) -> np.ndarray:
        word, of = np.unique(token, return_inverse=True)
        return self.words(word)[0][of]


class Reader(Words):
    """Probabilities of words and runs from the stored arrays."""

    def __init__(self, meta: Meta):
        super().__init__(meta.folder, meta.bits, meta.first)
        self.meta = meta

    def counts(self, columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Counts of distinct runs, and the sums of their contexts (all, once, twice, more often)."""
        width, n, total = len(columns), np.zeros(len(columns[0]), np.int64), np.zeros((len(columns[0]), 4))
        contexts = context_key(columns[:-1])
        shard = run_shard(columns, self.meta.bits, self.meta.hot)
        order = np.argsort(shard, kind="stable")
        for s, part in self.runs(shard[order]):
            row = order[part]
            last, begins, rest, power, blocks, steps, many, level, words, small, large, count = self.arrays(
                f"runs-{width}", s, np.uint32, np.uint32, rest_type(width), np.int64, np.uint32, np.uint16,
                np.int64, np.int64, np.uint32, np.uint8, np.int64, np.int64)
            if not len(rest):
                continue
            asked = contexts[row] >> np.uint64(32) if width == 3 else np.zeros(len(row), np.uint64)
            at = np.minimum(np.searchsorted(last, asked.astype(np.uint32)), len(last) - 1)
            known = np.flatnonzero(last[at] == asked)
            row, at = row[known], at[known]
            hit, at = place_of(rest, begins[at].astype(np.int64), begins[at + 1].astype(np.int64), contexts[row].astype(rest.dtype))
            row, second = row[hit], columns[-1][row[hit]]
            low, high = (blocks[i >> power[0]].astype(np.int64) + steps[i] for i in (at, at + 1))
            if s < 1 << self.meta.bits:
                place = np.searchsorted(many, at)
                stored = high - low > SUMMED
                total[row[stored]] = level.reshape(-1, 4)[place[stored]]
                few = np.flatnonzero(~stored)
                all_ = self.at(small, large, count, ranges(low[few], (high - low)[few]))
                ends = np.append(0, np.cumsum((high - low)[few]))
                total[row[few]] = sums(np.stack([all_, all_ == 1, all_ == 2, all_ > 2], 1).astype(np.int64), ends)
            hit, at = place_of(words, low, high, second)
            n[row[hit]] = self.at(small, large, count, at)
        keys, hot_sums = self.meta.hot_sums[width - 1]
        split = np.flatnonzero(shard >= 1 << self.meta.bits)
        split = split[among(contexts[split], keys)]
        total[split] = hot_sums[np.searchsorted(keys, contexts[split])]
        return n, total

    @staticmethod
    def at(small: np.ndarray, large: np.ndarray, count: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Counts at ``rows``."""
        value = small[rows].astype(np.int64)
        more = np.flatnonzero(value == 255)
        if len(more) and len(large):
            value[more] = found(large, count, rows[more], value[more])
        return value

    def score(self, token: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per text: known tokens, log10 probability by counts plus one, and by the model."""
        meta = self.meta
        word, of = np.unique(token, return_inverse=True)
        ids, n, continuations = self.words(word)
        base = np.log10((n + 1) / (meta.tokens + meta.types + 1))
        lower = np.array([0, *meta.discounts[0]])
        share = np.maximum(continuations - lower[np.minimum(continuations, 3)], 0)
        left = float(np.dot(meta.levels, meta.discounts[0])) if meta.pairs else 1.0
        p = ((share + left / (meta.types + 1)) / max(meta.pairs, 1))[of]
        columns = runs_of(ids[of], at, meta.order)
        for width in range(2, meta.order + 1):
            runs = columns[-width:]
            order, first = distinct(runs)
            times, total = self.counts([c[order[first]] for c in runs])
            which = np.empty(len(order), np.int64)
            which[order] = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(order))))
            upper = np.array([0, *meta.discounts[width - 1]])
            more, rest = np.maximum(times - upper[np.minimum(times, 3)], 0)[which], (total[:, 1:] @ upper[1:])[which]
            total = total[which, 0]
            seen = total > 0
            p[seen] = (more[seen] + rest[seen] * p[seen]) / total[seen]
        return sums((n > 0)[of], at, np.int64), sums(base[of], at), sums(np.log10(p), at)


def found(keys: np.ndarray, values: np.ndarray, asked: np.ndarray, default=0) -> np.ndarray:
    """``values`` of the ``asked`` among sorted ``keys``; ``default`` for those that are none."""
    if not len(keys):
        return np.full(len(asked), default)
    at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
    return np.where(keys[at] == asked, values[at], default)


def score(docs: DataFrame, meta: Meta, text: str = "text") -> DataFrame:
    """Adds ``n_tokens``, ``n_known``, ``base_score``, ``score`` and ``perplexity`` to every row of ``docs``.

    Tokens are the words of the text with A-Z lower-cased, and its end. ``score`` is the log10 probability by the
    model, ``base_score`` by word counts plus one. Null texts are empty: their only token is the end. Every row
    stays; columns of the added names are replaced.
    """
    added = ("n_tokens", "n_known", "base_score", "score", "perplexity")
    keep = [c for c in docs.columns if c not in added]
    source = docs.select(*keep)
    schema = T.StructType(list(source.schema)).add("n_tokens", "long").add("n_known", "long")
    for name in added[2:]:
        schema = schema.add(name, "double")
    shared = docs.sparkSession.sparkContext.broadcast(meta)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(shared.value)
        for batch in text_blocks(batches, text, SCORED):
            token, at = tokens(*text_bytes(batch.column(text)))
            known, base, model = reader.score(token, at)
            made = [np.diff(at), known, base, model, 10 ** (-model / np.diff(at))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, made)], names=schema.names)

    return source.mapInArrow(run, schema)


def fit_and_score(docs: DataFrame, learn: Column, text: str = "text", order: int = 2) -> DataFrame:
    """Score all rows by a model of those where ``learn`` holds; adds ``train_tokens`` to what ``score`` adds."""
    meta = fit(docs.where(learn), text, order)
    return score(docs, meta, text).withColumn("train_tokens", F.lit(meta.tokens).cast("long"))
