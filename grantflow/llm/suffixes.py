"""Removal of repeated byte strings with a sparse suffix array.

A string of ``length`` bytes is repeated if it also starts earlier: in a document of smaller id, or in the same one
further left. Its later occurrences are removed. Sorting every suffix of a corpus would move each byte a hundred
times, so only suffixes at anchors are sorted: of the ``length - LEAD + 1`` leads (runs of ``LEAD`` bytes) inside a
string, the one with the least hash. Equal strings have equal anchors at equal places, so no repeat is missed, and
every string belongs to exactly one anchor.

1. Anchors are dealt by the hash of their lead. Anchors whose whole surroundings (all strings they stand for) are equal
   collapse: all but the first are repeats as a whole. Within a task this is done before anything is moved.
2. What is left of leads that occur in different surroundings is compared byte by byte: suffixes are range-partitioned
   by their leading bytes with splitters sampled by Spark, each bucket is sorted locally by a multikey quicksort on
   words of eight bytes, and neighbours in that order that agree in ``length`` bytes are equal strings. Suffixes with
   equal leading bytes never lie on two sides of a splitter, so nothing is left to compare across boundaries.
3. Leads of very many rows (a line that a third of all documents share) are found from a sample beforehand; their
   strings are dealt by their own hash, one by one, so no task gets the whole group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import NULL_ID, key_runs, mix64, ranges, text_blocks, text_bytes, text_of

#: Bytes of a repeated string, and of the lead that anchors it.
LENGTH, LEAD = 100, 40

#: A lead is dealt string by string if it is expected to have more rows than this, or than this share of all.
HOT_ROWS, HOT_SHARE = 100_000, 1e-4

#: One in so many documents is read to expect the number of rows of a lead; this affects balance alone.
HOT_SAMPLE = 256

#: Bytes of text whose anchors are sought in one go, and anchors of equal leads settled in one go.
SOUGHT, SETTLED = 1 << 20, 1 << 18

#: Anchors compared byte by byte at a time.
COMPARED = 16_384

#: Bases of two independent hashes, and the numbers they give the bytes.
BASES = 0xD1342543DE82EF95, 0x9FB21C651E98DF25
LETTERS = mix64(np.arange(1, 257, dtype=np.uint64)), mix64(np.arange(1_001, 1_257, dtype=np.uint64))


class Powers:
    """Powers of a hash base and of its inverse modulo 2**64."""

    def __init__(self, base: int):
        self.base = base
        self.up = self.down = np.ones(1, np.uint64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            n = 1 << int(n).bit_length()
            for name, base in (("up", self.base), ("down", pow(self.base, -1, 1 << 64))):
                steps = np.full(n, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps))
        return self.up, self.down


POWERS = tuple(map(Powers, BASES))


class Hashes:
    """Hashes of all substrings of one buffer from prefix sums; ``which`` of the two."""

    def __init__(self, flat: np.ndarray, which: int = 0):
        up, self.down = POWERS[which].to(len(flat) + 1)
        self.sums = np.append(np.uint64(0), np.cumsum(LETTERS[which][flat] * up[: len(flat)]))

    def of(self, start: np.ndarray, size) -> np.ndarray:
        return mix64((self.sums[start + size] - self.sums[start]) * self.down[start] + np.asarray(size, np.uint64))


def anchors(flat: np.ndarray, offsets: np.ndarray, length: int = LENGTH, lead: int = LEAD):
    """Anchors of all strings of ``length`` bytes inside the texts of a buffer.

    Returns hashes, and per anchor: place of the anchor, of its first string, and how many strings it stands for
    (they begin at neighbouring places).
    """
    hashes = Hashes(flat)
    sizes = np.diff(offsets)
    place = ranges(offsets[:-1], np.maximum(sizes - length + 1, 0))
    if not len(place):
        return hashes, place, place, place
    leads = (hashes.sums[lead:] - hashes.sums[:-lead]) * hashes.down[: len(flat) - lead + 1]
    bits = np.uint64(max(20, len(flat).bit_length()))
    low = mix64(leads) >> bits << bits | np.arange(len(leads), dtype=np.uint64)
    span, want = 1, length - lead + 1
    while span < want:
        step = min(span, want - span)
        low = np.minimum(low[:-step], low[step:])
        span += step
    at = (low[place] & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    first = np.flatnonzero(np.append(True, (at[1:] != at[:-1]) | (place[1:] != place[:-1] + 1)))
    return hashes, at[first], place[first], np.diff(np.append(first, len(at)))


def pack(start: np.ndarray, relative: np.ndarray, strings: np.ndarray) -> np.ndarray:
    """Place of the first string in its document, distance from there to the anchor, and number of strings."""
    return start << 16 | relative << 8 | strings


def unpack(packed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return packed >> 16, packed >> 8 & 255, packed & 255


def firsts(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order of the rows by all columns, and where a new value of the first two begins in it."""
    order = np.lexsort(columns[::-1])
    a, b = columns[0][order], columns[1][order]
    return order, np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])) if len(a) else np.zeros(0, bool)


def first_copies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows but later copies of a text with its id. As a filter of the table it would become part of the window below,
    and the shuffle of the texts would not be reused."""
    for batch in batches:
        yield batch.filter(pc.equal(batch.column("_copy"), 1))


def _anchor_rows(hot: np.ndarray, length: int, lead: int):
    """Rows ``(key, around, id, seq, packed, done)`` of texts without copies of their id; ``done`` rows are repeats already, all others are not known."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_blocks(first_copies(batches), "_text", SOUGHT):
            flat, offsets = text_bytes(batch.column("_text"))
            hashes, at, start, strings = anchors(flat, offsets, length, lead)
            key = hashes.of(at, lead).view(np.int64)
            if len(hot):
                alone = hot[np.minimum(np.searchsorted(hot, key), len(hot) - 1)] == key
                times = np.where(alone, strings, 1)
                row = np.repeat(np.arange(len(at)), times)
                step = np.where(alone[row], np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times), 0)
                at, start, strings, key, alone = at[row], start[row] + step, np.where(alone[row], 1, strings[row]), key[row], alone[row]
                key[alone] = hashes.of(start[alone], length).view(np.int64)
                relative = np.where(alone, 0, at - start)
            else:
                relative = at - start
            # A second hash, so that strings dealt one by one are told apart by both.
            around = (Hashes(flat, 1).of(start, strings + length - 1) ^ mix64((relative << 8 | strings).astype(np.uint64))).view(np.int64)
            doc = np.searchsorted(offsets, start, "right") - 1
            ids, seq = batch.column("_id").to_numpy()[doc], batch.column("_seq").to_numpy()[doc]
            packed = pack(start - offsets[doc], relative, strings)
            order, new = firsts(key, around, ids, seq, packed)
            done = np.zeros(len(order), bool)
            done[order] = ~new
            # What is known goes with its document's hash, so that a group of copies is not gathered.
            key[done] = mix64(ids[done].astype(np.uint64) ^ seq[done].view(np.uint64)).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (key, around, ids, seq, packed, done)], names=["key", "around", "_id", "_seq", "packed", "done"])

    return run


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of anchors with one lead: rows of equal surroundings but the first are repeats; the first ones stay open if the
    lead has several surroundings."""
    for table in key_runs(batches, ["key"], SETTLED):
        key, around, ids, seq, packed = (table[c].to_numpy() for c in ("key", "around", "_id", "_seq", "packed"))
        done = table["done"].to_numpy(zero_copy_only=False)
        known = np.flatnonzero(done)
        rest = np.flatnonzero(~done)
        order, new = firsts(key[rest], around[rest], ids[rest], seq[rest], packed[rest])
        order = rest[order]
        again = order[~new]
        lead = order[new]
        same = key[lead][1:] == key[lead][:-1]
        open_ = lead[np.append(same, False) | np.append(False, same)] if len(lead) else lead
        row = np.concatenate([known, again, open_])
        yield pa.RecordBatch.from_arrays([
            pa.array(ids[row]), pa.array(seq[row]), pa.array(packed[row]),
            pa.array(np.append(np.zeros(len(row) - len(open_), np.int64), key[open_]), mask=np.arange(len(row)) < len(row) - len(open_)),
        ], names=["_id", "_seq", "packed", "key"])


def _surroundings(length: int):
    """Bytes around the open anchors of each document: ``(lead, key, id, seq, packed, bytes)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_blocks(first_copies(batches), "_text"):
            flat, offsets = text_bytes(batch.column("_text"))
            lists = batch.column("items")
            ends = lists.offsets.to_numpy()
            doc = np.repeat(np.arange(len(lists)), np.diff(ends))
            items = lists.flatten()
            use = np.flatnonzero(items.field("key").is_valid().to_numpy(zero_copy_only=False))
            doc, packed = doc[use], items.field("packed").to_numpy()[use]
            key = items.field("key").fill_null(0).to_numpy()[use]
            start, relative, strings = unpack(packed)
            start = start + offsets[doc]
            sizes = strings + length - 1
            around = np.append(0, np.cumsum(sizes)).astype(np.int32)
            data = flat[ranges(start, sizes)]
            head = flat[ranges(start + relative, np.full(len(start), 8))]
            yield pa.RecordBatch.from_arrays([
                pa.Array.from_buffers(pa.binary(), len(start), [None, pa.py_buffer(np.arange(0, 8 * len(start) + 1, 8, dtype=np.int32)), pa.py_buffer(head.tobytes())]),
                pa.array(key), pa.array(batch.column("_id").to_numpy()[doc]), pa.array(batch.column("_seq").to_numpy()[doc]), pa.array(packed),
                pa.Array.from_buffers(pa.binary(), len(start), [None, pa.py_buffer(around), pa.py_buffer(data.tobytes())]),
            ], names=["lead", "key", "_id", "_seq", "packed", "around"])

    return run


def multikey_groups(flat: np.ndarray, start: np.ndarray, group: np.ndarray, length: int) -> np.ndarray:
    """Numbers of the classes of equal strings ``flat[start[i]:start[i] + length]`` inside each group; -1 if alone.

    A multikey quicksort that compares eight bytes at a time: rows are sorted by the next word within their class, a
    class falls into the classes of equal words, and only rows that still have an equal go on to the next word.
    """
    padded = np.append(flat, np.zeros(8, np.uint8))
    words = np.lib.stride_tricks.sliding_window_view(padded, 8)
    row = np.arange(len(start))
    number = group.astype(np.int64)
    for depth in (*range(0, length - 7, 8), *([length - 8] if length % 8 else [])):
        word = words[start[row] + depth].copy().view(">u8").ravel()
        order = np.lexsort((word, number))
        row, number, word = row[order], number[order], word[order]
        new = np.append(True, (number[1:] != number[:-1]) | (word[1:] != word[:-1])) if len(row) else np.zeros(0, bool)
        number = np.cumsum(new)
        sizes = np.bincount(number)[number] if len(row) else number
        row, number = row[sizes > 1], number[sizes > 1]
    out = np.full(len(start), -1, np.int64)
    out[row] = number
    return out


def _compare(length: int):
    """Repeats among open anchors: ``(id, seq, start, size)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in key_runs(batches, ["lead", "key"], COMPARED):
            flat, offsets = text_bytes(table["around"].combine_chunks())
            ids, seq = table["_id"].to_numpy(), table["_seq"].to_numpy()
            start, relative, strings = unpack(table["packed"].to_numpy())
            _, lead = np.unique(table["key"].to_numpy(), return_inverse=True)
            row = np.repeat(np.arange(len(ids)), strings)
            step = ranges(np.zeros(len(ids), np.int64), strings)
            classes = multikey_groups(flat, offsets[row] + step, lead[row] << 8 | (relative[row] - step + 128), length)
            place = start[row] + step
            order = np.lexsort((place, seq[row], ids[row], classes))
            later = np.append(False, classes[order][1:] == classes[order][:-1]) & (classes[order] >= 0)
            hit = np.sort(order[later])
            if not len(hit):
                continue
            # Neighbouring strings of an anchor are one span.
            new = np.append(True, (np.diff(hit) != 1) | (row[hit][1:] != row[hit][:-1]))
            first = np.flatnonzero(new)
            count = np.diff(np.append(first, len(hit)))
            head = hit[first]
            yield pa.RecordBatch.from_arrays([
                pa.array(ids[row[head]]), pa.array(seq[row[head]]), pa.array(place[head]), pa.array(count + length - 1),
            ], names=["_id", "_seq", "start", "size"])

    return run


def _cut_out(length: int, as_text: bool):
    """Texts without their repeats."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_blocks(batches, "_text"):
            flat, offsets = text_bytes(batch.column("_text"))
            change = np.zeros(len(flat) + 1, np.int32)
            # A copy of a text with the same id is a repeat from end to end.
            again = batch.column("_copy").to_numpy() > 1
            whole = again & (np.diff(offsets) >= length)
            np.add.at(change, offsets[:-1][whole], 1)
            np.add.at(change, offsets[1:][whole], -1)
            for name in ("items", "spans"):
                lists = batch.column(name)
                doc = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy())) if lists.null_count == 0 else np.repeat(
                    np.arange(len(lists)), [len(x) if x.is_valid else 0 for x in lists])
                rows = lists.flatten()
                use = ~again[doc]
                if name == "items":
                    use &= ~rows.field("key").is_valid().to_numpy(zero_copy_only=False)
                    start, _, strings = unpack(rows.field("packed").to_numpy())
                    size = strings + length - 1
                else:
                    start, size = rows.field("start").to_numpy(), rows.field("size").to_numpy()
                begin = offsets[doc[use]] + start[use]
                np.add.at(change, begin, 1)
                np.add.at(change, begin + size[use], -1)
            gone = np.cumsum(change[:-1]) > 0
            total = np.append(0, np.cumsum(gone))
            removed = total[offsets[1:]] - total[offsets[:-1]]
            rises = gone & ~np.append(False, gone[:-1])
            heads = offsets[:-1][np.diff(offsets) > 0]
            rises[heads] = gone[heads]
            falls = gone & ~np.append(gone[1:], False)
            falls[offsets[1:][np.diff(offsets) > 0] - 1] = gone[offsets[1:][np.diff(offsets) > 0] - 1]
            begin, end = np.flatnonzero(rises), np.flatnonzero(falls) + 1
            at = np.searchsorted(begin, offsets)
            base = np.repeat(offsets[:-1], np.diff(at))
            spans = pa.StructArray.from_arrays([pa.array(begin - base), pa.array(end - base)], names=["start", "end"])
            kept = flat[~gone]
            kept_at = offsets - total[offsets]
            left = pa.Array.from_buffers(pa.binary(), batch.num_rows, [None, pa.py_buffer(kept_at.astype(np.int32)), pa.py_buffer(kept.tobytes())])
            if as_text:
                left = pa.array([x.decode("utf-8", "ignore") for x in left.to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([
                batch.column("_id"), batch.column("_carry"), pa.array(np.diff(offsets)), pa.array(removed),
                pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), spans), left,
            ], names=["_id", "_carry", "n_bytes", "n_removed", "removed", "kept"])

    return run


def hot_leads(texts: DataFrame, length: int, lead: int) -> np.ndarray:
    """Hashes of leads expected to have very many rows, at most ``1 / HOT_SHARE`` of them, sorted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_blocks(batches, "_text"):
            hashes, at, _, _ = anchors(*text_bytes(batch.column("_text")), length, lead)
            key, n = np.unique(hashes.of(at, lead).view(np.int64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(n)], names=["key", "n"])

    sample = texts.where(F.pmod(F.xxhash64("_id"), F.lit(HOT_SAMPLE)) == 0).select("_text")
    counts = sample.mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    counts = counts.where(F.col("n") > HOT_ROWS / HOT_SAMPLE)
    total = counts.agg(F.sum("n")).first()[0] or 0
    return np.array(sorted(r["key"] for r in counts.where(F.col("n") > total * HOT_SHARE).collect()), np.int64)


def remove_repeats(
    docs: DataFrame, length: int = LENGTH, lead: int = LEAD, text: str = "text", id_column: str = "doc_id",
    carry: tuple[str, ...] = (), as_text: bool = False,
) -> DataFrame:
    """Every document without the bytes of strings of ``length`` bytes that start earlier in the table.

    Returns ``doc_id``, ``carry``, ``n_bytes``, ``n_removed``, ``removed`` (maximal removed runs as byte offsets) and
    ``kept``: the remaining bytes, or with ``as_text`` the text they hold without characters cut in two. Overlapping occurrences count, and all are
    judged on the input. Null texts are empty. A null id sorts first; rows of equal id are separate documents in a fixed
    order of their own (that of a hash of their texts), so of two equal rows the second is a repeat. Texts shorter than
    ``length`` stay. A lead or string counts as known by two independent 64-bit hashes.
    """
    base = docs.select(
        F.coalesce(F.col(id_column).cast("long"), F.lit(NULL_ID)).alias("_id"), text_of(docs, text).alias("_text"),
        F.struct(*carry, F.lit(0).alias("_")).alias("_carry"))
    hot = hot_leads(base, length, lead)
    # Rows of one id are told apart by the hash of their texts, and numbered among equal ones only.
    row = ["_id", "_seq"]
    texts = base.withColumn("_seq", F.xxhash64("_text")).withColumn("_copy", F.row_number().over(Window.partitionBy(*row).orderBy(F.lit(0))))
    # All that follows takes all columns of ``texts``, so that the texts are shuffled once and that shuffle is reused.
    texts = texts.select(*row, "_copy", "_text", "_carry")
    found = texts.mapInArrow(_anchor_rows(hot, length, lead), "key long, around long, _id long, _seq long, packed long, done boolean")
    found = found.repartition("key").sortWithinPartitions("key")
    items = found.mapInArrow(_settle, "_id long, _seq long, packed long, key long")
    items = items.groupBy(*row).agg(F.collect_list(F.struct("packed", "key")).alias("items"))
    open_ = texts.join(items, row).select(*texts.columns, "items").mapInArrow(
        _surroundings(length), "lead binary, key long, _id long, _seq long, packed long, around binary")
    open_ = open_.repartitionByRange("lead", "key").sortWithinPartitions("lead", "key")
    spans = open_.mapInArrow(_compare(length), "_id long, _seq long, start long, size long")
    spans = spans.groupBy(*row).agg(F.collect_list(F.struct("start", "size")).alias("spans"))
    joined = texts.join(items, row, "left").join(spans, row, "left")
    empty = lambda c, kind: F.coalesce(c, F.array().cast(kind)).alias(c)
    joined = joined.select(
        *texts.columns, empty("items", "array<struct<packed:bigint,key:bigint>>"), empty("spans", "array<struct<start:bigint,size:bigint>>"))
    made = T.StructType.fromDDL(f"n_bytes long, n_removed long, removed array<struct<start:long,end:long>>, kept {'string' if as_text else 'binary'}")
    out = joined.mapInArrow(_cut_out(length, as_text), T.StructType([*texts.select("_id", "_carry").schema, *made]))
    return out.select(
        F.when(F.col("_id") != NULL_ID, F.col("_id")).alias("doc_id"), *[F.col("_carry")[c].alias(c) for c in carry],
        "n_bytes", "n_removed", "removed", "kept")
