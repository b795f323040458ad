"""SentencePiece encoding and decoding with a public model file, by a table of distinct chunks.

A text is marked as the model asks (a marker before it and for every space) and cut before each marker that follows
another character. Where no piece has a marker after another character, no merge crosses such a cut, so each distinct
chunk is segmented once per task while it stays in the table, and the ids of a text are those of its chunks, joined by
position. Chunks are segmented together: their symbols lie in one flat array, a round merges the best pair of every
chunk (highest score, leftmost of equals), and pairs are found by binary search over the sorted pair keys. Chunks are
cut further between characters that stand side by side in no piece. What is then still long is merged with a heap.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import struct
from collections.abc import Iterator
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import ranges, text_blocks

#: The marker that stands for a space.
MARK = "▁"

#: Chunks of a marked text: markers, then other characters.
CHUNKS = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")

#: Where a chunk ends and another begins.
BORDER = re.compile(f"[^{MARK}](?={MARK})")

#: Chunks and characters kept by a task before its table is started anew.
TABLE_CHUNKS, TABLE_CHARACTERS = 300_000, 20_000_000

#: Characters of a text that are cut into chunks in one go, and chunks whose ids are joined in one go.
WINDOW, JOINED = 1 << 20, 400_000

#: Symbols of a chunk from which on a heap is used.
LONG = 64

COLUMNS = {
    "n_tokens": "long", "ids": "array<int>", "decoded": "string", "ids_sha256": "string", "decoded_sha256": "string",
}

#: Fixed values of the model file's format: kinds of pieces, and the kind of model that merges pairs.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
BPE = 2


def message(data: bytes) -> Iterator[tuple[int, int | float | bytes]]:
    """Field numbers and values of one protocol-buffer message."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        tag = number()
        kind = tag & 7
        if kind == 0:
            value = number()
        elif kind == 5:
            value = struct.unpack_from("<f", data, at)[0]
            at += 4
        else:
            size = number() if kind == 2 else 8
            value = data[at : at + size]
            at += size
        yield tag >> 3, value


class Pieces:
    """A pair-merging model: its pieces, their ids and its merges as sorted pair keys.

    Symbols are ids of pieces; a character that is no piece is ``size`` plus its code point.
    """

    def __init__(self, path: str):
        with open(path, "rb") as f:
            parts = list(message(f.read()))
        found = [dict(message(v)) for k, v in parts if k == 1]
        trainer, normalizer = (dict(message(next(v for k, v in parts if k == n))) for n in (2, 3))
        self.size = len(found)
        self.names = [p[1].decode() for p in found]
        self.kinds = np.array([p.get(3, NORMAL) for p in found])
        scores = np.array([p.get(2, 0.0) for p in found])
        if trainer.get(3) != BPE or not trainer.get(35) or normalizer.get(2) or normalizer.get(4, 1) or set(self.kinds) & {USER_DEFINED, UNUSED}:
            raise ValueError("only models that merge pairs, fall back to bytes and leave texts as they are can be used")
        self.prefix = MARK if normalizer.get(3, 1) else ""
        self.begin, self.end = trainer.get(41, 1), trainer.get(42, 2)
        ids = {name: i for i, name in enumerate(self.names) if self.kinds[i] == NORMAL}
        if any(MARK in name.lstrip(MARK) for name in ids):
            raise ValueError("a piece crosses a whitespace marker, so texts cannot be cut there")
        self.bytes = np.zeros(256, np.int64)
        for i in np.flatnonzero(self.kinds == BYTE).tolist():
            self.bytes[int(self.names[i][1:-1], 16)] = i

        def symbol(part: str) -> int | None:
            return ids.get(part, self.size + ord(part) if len(part) == 1 else None)

        pairs, beside = {}, set()
        for name, i in ids.items():
            for k in range(1, len(name)):
                left, right = symbol(name[:k]), symbol(name[k:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = i
                beside.add(symbol(name[k - 1]) << 32 | symbol(name[k]))
        keys = np.array(list(pairs), np.int64)
        merged = np.array(list(pairs.values()), np.int64)
        order = np.argsort(keys)
        self.keys, self.merged = keys[order], merged[order]
        self.rank = np.unique(-scores[self.merged], return_inverse=True)[1].astype(np.int64)
        self.beside = np.sort(np.array(list(beside), np.int64))
        letters = {ord(name): i for name, i in ids.items() if len(name) == 1}
        self.letters = np.array(sorted(letters), np.int64)
        self.letter_ids = np.array([letters[c] for c in self.letters.tolist()], np.int64)

    @cached_property
    def table(self) -> dict[int, tuple[int, int]]:
        """Rank and piece by pair key, for chunks that are merged one by one."""
        return dict(zip(self.keys.tolist(), zip(self.rank.tolist(), self.merged.tolist())))

    def symbols(self, text: str) -> np.ndarray:
        code = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64)
        at = np.minimum(np.searchsorted(self.letters, code), len(self.letters) - 1)
        return np.where(self.letters[at] == code, self.letter_ids[at], self.size + code)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair; the number of pairs where it is none."""
        keys = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.rank[at], len(self.keys))

    def merge_long(self, symbols: list[int]) -> list[int]:
        """Merge one long chunk pair by pair."""
        table, n = self.table, len(symbols)
        symbols = symbols + [-1]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap: list[tuple[int, int, int, int]] = []

        def offer(i: int) -> None:
            if i >= 0 and after[i] < n:
                entry = table.get(symbols[i] << 32 | symbols[after[i]])
                if entry:
                    heapq.heappush(heap, (entry[0], i, symbols[i], symbols[after[i]]))

        for i in range(n - 1):
            offer(i)
        while heap:
            _, i, left, right = heapq.heappop(heap)
            j = after[i]
            if symbols[i] != left or j >= n or symbols[j] != right:
                continue
            symbols[i], symbols[j] = table[left << 32 | right][1], -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            offer(before[i])
            offer(i)
        return [s for s in symbols if s >= 0]

    def segment(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all chunks in one array, and the offsets of the chunks."""
        symbols = self.symbols("".join(chunks))
        sizes = np.array([len(c) for c in chunks], np.int64)
        chunk = np.repeat(np.arange(len(chunks)), sizes)
        keys = symbols[:-1] << 32 | symbols[1:]
        at = np.minimum(np.searchsorted(self.beside, keys), len(self.beside) - 1)
        cut = np.append(True, (self.beside[at] != keys) | (chunk[:-1] != chunk[1:]))[: len(symbols)]
        starts = np.flatnonzero(cut)
        lengths = np.diff(np.append(starts, len(symbols)))
        part = np.repeat(np.arange(len(starts)), lengths)
        done_part, done_symbols = [], []
        for i in np.flatnonzero(lengths > LONG).tolist():
            found = self.merge_long(symbols[starts[i] : starts[i] + lengths[i]].tolist())
            done_part.append(np.full(len(found), i))
            done_symbols.append(np.array(found, np.int64))
        short = np.repeat(lengths <= LONG, lengths)
        owner, symbols, part = chunk[starts], symbols[short], part[short]
        none = len(self.keys)
        rank = np.full(len(symbols), none)
        if len(symbols):
            rank[:-1] = np.where(part[:-1] == part[1:], self.ranks(symbols[:-1], symbols[1:]), none)
        while len(symbols):
            starts = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
            lengths = np.diff(np.append(starts, len(part)))
            best = np.minimum.reduceat(rank * len(rank) + np.arange(len(rank)), starts)
            open_ = best // len(rank) < none
            places = best[open_] % len(rank)
            left, right = symbols[places], symbols[places + 1]
            symbols[places] = self.merged[np.searchsorted(self.keys, left << 32 | right)]
            keep = np.repeat(open_, lengths)
            done_part.append(part[~keep])
            done_symbols.append(symbols[~keep])
            keep[places + 1] = False
            places = (np.cumsum(keep) - 1)[places]
            symbols, part, rank = symbols[keep], part[keep], rank[keep]
            if not len(symbols):
                break
            changed = np.concatenate([places, places[places > 0] - 1])
            inside = changed[changed < len(symbols) - 1]
            inside = inside[part[inside] == part[inside + 1]]
            rank[changed] = none
            rank[inside] = self.ranks(symbols[inside], symbols[inside + 1])
        part, symbols = np.concatenate(done_part), np.concatenate(done_symbols)
        order = np.argsort(part, kind="stable")
        return self.with_bytes(symbols[order], owner[part[order]], len(chunks))

    def with_bytes(self, symbols: np.ndarray, chunk: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Replace characters without a piece by the ids of their bytes."""
        other = np.flatnonzero(symbols >= self.size)
        if len(other):
            raw = [chr(c).encode() for c in (symbols[other] - self.size).tolist()]
            times = np.ones(len(symbols), np.int64)
            times[other] = [len(b) for b in raw]
            plain = np.repeat(symbols < self.size, times)
            symbols, chunk = np.repeat(symbols, times), np.repeat(chunk, times)
            symbols[~plain] = self.bytes[np.frombuffer(b"".join(raw), np.uint8)]
        return symbols, np.append(0, np.cumsum(np.bincount(chunk, minlength=n)))

    def decode(self, ids: list[int]) -> str:
        """Text of ids that do not begin a text: control pieces are nothing, bytes are put together."""
        if not any(map(self.special.__contains__, ids)):
            return "".join(map(self.names.__getitem__, ids)).replace(MARK, " ")
        out, raw = [], bytearray()
        for i in [*ids, -1]:
            if i >= 0 and self.kinds[i] == BYTE:
                raw.append(int(self.names[i][1:-1], 16))
                continue
            if raw:
                out.append(raw.decode("utf-8", "replace"))
                raw.clear()
            if i >= 0 and self.kinds[i] == NORMAL:
                out.append(self.names[i].replace(MARK, " "))
        return "".join(out)

    @cached_property
    def special(self) -> frozenset[int]:
        return frozenset(np.flatnonzero(self.kinds != NORMAL).tolist())


@lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    return Pieces(path)


class ChunkTable(dict):
    """Numbers of chunks as they come up; their ids and decoded forms are added in batches."""

    def __init__(self, model: Pieces):
        super().__init__()
        self.model, self.fresh, self.decoded, self.characters = model, [], [], 0
        self.ids, self.offsets = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def __missing__(self, chunk: str) -> int:
        self[chunk] = number = len(self)
        self.fresh.append(chunk)
        return number

    def settle(self) -> None:
        """Segment the chunks that are new."""
        if not self.fresh:
            return
        ids, offsets = self.model.segment(self.fresh)
        flat, bounds = ids.tolist(), offsets.tolist()
        self.decoded += [self.model.decode(flat[a:b]) for a, b in zip(bounds, bounds[1:])]
        self.offsets = np.concatenate([self.offsets, self.offsets[-1] + offsets[1:]])
        self.ids = np.concatenate([self.ids, ids.astype(np.int32)])
        self.characters += sum(map(len, self.fresh))
        self.fresh = []

    @property
    def full(self) -> bool:
        return len(self) > TABLE_CHUNKS or self.characters > TABLE_CHARACTERS


def chunks_of(model: Pieces, text: str) -> Iterator[list[str]]:
    """Chunks of a whole text, a window of it at a time; windows end where chunks do."""
    if not text:
        return
    marked = model.prefix + text.replace(" ", MARK)
    start = 0
    while start < len(marked):
        found = BORDER.search(marked, start + WINDOW - 1)
        end = found.end() if found else len(marked)
        yield CHUNKS.findall(marked, start, end)
        start = end


class Encoder:
    """Texts of one task, its chunk table and the ids and decoded strings of the texts in hand."""

    def __init__(self, model: Pieces):
        self.model, self.table = model, ChunkTable(model)

    def encode(self, texts: list[str | None]) -> tuple[list[list[np.ndarray]], list[list[str]]]:
        """For each text the parts of its ids and of its decoded form."""
        ids: list[list[np.ndarray]] = [[] for _ in texts]
        decoded: list[list[str]] = [[] for _ in texts]
        held: list[tuple[int, list[int]]] = []
        size = 0

        def join() -> None:
            table = self.table
            table.settle()
            numbers = np.fromiter((n for _, part in held for n in part), np.int64, size)
            lengths = table.offsets[numbers + 1] - table.offsets[numbers]
            flat = table.ids[ranges(table.offsets[numbers], lengths)]
            ends = np.append(0, np.cumsum(lengths))
            at = 0
            for row, part in held:
                ids[row].append(flat[ends[at] : ends[at + len(part)]])
                decoded[row].append("".join(map(table.decoded.__getitem__, part)))
                at += len(part)
            if table.full:
                self.table = ChunkTable(self.model)

        for row, text in enumerate(texts):
            for chunks in chunks_of(self.model, text or ""):
                part = list(map(self.table.__getitem__, chunks))
                held.append((row, part))
                size += len(part)
                if size >= JOINED:
                    join()
                    held, size = [], 0
        if held:
            join()
        for parts in decoded:
            if parts and self.model.prefix:
                parts[0] = parts[0].removeprefix(" ")
        return ids, decoded


def encode(docs: DataFrame, path: str, outputs: tuple[str, ...] = ("n_tokens", "ids", "decoded"), text: str = "text",
           begin: bool = True, end: bool = True) -> DataFrame:
    """Encode and decode every text with the model file at ``path`` (readable on every worker).

    Keeps all other columns and adds ``outputs``: ``n_tokens``, ``ids`` (with begin and end ids unless switched off),
    ``decoded``, and SHA-256 digests of the ids as little-endian 32-bit numbers and of the decoded text. Null and empty
    texts have begin and end ids only. Every row is worked on by itself, so repeated rows give repeated results;
    columns of the same names are replaced. A text is cut a window at a time; only a stretch that the model could make
    one piece after another of, without a cut, is segmented as a whole.
    """
    keep = [c for c in docs.columns if c.lower() not in {text.lower(), *outputs}]
    source = docs.select(*keep, text)
    made = T.StructType.fromDDL(", ".join(f"{name} {COLUMNS[name]}" for name in outputs))
    schema = T.StructType([*docs.select(*keep).schema, *made])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(path)
        encoder = Encoder(model)
        first, last = (np.array([i] if wanted else [], np.int32) for i, wanted in ((model.begin, begin), (model.end, end)))
        for batch in text_blocks(batches, text):
            ids, decoded = encoder.encode(batch.column(text).to_pylist())
            ids = [np.concatenate([first, *parts, last]).astype("<i4") for parts in ids]
            columns: dict = {}
            if "n_tokens" in outputs:
                columns["n_tokens"] = [len(x) for x in ids]
            if "ids" in outputs:
                columns["ids"] = pa.array(ids, pa.list_(pa.int32()))
            if "ids_sha256" in outputs:
                columns["ids_sha256"] = [hashlib.sha256(x).hexdigest() for x in ids]
            if "decoded" in outputs:
                columns["decoded"] = ["".join(parts) for parts in decoded]
            if "decoded_sha256" in outputs:
                columns["decoded_sha256"] = [hashlib.sha256("".join(parts).encode()).hexdigest() for parts in decoded]
            found = [batch.column(c) for c in keep] + [columns[c] for c in outputs]
            yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in found], names=[*keep, *outputs])

    return source.mapInArrow(run, schema)
