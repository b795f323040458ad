"""Byte-pair encoding and decoding with a public vocabulary file, by batched merge rounds in numpy.

The words of many documents lie in one flat array of symbols. A round looks up the rank of every adjacent pair by
binary search over the sorted pair keys, takes the lowest rank of each word, merges all its places from the left
and drops the words that have no pair left. A word is encoded once per task while it stays in the word table.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import ranges, text_blocks

#: Words kept by a task before its table is started anew.
WORD_TABLE = 400_000

COLUMNS = {
    "n_tokens": "long", "ids": "array<int>", "decoded": "string", "ids_sha256": "string", "decoded_sha256": "string",
}


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte: itself if printable, else the next from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(256))
    return [chr(b) if b in plain else chr(256 + next(rest)) for b in range(256)]


class Merges:
    """A vocabulary with word ends, its merges as sorted pair keys, and its special tokens."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab, end = model["vocab"], model["end_of_word_suffix"] or ""
        letters = byte_letters()
        self.inner = np.array([vocab[c] for c in letters], np.int64)
        self.last = np.array([vocab[c + end] for c in letters], np.int64)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names = {i: t for t, i in vocab.items()} | {i: t for t, i in self.special.items()}
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        left, right = (np.array([vocab[p[i]] for p in pairs], np.int64) for i in (0, 1))
        merged = np.array([vocab["".join(p)] for p in pairs], np.int64)
        keys = left << 32 | right
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank, self.merged = keys[order], order.astype(np.int64), merged
        split = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pieces = regex.compile(split.replace(r"\s", r"\p{White_Space}"))
        self.marks = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) or r"(?!)")

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in one array, and the offsets of the words."""
        sizes = np.array([len(w) for w in words], np.int64)
        ends = np.cumsum(sizes)
        raw = np.frombuffer(b"".join(words), np.uint8)
        symbols = self.inner[raw]
        symbols[ends - 1] = self.last[raw[ends - 1]]
        word = np.repeat(np.arange(len(words)), sizes)
        done_word, done_symbols = [], []
        none = len(self.keys)
        while len(symbols):
            keys = symbols[:-1] << 32 | symbols[1:]
            at = np.minimum(np.searchsorted(self.keys, keys), none - 1)
            rank = np.where((self.keys[at] == keys) & (word[:-1] == word[1:]), self.rank[at], none)
            rank = np.append(rank, none)
            starts = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            lengths = np.diff(np.append(starts, len(word)))
            lowest = np.minimum.reduceat(rank, starts)
            open_ = np.repeat(lowest < none, lengths)
            done_word.append(word[~open_])
            done_symbols.append(symbols[~open_])
            hit = open_ & (rank == np.repeat(lowest, lengths))
            symbols, word, rank, hit = symbols[open_], word[open_], rank[open_], hit[open_]
            places = np.flatnonzero(hit)
            if len(places):
                # Of overlapping places, as in a run of one letter, every second one from the left is merged.
                fresh = np.append(True, np.diff(places) > 1)
                run = np.maximum.accumulate(np.where(fresh, np.arange(len(places)), 0))
                places = places[(np.arange(len(places)) - run) % 2 == 0]
                symbols[places] = self.merged[rank[places]]
                keep = np.ones(len(symbols), bool)
                keep[places + 1] = False
                symbols, word = symbols[keep], word[keep]
        word, symbols = np.concatenate(done_word), np.concatenate(done_symbols)
        order = np.argsort(word, kind="stable")
        return symbols[order], np.append(0, np.cumsum(np.bincount(word, minlength=len(words))))


@lru_cache(maxsize=2)
def merges(path: str) -> Merges:
    return Merges(path)


class WordTable(dict):
    """Numbers of words as they come up; their ids and decoded forms are added in batches."""

    def __init__(self, model: Merges):
        super().__init__()
        self.model, self.fresh, self.decoded = model, [], []
        self.ids, self.offsets = np.zeros(0, np.int64), np.zeros(1, np.int64)
        for name in model.special:
            self["special", name]  # noqa: B018

    def __missing__(self, word) -> int:
        self[word] = number = len(self)
        self.fresh.append(word)
        return number

    def settle(self) -> None:
        """Encode the words that are new."""
        if not self.fresh:
            return
        model = self.model
        plain = [w.encode("utf-8", "surrogatepass") for w in self.fresh if isinstance(w, str)]
        ids, offsets = model.encode_words(plain) if plain else (np.zeros(0, np.int64), np.zeros(1, np.int64))
        marks = [model.special[w[1]] for w in self.fresh if isinstance(w, tuple)]
        ids = np.concatenate([np.array(marks, np.int64), ids])
        offsets = np.concatenate([np.arange(len(marks)), offsets + len(marks)])
        names = list(map(model.names.__getitem__, ids.tolist()))
        bounds = offsets.tolist()
        self.decoded += [" ".join(names[a:b]) for a, b in zip(bounds, bounds[1:])]
        self.offsets = np.concatenate([self.offsets, self.offsets[-1] + offsets[1:]])
        self.ids = np.concatenate([self.ids, ids])
        self.fresh = []


def lower_each(text: str) -> str:
    """Lower case letter by letter; a final sigma is no special case."""
    return text.replace("Σ", "σ").lower()


def words_of(model: Merges, text: str) -> list:
    """The pieces of a text that are encoded by themselves; special tokens as ``("special", name)``."""
    out, start = [], 0
    for m in model.marks.finditer(text):
        out += model.pieces.findall(lower_each(unicodedata.normalize("NFC", text[start : m.start()])))
        out.append(("special", m[0]))
        start = m.end()
    return out + model.pieces.findall(lower_each(unicodedata.normalize("NFC", text[start:])))


def encode(docs: DataFrame, path: str, outputs: tuple[str, ...] = ("n_tokens", "ids", "decoded"), text: str = "text") -> DataFrame:
    """Encode and decode every text with the vocabulary file at ``path`` (readable on every worker).

    Keeps all other columns and adds ``outputs``: ``n_tokens``, ``ids``, ``decoded`` (the tokens' strings with
    spaces between, as a vocabulary without decoder gives them), and SHA-256 digests of the ids as little-endian
    32-bit numbers and of the decoded text. Null and empty texts have no tokens. Strings of special tokens in a
    text are those tokens. Every row is worked on by itself, so repeated rows give repeated results; columns of
    the same names are replaced.
    """
    keep = [c for c in docs.columns if c != text and c not in outputs]
    source = docs.select(*keep, text)
    made = T.StructType.fromDDL(", ".join(f"{name} {COLUMNS[name]}" for name in outputs))
    schema = T.StructType([*docs.select(*keep).schema, *made])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = merges(path)
        table = WordTable(model)
        for batch in text_blocks(batches, text):
            if len(table) > WORD_TABLE:
                table = WordTable(model)
            numbers, counts = [], []
            for t in batch.column(text).to_pylist():
                found = list(map(table.__getitem__, words_of(model, t or "")))
                numbers += found
                counts.append(len(found))
            table.settle()
            numbers_at = np.append(0, np.cumsum(counts))
            chosen = np.array(numbers, np.int64)
            sizes = table.offsets[chosen + 1] - table.offsets[chosen]
            ids = table.ids[ranges(table.offsets[chosen], sizes)]
            at = np.append(0, np.cumsum(sizes))[numbers_at]
            made: dict = {}
            if "n_tokens" in outputs:
                made["n_tokens"] = pa.array(np.diff(at))
            if "ids" in outputs:
                made["ids"] = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids.astype(np.int32)))
            if "ids_sha256" in outputs:
                raw = memoryview(ids.astype("<u4").tobytes())
                made["ids_sha256"] = [hashlib.sha256(raw[4 * a : 4 * b]).hexdigest() for a, b in zip(at.tolist(), at[1:].tolist())]
            if {"decoded", "decoded_sha256"} & set(outputs):
                strings = table.decoded
                texts = [" ".join(map(strings.__getitem__, numbers[a:b])) for a, b in zip(numbers_at.tolist(), numbers_at[1:].tolist())]
                if "decoded" in outputs:
                    made["decoded"] = texts
                if "decoded_sha256" in outputs:
                    made["decoded_sha256"] = [hashlib.sha256(t.encode()).hexdigest() for t in texts]
            columns = [batch.column(c) for c in keep] + [made[c] for c in outputs]
            yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names=[*keep, *outputs])

    return source.mapInArrow(run, schema)

