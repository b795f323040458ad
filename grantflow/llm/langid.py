"""Language identification: averaged embeddings of hashed subwords and a linear softmax, with calibrated rejection.

A subword is a run of three, four or five bytes of the lower-cased text, in which everything but letters is one
space. Every subword hashes to a row of the embedding table; a text is the average of its rows, and a linear layer
with softmax names the language. Embeddings and layer are trained together by stochastic gradient descent in numpy.
Held-back training pieces then fix a temperature, so that scores are probabilities, and the score below which a text
is rejected.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ranges, sums, text_blocks

#: Label of a text that has no letter.
UNDETERMINED = "und"

#: Bytes per subword.
ORDERS = (3, 4, 5)

#: Rows of the embedding table (a power of two) and its width.
BUCKETS, WIDTH = 1 << 16, 12

#: Bound of the training sample: documents per language, and pieces cut from each.
SAMPLE_DOCS, SAMPLE_PIECES = 800, 5

#: Fewest gradient steps; a small sample is gone through more often.
LEAST_STEPS = 500

#: Lengths of training pieces in characters.
PIECE_CHARS = (24, 48, 96, 192, 384)


class Model(NamedTuple):
    """``table[b]`` holds what a subword in bucket ``b`` adds to the logits, embeddings and layer folded together."""

    langs: list[str]
    table: np.ndarray
    bias: np.ndarray
    temperature: float
    reject_below: float


def normal(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased bytes with one space for every run of ASCII characters that are no letters, and the places of the
    spaces around the texts: text ``i`` lies between the spaces at ``bounds[i]`` and ``bounds[i + 1]``."""
    raw = [(t or "").lower().encode("utf-8", "replace") for t in texts]
    flat = np.frombuffer(b" ".join([b"", *raw, b""]), np.uint8).copy()
    bounds = np.append(0, np.cumsum([len(r) + 1 for r in raw], dtype=np.int64))
    flat[(flat < 0x80) & ((flat < ord("a")) | (flat > ord("z")))] = 0x20
    keep = np.append(True, (flat[1:] != 0x20) | (flat[:-1] != 0x20))
    return flat[keep], (np.cumsum(keep) - 1)[bounds]


def subwords(texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each length of ``ORDERS``, the buckets of the subwords of all texts and the offsets of the texts."""
    flat, bounds = normal(texts)
    ends = np.repeat(bounds[1:], np.diff(bounds))
    index = np.arange(len(ends))
    code = flat.astype(np.uint64)
    body, found = code, []
    for k in range(1, max(ORDERS)):
        code = code[:-1] << np.uint64(8) | body[k:]
        if k + 1 in ORDERS:
            good = np.flatnonzero(index[: len(code)] + k <= ends[: len(code)])
            hashed = (code[good] + np.uint64(k)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(65 - BUCKETS.bit_length())
            found.append((hashed.astype(np.int32), np.searchsorted(good, bounds)))
    return found


def joined(texts: list[str | None], at_once: int = 1000) -> tuple[np.ndarray, np.ndarray]:
    """Subwords of all lengths of each text, one text after the other, and the offsets of the texts."""
    found, sizes = [], []
    for i in range(0, len(texts), at_once):
        part = texts[i : i + at_once]
        parts = subwords(part)
        owner = np.concatenate([np.repeat(np.arange(len(part)), np.diff(at)) for _, at in parts])
        found.append(np.concatenate([b for b, _ in parts])[np.argsort(owner, kind="stable")])
        sizes.append(np.bincount(owner, minlength=len(part)))
    return np.concatenate(found), np.append(0, np.cumsum(np.concatenate(sizes)))


def train(pieces: list[str], labels: list[str], held: np.ndarray, *, epochs: int = 4, batch: int = 128, rate: float = 2.0, seed: int = 42) -> Model | None:
    """Fit on the pieces that are not ``held``, calibrate on those that are. None without labels."""
    langs = sorted(set(labels))
    if not langs:
        return None
    y = np.searchsorted(np.array(langs, object), np.array(labels, object))
    buckets, at = joined(pieces)
    rng = np.random.default_rng(seed)
    embed = rng.normal(0, 0.3, (BUCKETS, WIDTH)).astype(np.float32)
    layer, bias = np.zeros((WIDTH, len(langs)), np.float32), np.zeros(len(langs), np.float32)
    fit = np.flatnonzero((~held | (len(set(held.tolist())) == 1)) & (np.diff(at) > 0))
    epochs = max(epochs, -(-LEAST_STEPS // max(1, -(-len(fit) // batch)))) if len(fit) else 0
    steps, step = max(1, epochs * -(-len(fit) // batch)), 0
    for _ in range(epochs):
        rng.shuffle(fit)
        for i in range(0, len(fit), batch):
            rows = fit[i : i + batch]
            size = np.diff(at)[rows]
            chosen = buckets[ranges(at[rows], size)]
            mean = sums(embed[chosen], np.append(0, np.cumsum(size))) / size[:, None]
            logits = mean @ layer + bias
            p = np.exp(logits - logits.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(rows)), y[rows]] -= 1
            now = rate * (1 - step / steps)
            step += 1
            back = (p @ layer.T).astype(np.float32)
            layer -= now / len(rows) * (mean.T @ p).astype(np.float32)
            bias -= now / len(rows) * p.sum(0).astype(np.float32)
            np.add.at(embed, chosen, -now / len(rows) * np.repeat(back, size, axis=0))
    model = Model(langs, (embed @ layer).astype(np.float32), bias, 1.0, 0.0)
    check = np.flatnonzero(held & (np.diff(at) > 0)) if held.any() else np.sort(fit)
    size = np.diff(at)[check]
    totals = sums(model.table[buckets[ranges(at[check], size)]], np.append(0, np.cumsum(size)))
    return calibrate(model, totals / np.maximum(size, 1)[:, None] + bias, y[check])


def softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(1, keepdims=True))
    return x / x.sum(1, keepdims=True)


def calibrate(model: Model, logits: np.ndarray, y: np.ndarray, lost: float = 0.001) -> Model:
    """The temperature of least log loss on texts with known language, and the score under which at most ``lost`` of
    those it names rightly would be rejected (and never more than one half)."""
    if not len(y):
        return model
    grid = np.geomspace(0.05, 5, 60)
    losses = [-np.log(softmax(logits / t)[np.arange(len(y)), y] + 1e-12).mean() for t in grid]
    best = float(grid[int(np.argmin(losses))])
    p = softmax(logits / best)
    right = p.max(1)[p.argmax(1) == y]
    return model._replace(temperature=best, reject_below=min(0.5, float(np.quantile(right, lost)) if len(right) else 0.0))


def predict(model: Model | None, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Language, score and whether the text is accepted. Texts without a letter are undetermined and rejected."""
    letters = np.array([t is not None and any(map(str.isalpha, t)) for t in texts], bool)
    if model is None or not len(texts):
        return [UNDETERMINED] * len(texts), np.zeros(len(texts)), np.zeros(len(texts), bool)
    parts = subwords(texts)
    size = np.maximum(sum(np.diff(at) for _, at in parts), 1)[:, None]
    p = softmax((sum(sums(model.table[buckets], at) for buckets, at in parts) / size + model.bias) / model.temperature)
    best = p.argmax(1)
    score = np.where(letters, p.max(1), 0.0)
    langs = [model.langs[b] if ok else UNDETERMINED for b, ok in zip(best.tolist(), letters.tolist())]
    return langs, score, letters & (score >= model.reject_below)


def training_pieces(docs: DataFrame, learn: Column, per_lang: int = SAMPLE_DOCS, seed: int = 42) -> tuple[list[str], list[str], np.ndarray]:
    """At most about ``per_lang`` documents of each language for training, chosen by a hash of id and language.

    From each, up to ``SAMPLE_PIECES`` pieces at places spread over the whole text are cut in Spark; only they reach
    the driver. A fifth of the documents is held back for calibration.
    """
    known = docs.where(learn & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = known.groupBy("lang").count()
    key = F.pmod(F.xxhash64("doc_id", "lang", F.lit(seed)), F.lit(1 << 30))
    share = {r["lang"]: min(1.0, per_lang / r["count"]) for r in counts.collect()}
    if not share:
        return [], [], np.zeros(0, bool)
    limit = F.create_map(*[F.lit(x) for lang, s in share.items() for x in (lang, int(s * (1 << 30)))])
    chosen = known.withColumn("_key", key).where(F.col("_key") < F.element_at(limit, F.col("lang")))
    n = F.length("text")
    pieces = chosen.select("lang", "_key", "text", n.alias("_n"), F.posexplode(F.array(*[F.lit(c) for c in PIECE_CHARS[:SAMPLE_PIECES]])).alias("_i", "_len"))
    room = F.greatest(F.col("_n") - F.col("_len"), F.lit(0))
    start = F.pmod(F.xxhash64("_key", "_i"), room + 1).cast("int") + 1
    rows = pieces.where((F.col("_i") == 0) | (F.col("_n") >= F.col("_len"))).select(
        "lang", F.pmod(F.xxhash64("_key"), F.lit(5)).alias("fold"), F.substring("text", start, F.col("_len")).alias("piece"))
    got = sorted((r["lang"], r["piece"], r["fold"]) for r in rows.collect())
    return [p for _, p, _ in got], [lang for lang, _, _ in got], np.array([f == 0 for _, _, f in got], bool)


def identify(docs: DataFrame, learn: Column, per_lang: int = SAMPLE_DOCS) -> DataFrame:
    """Adds ``lang_pred``, ``score`` and ``accepted`` to every row of ``docs``.

    Learns from ``text`` and ``lang`` of the rows where ``learn`` holds and ``lang`` is not null; predictions use
    the whole text and nothing else. A text that is null, empty or without a letter is ``und`` with score 0 and
    rejected, and so is every text when there is nothing to learn from. Columns of the added names are replaced;
    all rows stay, repeated ones too.
    """
    added = ("lang_pred", "score", "accepted")
    docs = docs.drop(*[c for c in added if c in docs.columns])
    model = train(*training_pieces(docs, learn, per_lang))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType(list(docs.schema)).add("lang_pred", "string").add("score", "double").add("accepted", "boolean")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_blocks(batches, "text"):
            langs, score, ok = predict(shared.value, batch.column("text").to_pylist())
            columns = batch.columns
            yield pa.RecordBatch.from_arrays([*columns, pa.array(langs), pa.array(score), pa.array(ok)], names=schema.names)

    return docs.mapInArrow(run, schema)


def fold(doc_id: Column, of: int) -> Column:
    """Remainder of the CRC-32 of the id as text; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % of
