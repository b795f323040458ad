"""Document fingerprints from improbable features, and the likeness of two of them.

Every window of ``WINDOW`` bytes has an entropy. Windows are ranked by how rare their entropy is over all documents;
among any ``WINDOW`` neighbouring windows the rarest (the first of equals) gets a vote, and windows with at least
``VOTES`` votes are features. Features enter a chain of Bloom filters, a new one after ``FILTER_FEATURES`` of them. The
likeness of two chains is the mean, over the filters of the shorter one, of the best bit overlap with a filter of
the other, scaled so that the overlap expected by chance counts as nothing.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mix64, ranges, sums, text_blocks, text_bytes, text_of

#: Bytes per window; also the number of neighbouring windows that vote together.
WINDOW = 16

#: Votes that make a window a feature.
VOTES = 6

#: Bits of a filter, bits set per feature, and features after which the next filter begins.
FILTER_BITS, FEATURE_BITS, FILTER_FEATURES = 2048, 5, 160

#: Entropy is kept as a whole number of these parts of its range.
LEVELS = 1000

#: Most parts that documents are dealt into for comparison with their neighbours; beyond it parts grow.
MOST_PARTS = 20_000

#: Scale of the fixed-point table of n log2 n.
FIXED = 1 << 20

NLOGN = np.array([0, *[round(n * np.log2(n) * FIXED) for n in range(1, WINDOW + 2)]], np.int64)
STEP_UP = np.diff(NLOGN)


def window_levels(flat: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Entropy level (0 to ``LEVELS``) of the window at every byte; -1 where no whole window of one text begins."""
    n = len(flat)
    level = np.full(n, -1, np.int16)
    if n < WINDOW:
        return level
    # How often a byte occurs in the WINDOW - 1 places before and after it gives what each step of a sliding window changes.
    before, after = np.zeros(n, np.uint8), np.zeros(n, np.uint8)
    for d in range(1, WINDOW):
        same = flat[d:] == flat[:-d]
        before[d:] += same
        after[:-d] += same
    first = np.bincount(flat[:WINDOW], minlength=256)
    change = STEP_UP[before[WINDOW:]] - STEP_UP[after[: n - WINDOW]]
    total = np.append(0, np.cumsum(change)) + int(NLOGN[first].sum())
    most = WINDOW * np.log2(WINDOW) * FIXED
    level[: n - WINDOW + 1] = np.rint((most - total) * (LEVELS / most))
    sizes = np.diff(offsets)
    tails = ranges(offsets[1:] - np.minimum(sizes, WINDOW - 1), np.minimum(sizes, WINDOW - 1))
    level[tails] = -1
    return level


def rarity(counts: np.ndarray) -> np.ndarray:
    """Rank of each entropy level: 0 is the least frequent. Levels of equal frequency rank by level."""
    rank = np.empty(LEVELS + 1, np.int64)
    rank[np.lexsort((np.arange(LEVELS + 1), counts))] = np.arange(LEVELS + 1)
    return rank


def features(flat: np.ndarray, offsets: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit features of all texts in order, and the offsets of the texts. A text shorter than a window is one."""
    n = len(flat)
    level = window_levels(flat, offsets)
    place = np.arange(n, dtype=np.int64)
    key = np.where(level >= 0, rank[level] << 40, np.int64(1) << 60) | place
    low, span = key, 1
    while span < WINDOW and len(low) > span:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    chosen = low & ((1 << 40) - 1)
    sizes = np.diff(offsets)
    windows = np.maximum(sizes - WINDOW + 1, 0)
    cast = chosen[ranges(offsets[:-1], np.maximum(windows - WINDOW + 1, 0))]
    starts = np.flatnonzero(np.append(True, cast[1:] != cast[:-1])) if len(cast) else cast
    got = cast[starts][np.diff(np.append(starts, len(cast))) >= VOTES]
    # A text in which no window wins is known by its rarest one.
    few = np.flatnonzero((windows > 0) & (np.diff(np.searchsorted(got, offsets)) == 0))
    if len(few):
        got = np.sort(np.concatenate([got, least(key, offsets[:-1][few], windows[few]) & ((1 << 40) - 1)]))
    padded = np.append(flat, np.zeros(WINDOW, np.uint8))
    words = np.lib.stride_tricks.sliding_window_view(padded, WINDOW)[got].copy().view("<u8")
    feature = np.zeros(len(got), np.uint64)
    for i in range(words.shape[1]):
        feature = mix64(feature ^ words[:, i]) + np.uint64(i + 1)
    short = np.flatnonzero((sizes > 0) & (sizes < WINDOW))
    if len(short):
        whole = np.zeros((len(short), WINDOW), np.uint8)
        fill = sizes[short]
        whole[np.repeat(np.arange(len(short)), fill), ranges(np.zeros(len(short), np.int64), fill)] = flat[ranges(offsets[:-1][short], fill)]
        words = whole.view("<u8")
        own = np.zeros(len(short), np.uint64)
        for i in range(words.shape[1]):
            own = mix64(own ^ words[:, i]) + np.uint64(i + 1)
        place = np.concatenate([got, offsets[:-1][short]])
        order = np.argsort(place, kind="stable")
        return np.concatenate([feature, own ^ fill.astype(np.uint64)])[order], np.searchsorted(place[order], offsets)
    return feature, np.searchsorted(got, offsets)


def least(values: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Least of ``values[starts[i]:starts[i] + counts[i]]``; counts are positive."""
    return np.minimum.reduceat(values[ranges(starts, counts)], np.append(0, np.cumsum(counts)[:-1]))


def chains(feature: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Filters of all texts as rows of bytes, and the offsets of the texts. A text without features has none."""
    texts = np.diff(at)
    filters = -(-texts // FILTER_FEATURES)
    offsets = np.append(0, np.cumsum(filters))
    owner = np.repeat(offsets[:-1], texts) + (np.arange(len(feature)) - np.repeat(at[:-1], texts)) // FILTER_FEATURES
    bits = np.zeros((int(offsets[-1]), FILTER_BITS), bool)
    for i in range(FEATURE_BITS):
        bits[owner, (feature >> np.uint64(11 * i)).astype(np.int64) & (FILTER_BITS - 1)] = True
    return np.packbits(bits, axis=1), offsets


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Likeness (0 to 1) of two chains of filters; 1 for two without features, 0 if only one has any."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    if len(a) == len(b) and np.array_equal(a, b):
        return 1.0
    if len(a) > len(b):
        a, b = b, a
    ones_a, ones_b = (np.bitwise_count(x.view("<u8")).sum(1, dtype=np.int64) for x in (a, b))
    best = np.zeros(len(a))
    for i, row in enumerate(a.view("<u8")):
        both = np.bitwise_count(b.view("<u8") & row).sum(1, dtype=np.int64)
        chance = ones_a[i] * ones_b / FILTER_BITS
        most = np.minimum(ones_a[i], ones_b)
        best[i] = np.max(np.clip((both - chance) / np.maximum(most - chance, 1e-9), 0, 1))
    return float(np.average(best, weights=ones_a))


def compare(one: str, other: str) -> float:
    """Likeness of two fingerprints as strings."""
    return likeness(*(np.frombuffer(base64.b64decode(x), np.uint8).reshape(-1, FILTER_BITS // 8) for x in (one, other)))


def level_counts(docs: DataFrame, text: str = "text") -> np.ndarray:
    """How often each entropy level occurs over all windows of all documents; one small row per task is summed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(LEVELS + 1, np.int64)
        for batch in text_blocks(batches, "_text"):
            level = window_levels(*text_bytes(batch.column("_text")))
            counts += np.bincount(level[level >= 0], minlength=LEVELS + 1)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], names=["level", "n"])

    rows = docs.select(text_of(docs, text).alias("_text")).mapInArrow(run, "level long, n long").groupBy("level").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(LEVELS + 1, np.int64)
    for r in rows:
        counts[r["level"]] = r["n"]
    return counts


class Digester:
    """Fingerprints by one ranking of entropy levels."""

    def __init__(self, rank: np.ndarray):
        self.rank = rank

    def filters(self, texts: list[bytes]) -> list[np.ndarray]:
        flat = np.frombuffer(b"".join(texts), np.uint8)
        rows, at = chains(*features(flat, np.append(0, np.cumsum([len(t) for t in texts], dtype=np.int64)), self.rank))
        return [rows[a:b] for a, b in zip(at.tolist(), at[1:].tolist())]

    def pack(self, filters: np.ndarray) -> str:
        return base64.b64encode(filters.tobytes()).decode()


def fingerprint(docs: DataFrame, rank: np.ndarray | None = None, text: str = "text") -> DataFrame:
    """Adds ``fingerprint`` (base64 of the chained filters; empty for an empty or null text) to every row.

    ``rank`` is taken from all documents unless given. Equal texts have equal fingerprints; a column of that name is
    replaced, all rows stay.
    """
    rank = rarity(level_counts(docs, text)) if rank is None else rank
    keep = [c for c in docs.columns if c != "fingerprint"]
    source = docs.select(*keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digester = Digester(rank)
        for batch in text_blocks(batches, text):
            texts = [t or b"" for t in batch.column(text).cast(pa.binary()).to_pylist()]
            made = [digester.pack(f) for f in digester.filters(texts)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.string())], names=[*keep, "fingerprint"])

    return source.mapInArrow(run, source.withColumn("fingerprint", F.lit("")).schema)


def edited(text: str, following: str) -> str:
    """``text`` with its last half replaced by as many letters of the start of ``following`` (or all it has)."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def ordered_parts(docs: DataFrame, per_part: int) -> DataFrame:
    """Documents in parts of neighbouring ids: adds ``part`` and ``guest``.

    Parts are ranges of ids of about ``per_part`` rows; the first document of a part is in the part before, too, as
    its ``guest``, and the first of all is the guest of the last part. Only ids are read to find the ranges.
    """
    ids = docs.select("_id")
    rows = ids.count()
    parts = min(max(1, -(-rows // per_part)), MOST_PARTS)
    cuts = []
    if parts > 1:
        cuts = sorted(set(ids.agg(F.percentile_approx("_id", [i / parts for i in range(1, parts)], 100 * parts)).first()[0]))
    edges = np.array(cuts, np.int64)

    def place(values):
        import pandas as pd

        return pd.Series(np.searchsorted(edges, values.to_numpy(), "right"))

    place = F.pandas_udf(place, "long")
    parted = docs.withColumn("part", place("_id") if len(edges) else F.lit(0).cast("long"))
    heads = dict(parted.select("part", "_id").groupBy("part").agg(F.min("_id")).collect()) if rows else {}
    order = sorted(heads)
    before = {p: order[i - 1] for i, p in enumerate(order)}
    lookup = {heads[p]: before[p] for p in order}

    def host(values):
        import pandas as pd

        return pd.Series([lookup.get(v) for v in values.tolist()], dtype="Int64")

    host = F.pandas_udf(host, "long")
    both = parted.withColumn("_host", host("_id")).withColumn("_in", F.explode(F.when(
        F.col("_host").isNull(), F.array(F.struct(F.col("part"), F.lit(False).alias("guest")))
    ).otherwise(F.array(F.struct(F.col("part"), F.lit(False).alias("guest")), F.struct(F.col("_host").alias("part"), F.lit(True).alias("guest"))))))
    return both.select(*docs.columns, "_in.part", "_in.guest")


def against_next(docs: DataFrame, per_part: int = 4000, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text, of the text edited with the next document, and how like they are.

    The next document is the one with the next larger id (equal ids: by text; null ids first), after the last one
    the first. Returns ``doc_id``, ``n_chars``, ``edited_text``, ``fingerprint``, ``edited_fingerprint``,
    ``near_edited`` and ``near_next``, a row for every row. A table of one row is its own next document.
    """
    rank = rarity(level_counts(docs, text))
    base = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.coalesce(F.col(id_column).cast("long"), F.lit(-(1 << 63))).alias("_id"), text_of(docs, text).alias("_text"))
    parts = ordered_parts(base, per_part)
    schema = "doc_id long, n_chars long, edited_text string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digester = Digester(rank)

        def made(rows, texts, after):
            """Rows whose next document is known: ``after`` follows the last of them."""
            nexts = [*texts[1:], after]
            changed = [edited(t, n) for t, n in zip(texts, nexts)]
            prints = digester.filters([t.encode() for t in [*texts, after, *changed]])
            own, other = prints[: len(texts) + 1], prints[len(texts) + 1 :]
            return pa.RecordBatch.from_arrays([
                pa.array(rows, pa.int64()), pa.array([len(t) for t in texts], pa.int64()), pa.array(changed, pa.string()),
                pa.array(map(digester.pack, own[:-1]), pa.string()), pa.array(map(digester.pack, other), pa.string()),
                pa.array(map(likeness, own, other), pa.float64()), pa.array(map(likeness, own, own[1:]), pa.float64()),
            ], names=["doc_id", "n_chars", "edited_text", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

        ids, texts, part, closed = [], [], None, False
        for batch in text_blocks(batches, "_text"):
            for doc, t, p, guest in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "_text", "part", "guest"))):
                if p != part:
                    part, closed = p, False
                if closed:
                    continue
                if guest:
                    yield made(ids, texts, t)
                    ids, texts, closed = [], [], True
                    continue
                ids.append(doc)
                texts.append(t)
            if len(ids) > 1:
                yield made(ids[:-1], texts[:-1], texts[-1])
                ids, texts = ids[-1:], texts[-1:]

    sorted_parts = parts.repartition("part").sortWithinPartitions("part", "guest", "_id", "_text")
    return sorted_parts.select("doc_id", "_text", "part", "guest").mapInArrow(run, schema)
