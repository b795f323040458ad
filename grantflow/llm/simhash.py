"""SimHash near-duplicates: fingerprints of word shingles, linked through BK-trees over shards of fingerprints.

Two fingerprints that differ in at most ``r`` bits agree on at least ``p - r`` of any ``p`` pieces they are cut into.
Distinct fingerprints are therefore dealt into shards by every choice of ``p - r`` pieces; no link is lost and each
shard holds a BK-tree of its own: a node's children are keyed by their integer Hamming distance to it, and a search
follows only the edges whose key lies within the radius of the distance at hand. Large shards are cut into parts;
the tree of a part, at most ``PART`` nodes, is sent to the tasks of all parts of its shard.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grantflow.session import cut, cut_table

from .common import key_runs, ranges, sums, text_blocks, text_of
from .components import components

#: Seed of the shingle hash.
SEED = 42

#: Most nodes of one BK-tree.
PART = 8192

#: Pairs of query and node that a search holds at once.
FRONTIER = 1 << 20

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def shingle_bits(texts: list[bytes], shingle: int) -> np.ndarray:
    """A 64-bit fingerprint per text: bit set if more than half of the shingle hashes have it."""
    flat = LOWER[np.frombuffer(b" ".join([*texts, b""]), np.uint8)]
    bounds = np.append(0, np.cumsum([len(t) + 1 for t in texts]))
    space = SPACE[flat]
    first = np.append(True, space[:-1]) & ~space
    last = np.append(space[1:], True) & ~space
    words = np.append(0, np.cumsum(first))[np.minimum(bounds, len(flat))]
    # One space after each word, all other white space dropped.
    keep = ~space
    keep[1:] |= space[1:] & ~space[:-1]
    flat[space] = 0x20
    place = np.cumsum(keep) - 1
    starts, ends = place[first], place[last] + 1
    packed = flat[keep].tobytes()
    count = np.diff(words)
    made = np.where(count == 0, 0, np.maximum(count - shingle + 1, 1))
    begin = ranges(words[:-1], made)
    end = np.minimum(begin + shingle, np.repeat(words[1:], made)) - 1
    digest = xxhash.xxh64_intdigest
    hashes = np.array(
        [digest(packed[a:b], SEED) for a, b in zip(starts[begin].tolist(), ends[end].tolist())], np.uint64
    )
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    ones = sums(bits, np.append(0, np.cumsum(made)), np.int32)
    return np.packbits(ones * 2 > made[:, None], axis=1, bitorder="little").view(np.uint64).ravel()


def fingerprints(docs: DataFrame, shingle: int = 4, text: str = "text", id_column: str = "doc_id", carry: tuple[str, ...] = ()) -> DataFrame:
    """``(doc_id, *carry, fp)`` for every row; ``fp`` is the fingerprint as a signed 64-bit number. Null texts are empty."""
    source = docs.select(F.col(id_column).alias("doc_id"), *carry, text_of(docs, text).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_blocks(batches, "_text"):
            found = shingle_bits(batch.column("_text").cast(pa.binary()).to_pylist(), shingle)
            kept = ["doc_id", *carry]
            yield pa.RecordBatch.from_arrays([*map(batch.column, kept), pa.array(found.view(np.int64))], names=[*kept, "fp"])

    return source.mapInArrow(run, source.drop("_text").schema.add("fp", "long"))


class Trees:
    """BK-trees of many groups of values, built and searched level by level for all groups at once.

    The first value of a group is its root. ``values`` are distinct within a group.
    """

    def __init__(self, values: np.ndarray, group: np.ndarray):
        order = np.argsort(group, kind="stable")
        self.values = values
        n = len(values)
        self.parent, self.edge = np.full(n, -1, np.int64), np.zeros(n, np.int64)
        group = group[order]
        head = np.append(True, group[1:] != group[:-1]) if n else np.zeros(0, bool)
        self.groups, self.roots = group[head], order[head]
        at = np.repeat(self.roots, np.diff(np.append(np.flatnonzero(head), n)))
        rest, at = order[~head], at[~head]
        while len(rest):
            edge = np.bitwise_count(values[rest] ^ values[at]).astype(np.int64)
            child = np.argsort(at * 65 + edge, kind="stable")
            rest, at, edge = rest[child], at[child], edge[child]
            key = at * 65 + edge
            head = np.append(True, key[1:] != key[:-1])
            self.parent[rest[head]], self.edge[rest[head]] = at[head], edge[head]
            below = np.repeat(rest[head], np.diff(np.append(np.flatnonzero(head), len(rest))))
            rest, at = rest[~head], below[~head]
        nodes = np.flatnonzero(self.parent >= 0)
        keys = self.parent[nodes] * 65 + self.edge[nodes]
        order = np.argsort(keys)
        self.children, self.keys = nodes[order], keys[order]

    def within(self, queries: np.ndarray, group: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (query, node) at most ``radius`` apart, a part of them at a time."""
        at = np.minimum(np.searchsorted(self.groups, group), max(len(self.groups) - 1, 0))
        known = np.flatnonzero(self.groups[at] == group) if len(self.groups) else np.zeros(0, np.int64)
        todo = [(known[i : i + FRONTIER], self.roots[at[known[i : i + FRONTIER]]]) for i in range(0, len(known), FRONTIER)]
        while todo:
            query, node = todo.pop()
            far = np.bitwise_count(queries[query] ^ self.values[node]).astype(np.int64)
            near = far <= radius
            if near.any():
                yield query[near], node[near]
            low = np.searchsorted(self.keys, node * 65 + np.maximum(far - radius, 1))
            high = np.searchsorted(self.keys, node * 65 + np.minimum(far + radius, 64), "right")
            count = np.maximum(high - low, 0)
            total = np.cumsum(count)
            start = 0
            while start < len(query) and total[-1] > (total[start - 1] if start else 0):
                base = total[start - 1] if start else 0
                end = max(int(np.searchsorted(total, base + FRONTIER, "right")), start + 1)
                part = slice(start, end)
                if count[part].any():
                    todo.append((np.repeat(query[part], count[part]), self.children[ranges(low[part], count[part])]))
                start = end


class Forest:
    """Union by the smaller number, with a spanning set of the links that joined two classes."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def roots(self, x: np.ndarray) -> np.ndarray:
        while True:
            y = self.up[x]
            if (y == x).all():
                return x
            self.up[x] = self.up[y]
            x = self.up[y]

    def link(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Join the classes of ``a[i]`` and ``b[i]``; returns links between former roots that suffice."""
        left, right = [], []
        while True:
            ra, rb = self.roots(a), self.roots(b)
            open_ = ra != rb
            if not open_.any():
                return (np.concatenate(left), np.concatenate(right)) if left else (ra[:0], rb[:0])
            a, b, high, low = a[open_], b[open_], np.maximum(ra, rb)[open_], np.minimum(ra, rb)[open_]
            high, first = np.unique(high, return_index=True)
            self.up[high] = low[first]
            left.append(high)
            right.append(low[first])


def pieces_for(distinct: int, bits: int = 64, radius: int = 4, filled: int = 256) -> int:
    """Number of pieces so that a shard of random values holds at most about ``filled`` of them."""
    pieces = radius + 1
    while pieces < 2 * radius and distinct > filled << (bits * (pieces - radius) // pieces):
        pieces += 1
    return pieces


def shard_keys(fp: str, pieces: int, radius: int):
    """Every choice of ``pieces - radius`` pieces of a fingerprint: an array of (choice, value of the pieces)."""
    edges = [64 * i // pieces for i in range(pieces + 1)]
    keys = []
    for number, chosen in enumerate(combinations(range(pieces), pieces - radius)):
        mask = sum(((1 << (edges[i + 1] - edges[i])) - 1) << edges[i] for i in chosen)
        mask = mask - (1 << 64) if mask >= 1 << 63 else mask
        keys.append(F.struct(F.lit(number).alias("choice"), F.col(fp).bitwiseAND(F.lit(mask)).alias("pieces")))
    assert len(keys) == comb(pieces, pieces - radius)
    return F.array(*keys)


def near_links(distinct: DataFrame, rows: int, radius: int = 4, part: int = PART) -> DataFrame:
    """Links ``(a, b)`` that connect all distinct fingerprints ``fp`` at most ``radius`` bits apart.

    Every near pair is found; of the pairs inside one search only a spanning set is returned, so a group of ``n``
    near fingerprints gives at most ``n - 1`` links per shard.
    """
    keyed = distinct.select("fp", F.explode(shard_keys("fp", pieces_for(rows, radius=radius), radius)).alias("k")).select("fp", "k.*")
    large = keyed.groupBy("choice", "pieces").count().where(F.col("count") > part).select(
        "choice", "pieces", F.ceil(F.col("count") / part).cast("int").alias("parts"))
    dealt = keyed.join(large, ["choice", "pieces"], "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("fp"), "parts").cast("int")).withColumn(
        "meets", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    cells = dealt.select(
        "fp", F.xxhash64("choice", "pieces", F.least("own", "meets"), F.greatest("own", "meets")).alias("cell"),
        (F.col("own") <= F.col("meets")).alias("tree"), (F.col("own") >= F.col("meets")).alias("asks"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in key_runs(batches, ["cell"]):
            fp = table["fp"].to_numpy().view(np.uint64)
            cell = table["cell"].to_numpy()
            tree, asks = table["tree"].to_numpy(zero_copy_only=False), table["asks"].to_numpy(zero_copy_only=False)
            inside, outside = np.flatnonzero(tree), np.flatnonzero(asks)
            trees, forest = Trees(fp[inside], cell[inside]), Forest(len(fp))
            for query, node in trees.within(fp[outside], cell[outside], radius):
                a, b = forest.link(outside[query], inside[node])
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(fp[a].view(np.int64)), pa.array(fp[b].view(np.int64))], names=["a", "b"])

    return cells.repartition("cell").sortWithinPartitions("cell").mapInArrow(run, "a long, b long")


def near_duplicates(
    docs: DataFrame, shingle: int = 4, radius: int = 4, text: str = "text", id_column: str = "doc_id", carry: tuple[str, ...] = ()
) -> DataFrame:
    """``(doc_id, *carry, fp, fingerprint, component_id, root)``, a row for every row of ``docs``.

    Words are separated by white space (0x20, 0x09-0x0D) and A-Z is lower-cased; shingles of ``shingle`` words
    count as often as they occur. A shorter text is one shingle; a text without words, also null, has fingerprint
    zero and is linked like any other. ``component_id`` is the smallest id reachable over links of at most
    ``radius`` differing bits (null only if no id of the component is known). Equal ids are equal documents for
    it but keep their rows. ``root`` is the least fingerprint of the component. An empty table gives an empty result.

    Copies are reduced to one fingerprint before any search, and fingerprints, links and components stay in Spark.
    """
    prints = cut(fingerprints(docs, shingle, text, id_column, carry))
    distinct = cut_table(prints.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = components(near_links(distinct.df, distinct.rows, radius))
    rooted = distinct.df.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(least, "root").select("fp", "component_id", "root")
    return prints.join(named, "fp").select(
        "doc_id", *carry, "fp", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "root")
