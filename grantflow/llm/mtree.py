"""Exact top-k by inner product: best-first search in M-trees.

Inner products become distances by one more component: a candidate ``x`` gets ``sqrt(M - |x|^2)``, ``M`` being the
largest squared norm of its tree, a query gets 0; then ``|q - x|^2 = |q|^2 + M - 2 q.x``, and the nearest candidates
are those of the highest product. Candidates are dealt to shards by their nearest pivot, and each shard is a tree of
paged nodes. A node stores for every entry its distance to the node's own centre, and for a subtree its covering radius;
with the query's distance to that centre, which is known, the triangle inequality rules out entries before their own
distance is computed. Pages are taken in the order of the best product they may hold.
"""

from __future__ import annotations

import heapq
import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from grantflow.functions.skew import bounded_broadcast
from grantflow.session import cut_table, literal_table

from .common import key_runs

#: Vectors per shard, entries per leaf and per inner page, queries per block.
SHARD, LEAF, PAGE, QUERIES = 8192, 384, 64, 4096

#: Most pivots, the routing objects above all shards; the vectors of a pivot fill as many shards as they need.
PIVOTS = 512

#: Relative slack of bounds in floating point; products themselves are exact integers.
SLACK = 1e-9


def lift(x: np.ndarray, most: float) -> np.ndarray:
    """Vectors with the component that makes their squared norm ``most``."""
    return np.concatenate([x, np.sqrt(np.maximum(most - (x * x).sum(1), 0))[:, None]], 1)


class Tree:
    """An M-tree over integer vectors. Pages are slices of arrays; page 0 is the root.

    ``pages`` has per page: is it a leaf, first and last entry. Entries of leaves are vectors, entries of inner pages
    are routing objects with a radius and a child page; ``near`` is an entry's distance to its page's centre.
    """

    FIELDS = ("ids", "vectors", "near", "pages", "route", "route_near", "radius", "child", "most")

    def __init__(self, **fields):
        for name in self.FIELDS:
            setattr(self, name, fields[name])
        self.points = self.vectors.astype(np.float64)

    @classmethod
    def build(cls, ids: np.ndarray, vectors: np.ndarray, seed: int = 42) -> Tree:
        rng = np.random.default_rng(seed)
        most = float((vectors.astype(np.float64) ** 2).sum(1).max(initial=0))
        points = lift(vectors.astype(np.float64), most)
        order, near = [], []
        pages: list = [None]
        route, route_near, radius, child = [], [], [], []
        todo = [(0, np.arange(len(ids)), points[0] if len(points) else np.zeros(points.shape[1]))]
        leaf_end = 0
        while todo:
            page, members, centre = todo.pop()
            far = np.sqrt(((points[members] - centre) ** 2).sum(1))
            groups = None
            if len(members) > LEAF and far.max() > 0:
                seeds = members[rng.permutation(len(members))[: min(PAGE, -(-2 * len(members) // LEAF))]]
                seeds = seeds[np.sort(np.unique(points[seeds], axis=0, return_index=True)[1])]
                squares = (points[seeds] ** 2).sum(1)
                closest = np.argmin(squares - 2 * points[members] @ points[seeds].T, 1)
                groups = [(s, members[closest == i]) for i, s in enumerate(seeds)]
                groups = [(s, g) for s, g in groups if len(g)]
            if groups is None or len(groups) < 2:
                sort = np.lexsort((ids[members], far))
                order.append(members[sort])
                near.append(far[sort])
                pages[page] = (1, leaf_end, leaf_end + len(members))
                leaf_end += len(members)
                continue
            pages[page] = (0, len(route), len(route) + len(groups))
            for s, group in groups:
                route.append(points[s])
                route_near.append(np.sqrt(((points[s] - centre) ** 2).sum()))
                radius.append(np.sqrt(((points[group] - points[s]) ** 2).sum(1)).max())
                child.append(len(pages))
                todo.append((len(pages), group, points[s]))
                pages.append(None)
        order = np.concatenate(order)
        return cls(
            ids=ids[order], vectors=vectors[order], near=np.concatenate(near), pages=np.array(pages, np.int64),
            route=np.array(route).reshape(-1, points.shape[1]), route_near=np.array(route_near), radius=np.array(radius),
            child=np.array(child, np.int64), most=np.array(most),
        )

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, **{name: getattr(self, name) for name in self.FIELDS})
        return out.getvalue()

    @classmethod
    def load(cls, raw: bytes) -> Tree:
        with np.load(io.BytesIO(raw)) as z:
            return cls(**{name: z[name] for name in cls.FIELDS})

    def top(self, query: np.ndarray, own: int, k: int, floor: float = -np.inf) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the ``k`` best candidates that score at least ``floor``, best first, ties by id."""
        q = query.astype(np.float64)
        size = float(q @ q)
        both = size + float(self.most)
        reach = lambda score: np.sqrt(max(both - 2 * score, 0.0)) * (1 + SLACK) + 1e-6 if score > -np.inf else np.inf
        best_ids, best = np.zeros(0, np.int64), np.zeros(0, np.int64)
        limit = reach(floor)
        # The root has no centre of its own that a distance is known to; its entries are all computed.
        queue = [(0.0, 0, None)]
        while queue:
            bound, page, centre = heapq.heappop(queue)
            if bound > limit:
                break
            leaf, low, high = self.pages[page].tolist()
            if leaf:
                if centre is not None:
                    # Entries are sorted by their distance to the centre, so those in reach are neighbours.
                    low, high = low + int(np.searchsorted(self.near[low:high], centre - limit)), low + int(np.searchsorted(self.near[low:high], centre + limit, "right"))
                score = (self.points[low:high] @ q).astype(np.int64)
                hit = np.flatnonzero((score >= max(floor, best[-1] if len(best) == k else -np.inf)) & (self.ids[low:high] != own))
                if not len(hit):
                    continue
                ids, score = np.append(best_ids, self.ids[low + hit]), np.append(best, score[hit])
                order = np.lexsort((ids, -score))[:k]
                best_ids, best = ids[order], score[order]
                if len(best) == k:
                    limit = min(limit, reach(float(best[-1])))
                continue
            radius = self.radius[low:high]
            if centre is None:
                use = np.arange(low, high)
            else:
                use = low + np.flatnonzero(np.abs(centre - self.route_near[low:high]) - radius <= limit)
            far = np.sqrt(np.maximum(both - 2 * (self.route[use, :-1] @ q), 0))
            bounds = np.maximum(far - self.radius[use], 0)
            for b, c, f in zip(bounds.tolist(), self.child[use].tolist(), far.tolist()):
                if b <= limit:
                    heapq.heappush(queue, (b, c, f))
        return best_ids, best


def quantized(values: pa.Array, scale: float = 64.0) -> tuple[np.ndarray, list]:
    """Rows that hold whole finite vectors, and their components times ``scale``, rounded down."""
    rows, out = [], []
    for i, v in enumerate(values):
        x = v.values
        if v.is_valid and x is not None and not x.null_count:
            x = x.to_numpy(zero_copy_only=False).astype(np.float64)
            if np.isfinite(x).all():
                rows.append(i)
                out.append(np.floor(scale * x).astype(np.int64))
    return np.array(rows, np.int64), out


def distinct_few(ids: np.ndarray, vectors: np.ndarray, k: int) -> np.ndarray:
    """Rows left when equal rows count once and every vector keeps its ``k + 1`` smallest ids: no other row can be
    among the ``k`` best of any query."""
    _, same = np.unique(vectors, axis=0, return_inverse=True)
    order = np.lexsort((ids, same.ravel()))
    group, sorted_ids = same.ravel()[order], ids[order]
    order = order[np.append(True, (group[1:] != group[:-1]) | (sorted_ids[1:] != sorted_ids[:-1]))]
    group = same.ravel()[order]
    head = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    rank = np.arange(len(order)) - np.repeat(head, np.diff(np.append(head, len(order))))
    return np.sort(order[rank <= k])


def _prepare(k: int, scale: float):
    """Rows of valid vectors, copies in a batch reduced to what any answer can hold (``kept``) or what asks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, vectors = quantized(batch.column("_vector"), scale)
            ids = batch.column("vec_id").to_numpy()
            asks = batch.column("asks").to_numpy(zero_copy_only=False).astype(bool)
            lengths = np.array([len(v) for v in vectors], np.int64)
            for size in np.unique(lengths).tolist():
                part = np.flatnonzero(lengths == size)
                x = np.array([vectors[i] for i in part]).reshape(len(part), size)
                kept = np.zeros(len(part), bool)
                kept[distinct_few(ids[rows[part]], x, k)] = True
                use = np.flatnonzero(kept | asks[rows[part]])
                own = rows[part[use]]
                yield pa.RecordBatch.from_arrays([
                    pa.array(ids[own]), pa.array(np.full(len(use), size)), pa.array([r.tobytes() for r in x[use]], pa.binary()), pa.array(asks[own]), pa.array(kept[use]),
                ], names=["vec_id", "size", "raw", "asks", "kept"])

    return run


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Packed vectors of one length as rows."""
    raw = column.to_pylist()
    return np.frombuffer(b"".join(raw), np.int64).reshape(len(raw), len(raw[0]) // 8 if raw else 0)


def _place(pivots: dict[int, np.ndarray]):
    """Adds the nearest pivot of the vector's length, and the distance to it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("size").to_numpy()
            pivot, far = np.zeros(len(sizes), np.int32), np.zeros(len(sizes))
            for size in np.unique(sizes).tolist():
                part = np.flatnonzero(sizes == size)
                p, x = pivots[size], matrix(batch.column("raw").take(pa.array(part))).astype(np.float64)
                pivot[part] = np.argmin((p**2).sum(1) - 2 * x @ p.T, 1)
                far[part] = np.sqrt(((x - p[pivot[part]]) ** 2).sum(1))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(pivot), pa.array(far)], names=[*batch.schema.names, "pivot", "far"])

    return run


def _route(pivots: dict[int, np.ndarray], reach: dict[int, np.ndarray]):
    """Queries with the pivots, besides their own, in whose covering radius a score may come up to their floor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, own = batch.column("size").to_numpy(), batch.column("pivot").to_numpy()
            floor = batch.column("floor").to_numpy(zero_copy_only=False).astype(np.float64)
            for size in np.unique(sizes).tolist():
                part = np.flatnonzero(sizes == size)
                x = matrix(batch.column("raw").take(pa.array(part))).astype(np.float64)
                most = x @ pivots[size].T + np.sqrt((x * x).sum(1))[:, None] * reach[size]
                use = ~(most * (1 + SLACK) + 1e-6 < floor[part][:, None])
                use[np.arange(len(part)), own[part]] = False
                row, pivot = np.nonzero(use)
                taken = batch.take(pa.array(part[row])).drop_columns(["pivot"])
                yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(pivot.astype(np.int32))], names=[*taken.schema.names, "pivot"])

    return run


def _build(k: int):
    """A tree per shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in key_runs(batches, ["shard"], SHARD):
            shards = table["shard"].to_numpy(zero_copy_only=False)
            for shard in np.unique(shards).tolist():
                rows = table.take(pa.array(np.flatnonzero(shards == shard)))
                ids, x = rows["vec_id"].to_numpy(), matrix(rows["raw"])
                few = distinct_few(ids, x, k)
                yield pa.RecordBatch.from_arrays([pa.array([shard]), pa.array([Tree.build(ids[few], x[few]).dump()], pa.binary())], names=["shard", "tree"])

    return run


def _search(k: int):
    """Answers of a block of queries from one tree."""

    def run(queries: pa.Table, trees: pa.Table) -> pa.Table:
        tree = Tree.load(trees["tree"][0].as_py()) if trees.num_rows and queries.num_rows else None
        own, raws = queries["vec_id"].to_numpy(), queries["raw"].to_pylist()
        floors = queries["floor"].to_numpy().astype(np.float64)
        found = [tree.top(np.frombuffer(raw, np.int64), i, k, -np.inf if np.isnan(f) else f) for i, raw, f in zip(own.tolist(), raws, floors.tolist())] if tree else []
        row = np.repeat(np.arange(len(found)), [len(ids) for ids, _ in found])
        join = lambda i: np.concatenate([f[i] for f in found]) if found else np.zeros(0, np.int64)
        return pa.table({"query_id": pa.array(own[row]), "raw": pa.array(raws, pa.binary()).take(pa.array(row)), "vec_id": pa.array(join(0)), "score": pa.array(join(1))})

    return run


def _answers(queries: DataFrame, trees: DataFrame, k: int) -> DataFrame:
    """Queries ``(shard, vec_id, raw, floor)`` against the trees of their shards, in blocks of bounded size."""
    blocks = queries.groupBy("shard").agg(F.ceil(F.count("*") / QUERIES).cast("int").alias("blocks"))
    asked = queries.join(blocks, "shard").select("shard", F.pmod(F.xxhash64("vec_id", "raw"), "blocks").cast("int").alias("block"), "vec_id", "raw", "floor")
    held = trees.join(blocks, "shard").select("shard", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "tree")
    return asked.groupBy("shard", "block").cogroup(held.groupBy("shard", "block")).applyInArrow(
        _search(k), "query_id long, raw binary, vec_id long, score long")


def top_k(vectors: DataFrame, asks: Column, k: int = 20, scale: float = 64.0, vector: str = "embedding", id_column: str = "vec_id") -> DataFrame:
    """The ``k`` candidates of the highest inner product for every row where ``asks`` holds.

    Vectors are rounded down after multiplication by ``scale``. Returns ``query_id``, ``rank`` (from 1), ``vec_id``
    and ``score``; fewer rows per query if there are fewer candidates; ties go to the smaller id. The query's own
    id is no candidate. Rows of equal id and vector count once; rows without id and vectors that are null or hold
    null or non-finite components take no part; vectors of different length do not meet. Scores must stay below
    2**53. An empty table gives an empty result.

    Each query first searches the shards of its own pivot; its k-th score there bounds the search in all others.
    The driver holds the pivots alone.
    """
    source = vectors.where(F.col(id_column).isNotNull()).select(
        F.col(id_column).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("_vector"), F.coalesce(asks, F.lit(False)).alias("asks"))
    rows = cut_table(source.mapInArrow(_prepare(k, scale), "vec_id long, size long, raw binary, asks boolean, kept boolean"))
    first = [r["raw"] for r in rows.df.groupBy("size").agg(F.min("raw").alias("raw")).collect()]
    want = max(0, min(PIVOTS, rows.rows // SHARD))
    sample = rows.df.select("raw").distinct().orderBy(F.xxhash64("raw")).limit(want).collect() if want else []
    pivots: dict = {}
    for raw in sorted({*first, *(r["raw"] for r in sample)}):
        pivots.setdefault(len(raw) // 8, []).append(np.frombuffer(raw, np.int64))
    pivots = {size: np.array(p).astype(np.float64).reshape(len(p), size) for size, p in pivots.items()}
    placed = cut_table(rows.df.mapInArrow(_place(pivots), "vec_id long, size long, raw binary, asks boolean, kept boolean, pivot int, far double")).df
    areas = placed.groupBy("size", "pivot").agg(F.ceil(F.sum(F.col("kept").cast("int")) / SHARD).cast("int").alias("parts"), F.max("far").alias("reach")).collect()
    reach = {size: np.full(len(p), -np.inf) for size, p in pivots.items()}
    for r in areas:
        reach[r["size"]][r["pivot"]] = r["reach"]
    parts = literal_table(vectors.sparkSession, [(r["size"], r["pivot"], max(1, r["parts"])) for r in areas], "size long, pivot int, parts int")
    parts = bounded_broadcast(parts, len(areas))
    name = lambda part: F.concat_ws("-", "size", "pivot", part).alias("shard")
    members = placed.where("kept").join(parts, ["size", "pivot"]).select(
        name(F.pmod(F.xxhash64("raw"), "parts")), "vec_id", "raw").repartition("shard").sortWithinPartitions("shard")
    trees = cut_table(members.mapInArrow(_build(k), "shard string, tree binary")).df
    queries = placed.where("asks").select("vec_id", "size", "raw", "pivot").distinct()

    def in_shards(asked: DataFrame) -> DataFrame:
        return asked.join(parts, ["size", "pivot"]).withColumn("_part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(
            name("_part"), "vec_id", "raw", "floor")

    home = cut_table(_answers(in_shards(queries.withColumn("floor", F.lit(None).cast("double"))), trees, k)).df
    best = Window.partitionBy("query_id", "raw").orderBy(F.col("score").desc(), "vec_id")
    near = home.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    floors = near.where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), "raw", F.col("score").cast("double").alias("floor"))
    asked = queries.join(floors, ["vec_id", "raw"], "left").select("vec_id", "size", "raw", "floor", "pivot")
    asked = asked.mapInArrow(_route(pivots, reach), "vec_id long, size long, raw binary, floor double, pivot int")
    rest = _answers(in_shards(asked), trees, k)
    ranked = home.unionByName(rest).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
