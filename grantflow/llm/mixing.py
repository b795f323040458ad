"""Mixing sources to target weights by a min-cost flow over membership patterns.

Documents may belong to several sources. They are aggregated by membership pattern (the set of their sources), so
the flow network has one node per pattern and one per source, whatever the number of documents. Each pattern offers
its tokens once per repetition, a repetition costing more than the one before (a convex cost), and each source asks
for its target. The flow says how many tokens of each pattern are taken, and from it which documents: all of them
for every full repetition, and a seeded choice of whole documents for the rest.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grantflow.functions.ordered import with_running
from grantflow.functions.skew import bounded_broadcast
from grantflow.session import cut, literal_table

from .common import WORD

#: So many times the size of its largest document a pattern leaves to the filling of its gap.
RESERVED = 2

#: Documents times words of gap up to which the best set for a gap is sought.
EXACT = 1 << 26

#: Buckets of the seeded order of a pattern; each is ranked by itself.
ORDER_BUCKETS = 4096


def word_count(text: Column) -> Column:
    """Number of words; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def capped_targets(sizes: dict, weights: dict, share: float, most: float) -> dict:
    """Divide ``share`` of all tokens by weight; no source above ``most`` times its size, the excess is reshared."""
    total = share * sum(sizes.values())
    targets, open_, left = {}, set(sizes), total
    while open_:
        weight = sum(weights[s] for s in open_)
        full = {s for s in open_ if left * weights[s] / weight > most * sizes[s]}
        if not full:
            targets |= {s: left * weights[s] / weight for s in open_}
            break
        targets |= {s: most * sizes[s] for s in full}
        left -= sum(most * sizes[s] for s in full)
        open_ -= full
    return targets


def min_cost_flow(
    capacity: dict, members: dict, quota: dict, repeats: int, cost: Callable[[int], float]
) -> dict[tuple, int]:
    """Tokens routed from patterns to sources: ``{(pattern, source): tokens}``.

    ``capacity`` holds tokens per pattern, ``members`` the sources of each pattern, ``quota`` the tokens asked for
    per source; repetition ``k`` of a token costs ``cost(k)``, which must not fall with ``k``. Successive shortest
    paths with potentials over integer capacities: the flow is the largest possible and of least cost among those.
    """
    head: dict = {}
    edges: list[list] = []

    def arc(a, b, room, price):
        head.setdefault(a, []).append(len(edges))
        edges.append([b, room, price])
        head.setdefault(b, []).append(len(edges))
        edges.append([a, 0, -price])

    for p in sorted(capacity):
        for k in range(repeats):
            arc("from", ("p", p), capacity[p], cost(k))
        for s in sorted(members[p]):
            arc(("p", p), ("s", s), capacity[p] * repeats, 0.0)
    for s in sorted(quota):
        arc(("s", s), "to", quota[s], 0.0)
    potential = dict.fromkeys(head, 0.0)
    while True:
        best, via, queue, tie = {"from": 0.0}, {}, [(0.0, 0, "from")], 0
        while queue:
            far, _, node = heapq.heappop(queue)
            if far > best[node] + 1e-12:
                continue
            for e in head.get(node, ()):
                to, room, price = edges[e]
                step = far + price + potential[node] - potential[to]
                if room > 0 and step < best.get(to, float("inf")) - 1e-12:
                    best[to], via[to] = step, e
                    tie += 1
                    heapq.heappush(queue, (step, tie, to))
        if "to" not in best:
            break
        for node in potential:
            potential[node] += min(best.get(node, best["to"]), best["to"])
        path, node = [], "to"
        while node != "from":
            path.append(via[node])
            node = edges[via[node] ^ 1][0]
        room = min(edges[e][1] for e in path)
        for e in path:
            edges[e][1] -= room
            edges[e ^ 1][1] += room
    flow = {}
    for p in capacity:
        for e in head.get(("p", p), ()):
            to = edges[e][0]
            if e % 2 == 0 and edges[e ^ 1][1]:
                flow[(p, to[1])] = edges[e ^ 1][1]
    return flow


def mix(
    docs: DataFrame,
    sources: Column,
    size: Column,
    weights: Callable[[list], dict],
    *,
    share: float = 1.5,
    repeats: int = 2,
    seed: int = 42,
    carry: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """Take documents so that each source comes near its share of the tokens.

    ``sources`` is an array of source names (null stands for "no source" and is a source too), ``size`` the tokens
    of a document; ``weights(names)`` gives every source its weight. Returns ``carry`` columns, ``size``,
    ``sources``, ``source_size``, ``target`` (of the document's first source) and ``copies`` (0 to ``repeats``).

    Every document is used for all full repetitions of its pattern; the rest is chosen in a seeded order of
    documents up to a gap of about two of the largest document, which those after them fill (``fill_gaps``).
    Documents with equal id, size and sources are interchangeable. Documents without tokens are never taken.
    An empty table gives an empty result. The pattern table, one row per set of sources, goes to the driver.
    """
    spark = docs.sparkSession
    columns = [c for c in carry if c in docs.columns]
    base = cut(docs.select(
        *columns, size.cast("long").alias("size"),
        F.to_json(F.struct(F.sort_array(F.array_distinct(sources)).alias("s")), {"ignoreNullFields": "false"}).alias("pattern"),
        F.pmod(F.xxhash64(*columns, F.lit(seed)), F.lit(1 << 40)).alias("_h"),
    ))
    read = F.from_json("pattern", "s array<string>")["s"]
    grouped = base.groupBy("pattern").agg(F.sum("size").alias("n"), F.max("size").alias("most"))
    found, most = [], {}
    for p, s, n, m in grouped.select("pattern", read, "n", "most").collect():
        found.append((p, list(s or []), int(n)))
        most[p] = int(m)
    order = sorted({s for _, ss, _ in found for s in ss}, key=lambda s: (s is None, s or ""))
    number = {s: i for i, s in enumerate(order)}
    sizes = {i: 0 for i in number.values()}
    for _, ss, n in found:
        for s in ss:
            sizes[number[s]] += n
    capacity = {p: n for p, _, n in found}
    weight = {number[s]: w for s, w in weights(order).items()}
    scale = sum(capacity.values()) / max(1, sum(sizes.values()))
    total = capped_targets(sizes, weight, share * scale, repeats)
    flow = min_cost_flow(capacity, {p: {number[s] for s in ss} for p, ss, _ in found},
                         {i: int(round(t)) for i, t in total.items()}, repeats, lambda k: float(k * k + k))
    taken: dict = {}
    for (p, _), n in flow.items():
        taken[p] = taken.get(p, 0) + n
    plan = []
    for i, (p, ss, n) in enumerate(sorted(found)):
        full, rest = divmod(taken.get(p, 0), n) if n else (0, 0)
        first = number[min(ss, key=lambda s: (s is None, s or ""))] if ss else -1
        plan.append((p, i, full, rest, max(0, rest - RESERVED * most[p]), sizes.get(first, 0), float(total.get(first, 0.0))))
    patterns = len(plan)
    plan = literal_table(spark, plan, "pattern string, _p int, full int, rest long, _first long, source_size long, target double")
    rows = base.join(plan, "pattern")
    bucket = F.shiftright("_h", 40 - ORDER_BUCKETS.bit_length() + 1)
    ranked = with_running(rows, ["_p"], ["_h", *columns, "size"], {"_upto": ("sum", F.col("size"))}, bucket)
    inside = F.col("_upto") <= F.col("_first")
    gap = (
        ranked.groupBy("_p").agg(F.max(F.when(inside, F.col("_upto"))).alias("_got"), F.first("rest").alias("_rest"))
        .select(F.col("_p").alias("_g"), (F.col("_rest") - F.coalesce("_got", F.lit(0))).alias("_gap"))
    )
    left = ranked.where(~inside & (F.col("size") > 0)).join(bounded_broadcast(gap, patterns), F.col("_p") == F.col("_g")).drop("_g")
    chosen = fill_gaps(left.select("_p", "_h", *columns, "size", "_upto", "_gap"), ["_h", *columns, "size"], bucket)
    out = ranked.join(chosen, ["_p", "_upto"], "left")
    copies = F.when(F.col("size") == 0, 0).otherwise(F.col("full") + F.when(inside | F.col("_chosen"), 1).otherwise(0))
    return out.select(*columns, "size", read.alias("sources"), "source_size", "target", copies.cast("int").alias("copies"))


def nearest_sum(sizes: list[int], gap: int) -> list[int]:
    """Places of the sizes whose sum comes nearest to ``gap`` (below it of two equally near), by bits of possible sums."""
    mask = (1 << 2 * gap + 1) - 1
    possible = [1]
    for size in sizes:
        possible.append((possible[-1] | possible[-1] << size) & mask)
    raw = np.frombuffer(possible[-1].to_bytes(2 * gap // 8 + 1, "little"), np.uint8)
    sums = np.flatnonzero(np.unpackbits(raw, bitorder="little"))
    left = int(sums[np.argmin(np.abs(sums - gap))])
    out = []
    for i in range(len(sizes) - 1, -1, -1):
        if not possible[i] >> left & 1:
            out.append(i)
            left -= sizes[i]
    return out


def fill_gaps(left: DataFrame, order: list[str], bucket: Column) -> DataFrame:
    """Documents that go into the gap of their pattern, as ``(_p, _upto, _chosen)``.

    ``left`` has the documents not taken, with their ``size``, the ``_gap`` of their pattern and ``_upto``, which tells
    those of a pattern apart. They are gone through by size class, large ones first, and in the given order inside a
    class; each that fits what is left of the gap is taken. Of a class only documents up to the gap's size can fit, so
    few of each pattern reach the task that goes through them: their sizes add up to a gap in each class, a gap being
    at most three of the pattern's largest document. Once what is left of the gap is small enough, the set that comes nearest to it is chosen,
    over or under it.
    """
    fitting = left.where("size <= _gap").withColumn("_class", F.floor(F.log2("size")).cast("int"))
    fitting = with_running(fitting, ["_p", "_class"], order, {"_in_class": ("sum", F.col("size"))}, bucket)
    fitting = fitting.where(F.col("_in_class") - F.col("size") < F.col("_gap")).select("_p", "_class", "_in_class", "size", "_upto", "_gap")
    over = left.where("size > _gap and size < 2 * _gap").groupBy("_p", "_gap").agg(F.min(F.struct("size", "_upto")).alias("s"))
    over = over.select("_p", F.lit(99).alias("_class"), F.lit(0).cast("long").alias("_in_class"), "s.size", "s._upto", "_gap")

    def fill(rows):
        rows = rows.sort_values(["_class", "_in_class"], ascending=[False, True])
        gap, taken, other = int(rows["_gap"].iloc[0]), [], []
        exact = len(rows) * gap <= EXACT
        for size, upto in zip(rows["size"].tolist(), rows["_upto"].tolist()):
            if size <= gap and not exact:
                gap -= size
                exact = len(rows) * gap <= EXACT
                taken.append(upto)
            else:
                other.append((size, upto))
        other = [x for x in other if x[0] < 2 * gap]
        taken += [other[i][1] for i in nearest_sum([size for size, _ in other], gap)]
        return rows.loc[rows["_upto"].isin(taken), ["_p", "_upto"]].assign(_chosen=True)

    return fitting.unionByName(over).groupBy("_p").applyInPandas(fill, "_p int, _upto long, _chosen boolean")


def cycle_weights(names: list, cycle: tuple[int, ...] = (5, 2, 1)) -> dict:
    """Weights 5, 2, 1, repeating, in the given order of the sources."""
    return {s: cycle[i % len(cycle)] for i, s in enumerate(names)}


def repeat_rows(docs: DataFrame, copies: Column) -> DataFrame:
    """Each row as often as ``copies`` says."""
    return docs.withColumn("_copy", F.explode(F.sequence(F.lit(0), copies))).where(F.col("_copy") > 0).drop("_copy")


