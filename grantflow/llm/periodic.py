"""Periodic runs of words, found by branching tandem repeats in an enhanced suffix array.

The words of many documents are numbered and lie in one flat array; suffixes are compared inside their document only.
The suffix array comes from prefix doubling, LCP values from the kept ranks of the doublings. An interval of equal
leading ``l`` words is given by the nearest smaller LCP values on both sides, its children by the places of ``l`` in
it, so no tree is built. For each interval the suffixes ``i`` of all children but the largest ask the inverse array
whether ``i + l`` or ``i - l`` lies in the interval too, but in another child. Then two equal stretches of ``l`` words
stand side by side and the words after them differ: the last square of a run of period ``l``. Rotating it to the left
while the words ``l`` apart agree gives the whole run. Of squares with one end, those are left out whose period is a
multiple of that of a run that covers them.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import WORD, ranges, text_blocks

WORDS = re.compile(WORD)

#: Words compared in one go while squares are rotated.
COMPARED = 1 << 20

#: Pairs of suffix and interval asked in one go.
ASKED = 1 << 21

RUN = "array<struct<start: bigint, length: bigint, period: bigint>>"
COLUMNS = {
    "n_words": "bigint", "n_runs": "bigint", "start": "bigint", "length": "bigint", "period": "bigint", "exponent_milli": "bigint",
    "runs": RUN, "runs_sha256": "string", "collapsed": "string", "collapsed_sha256": "string",
}


class Suffixes(NamedTuple):
    """Suffix array of several documents in a row, its inverse, and LCP with the suffix before (0 at borders)."""

    order: np.ndarray
    place: np.ndarray
    lcp: np.ndarray


def suffix_array(words: np.ndarray, doc: np.ndarray) -> Suffixes:
    """Sort all suffixes by document, then by words; a document's end sorts before any word."""
    n = len(words)
    if not n:
        none = np.zeros(0, np.int64)
        return Suffixes(none, none, none)
    end = np.append(np.flatnonzero(doc[1:] != doc[:-1]) + 1, n)[np.cumsum(np.append(0, doc[1:] != doc[:-1]))]
    key = np.cumsum(np.append(0, doc[1:] != doc[:-1])) * (int(words.max()) + 1) + words
    order = np.argsort(key)
    place = np.empty(n, np.int64)
    first = np.append(True, key[order][1:] != key[order][:-1])
    place[order] = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    alone = first & np.append(first[1:], True)
    open_ = order[~alone]
    levels, width = [], 1
    while len(open_):
        at = np.sort(open_)
        levels.append((width, at, place[at]))
        follow = open_ + width
        inside = follow < end[open_]
        second = np.where(inside, place[np.where(inside, follow, 0)] + 1, 0)
        group = place[open_]
        by = np.argsort(group * (n + 1) + second)
        open_, group, second = open_[by], group[by], second[by]
        heads = np.append(True, group[1:] != group[:-1])
        inner = np.arange(len(open_)) - np.maximum.accumulate(np.where(heads, np.arange(len(open_)), 0))
        order[group + inner] = open_
        fresh = heads | np.append(True, second[1:] != second[:-1])
        place[open_] = (group + inner)[np.maximum.accumulate(np.where(fresh, np.arange(len(open_)), 0))]
        open_ = open_[~(fresh & np.append(fresh[1:], True))]
        width *= 2
    lcp = np.zeros(n, np.int64)
    pair = np.flatnonzero(doc[order[1:]] == doc[order[:-1]]) + 1
    a, b = order[pair - 1].copy(), order[pair].copy()
    limit = end[b]
    rank = np.empty(n, np.int64)
    for width, at, ranks in reversed(levels):
        rank[:] = np.arange(n) + n
        rank[at] = ranks
        # Past the end of its document a suffix is empty and agrees with nothing.
        inside = np.maximum(a, b) < limit
        same = np.zeros(len(a), bool)
        same[inside] = rank[a[inside]] == rank[b[inside]]
        a[same] += width
        b[same] += width
        lcp[pair[same]] += width
    return Suffixes(order, place, lcp)


def nearest_smaller(values: np.ndarray) -> np.ndarray:
    """Index of the last smaller value before each one, -1 where there is none: up and down a pyramid of minima."""
    n = len(values)
    most = np.iinfo(np.int64).max
    pyramid = [values]
    while len(pyramid[-1]) > 1:
        below = pyramid[-1]
        below = np.append(below, most) if len(below) % 2 else below
        pyramid.append(np.minimum(below[::2], below[1::2]))
    found = np.full(n, -1, np.int64)
    level_of = np.zeros(n, np.int64)
    asking, node = np.arange(n), np.arange(n)
    for level, minima in enumerate(pyramid):
        right = node % 2 == 1
        hit = np.zeros(len(node), bool)
        hit[right] = minima[node[right] - 1] < values[asking[right]]
        found[asking[hit]] = node[hit] - 1
        level_of[asking[hit]] = level
        asking, node = asking[~hit], node[~hit] >> 1
    for level in range(len(pyramid) - 1, 0, -1):
        i = np.flatnonzero((level_of == level) & (found >= 0))
        if not len(i):
            continue
        minima = pyramid[level - 1]
        right = 2 * found[i] + 1
        inside = right < len(minima)
        smaller = np.zeros(len(i), bool)
        smaller[inside] = minima[right[inside]] < values[i[inside]]
        found[i] = right - ~smaller
        level_of[i] = level - 1
    return found


def branching_squares(suffixes: Suffixes, doc: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and period of all squares whose next word differs, of intervals of at least ``least`` suffixes."""
    order, place, lcp = suffixes
    n = len(order)
    none = np.zeros(0, np.int64)
    if not n:
        return none, none
    left = nearest_smaller(lcp)
    right = n - 1 - nearest_smaller(lcp[::-1])[::-1]
    # An interval's depth stands between any two of its children; these places are its splits, in order.
    split = np.flatnonzero((lcp > 0) & (right - left >= least))
    if not len(split):
        return none, none
    left, right = left[split], right[split]
    by = np.argsort(left * (n + 1) + right, kind="stable")
    split, left, right = split[by], left[by], right[by]
    heads = np.append(True, (left[1:] != left[:-1]) | (right[1:] != right[:-1]))
    interval = np.cumsum(heads) - 1
    lows, highs, depth = left[heads], right[heads], lcp[split[heads]]
    # Children: from the interval's begin to its first split, between splits, and from the last one to its end.
    child_from = np.concatenate([lows, split])
    child_of = np.concatenate([np.arange(len(lows)), interval])
    by = np.argsort(child_of * (n + 1) + child_from)
    child_from, child_of = child_from[by], child_of[by]
    child_to = np.append(child_from[1:], 0)
    last = np.append(child_of[1:] != child_of[:-1], True)
    child_to[last] = highs[child_of[last]]
    size = child_to - child_from
    by = np.argsort(child_of * (n + 1) + n - size)
    largest = by[np.append(True, child_of[by][1:] != child_of[by][:-1])]
    small = np.ones(len(size), bool)
    small[largest] = False
    child_from, child_to, child_of, size = child_from[small], child_to[small], child_of[small], size[small]
    starts, periods = [], []
    ends = np.cumsum(size)
    begin = 0
    while begin < len(size):
        stop = max(begin + 1, int(np.searchsorted(ends, (ends[begin - 1] if begin else 0) + ASKED, "right")))
        piece = slice(begin, stop)
        begin = stop
        times = size[piece]
        i = order[ranges(child_from[piece], times)]
        low, high, l = (np.repeat(x[child_of[piece]], times) for x in (lows, highs, depth))
        own_from, own_to = np.repeat(child_from[piece], times), np.repeat(child_to[piece], times)
        for other, first in ((i + l, i), (i - l, i - l)):
            inside = np.flatnonzero((other >= 0) & (other < n))
            at = place[other[inside]]
            ok = (at >= low[inside]) & (at < high[inside]) & ((at < own_from[inside]) | (at >= own_to[inside]))
            starts.append(first[inside][ok])
            periods.append(l[inside][ok])
    found = np.unique(np.stack([np.concatenate(starts), np.concatenate(periods)]), axis=1)
    return found[0], found[1]


def rotate(words: np.ndarray, first: np.ndarray, start: np.ndarray, period: np.ndarray) -> np.ndarray:
    """How far each square moves to the left, at most to ``first``, while words ``period`` apart agree."""
    moved = np.zeros(len(start), np.int64)
    active, step = np.arange(len(start)), 32
    while len(active):
        later = []
        rows = max(1, COMPARED // step)
        for k in range(0, len(active), rows):
            part = active[k : k + rows]
            at = (start[part] - moved[part])[:, None] - 1 - np.arange(step)
            inside = at >= first[part][:, None]
            at[~inside] = 0
            same = inside & (words[at] == words[at + period[part][:, None]])
            agree = np.where(same.all(1), step, np.argmin(same, 1))
            moved[part] += agree
            later.append(part[agree == step])
        active = np.concatenate(later)
        if len(active):
            step = min(max(step, COMPARED // len(active)), 2 * step)
    return moved


def runs_of(words: np.ndarray, doc: np.ndarray, min_length: int, min_exponent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and smallest period of all runs, by start, then period; ``doc`` rises along the words.

    A run is at least ``min_length`` words long and ``min_exponent`` (two or more) times its period.
    """
    start, period = branching_squares(suffix_array(words, doc), doc, min_exponent)
    first_of = np.maximum.accumulate(np.where(np.append(True, doc[1:] != doc[:-1]), np.arange(len(doc)), 0)) if len(doc) else doc
    end = start + 2 * period
    by = np.lexsort((period, end))
    start, period, end = start[by], period[by], end[by]
    out = []
    while len(start):
        heads = np.append(True, end[1:] != end[:-1])
        s, q, e = start[heads], period[heads], end[heads]
        length = e - s + rotate(words, first_of[s], s, q)
        out.append(np.stack([e - length, length, q]))
        owner = np.cumsum(heads) - 1
        left = ~heads & ~((period % q[owner] == 0) & (2 * period <= length[owner]))
        start, period, end = start[left], period[left], end[left]
    if not out:
        none = np.zeros(0, np.int64)
        return none, none, none
    found = np.concatenate(out, axis=1)
    found = found[:, found[1] >= np.maximum(min_length, min_exponent * found[2])]
    return tuple(found[:, np.lexsort((found[2], found[0]))])


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int]:
    """The run of greatest length by period; the first by start, then period, of equal ones."""
    best = runs[0]
    for run in runs:
        if run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def find_runs(docs: DataFrame, outputs: tuple[str, ...] = ("n_words", "runs", "collapsed"), text: str = "text",
              min_length: int = 6, min_exponent: int = 4) -> DataFrame:
    """Runs of repeating words in every text, and the text without their repeats.

    Words are what stands between ASCII white space. Keeps all other columns and adds ``outputs``: ``n_words``;
    ``runs`` (start word, length and smallest period of each, by start, then period); ``n_runs``; ``start``,
    ``length``, ``period`` and ``exponent_milli`` of the run of greatest length by period (null without runs);
    ``collapsed``, the words joined by one space without those that any run contains after its first period; and
    digests of the runs as ``start,length,period`` lines and of the collapsed text. Null and empty texts have no words
    and no runs. Each row is worked on by itself, so repeated rows give repeated results; columns of the same names are
    replaced. One document is one step, of some 200 bytes a word.
    """
    keep = [c for c in docs.columns if c.lower() not in {text.lower(), *outputs}]
    source = docs.select(*keep, text)
    made = T.StructType.fromDDL(", ".join(f"{name} {COLUMNS[name]}" for name in outputs))
    schema = T.StructType([*docs.select(*keep).schema, *made])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_blocks(batches, text):
            rows = [WORDS.findall(t or "") for t in batch.column(text).to_pylist()]
            numbers: dict[str, int] = {}
            words = np.fromiter((numbers.setdefault(w, len(numbers)) for row in rows for w in row), np.int64)
            sizes = np.array([len(row) for row in rows], np.int64)
            doc = np.repeat(np.arange(len(rows)), sizes)
            start, length, period = runs_of(words, doc, min_length, min_exponent)
            begins = np.append(0, np.cumsum(sizes))
            change = np.zeros(len(words) + 1, np.int64)
            np.add.at(change, start + period, 1)
            np.add.at(change, start + length, -1)
            keep_word = np.cumsum(change)[:-1] == 0
            owner = doc[start]
            bounds = np.searchsorted(owner, np.arange(len(rows) + 1)).tolist()
            flat = list(zip((start - begins[owner]).tolist(), length.tolist(), period.tolist()))
            found = [flat[a:b] for a, b in zip(bounds, bounds[1:])]
            columns: dict = {"n_words": sizes, "n_runs": np.diff(bounds)}
            if {"start", "length", "period", "exponent_milli"} & set(outputs):
                best = [strongest(r) if r else (None, None, None) for r in found]
                columns |= {name: pa.array([b[i] for b in best], pa.int64()) for i, name in enumerate(("start", "length", "period"))}
                columns["exponent_milli"] = pa.array([b[1] * 1000 // b[2] if b[2] else None for b in best], pa.int64())
            if "runs" in outputs:
                fields = [pa.field(name, pa.int64()) for name in ("start", "length", "period")]
                values = pa.StructArray.from_arrays([start - begins[owner], length, period], fields=fields)
                columns["runs"] = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), values)
            if "runs_sha256" in outputs:
                columns["runs_sha256"] = [hashlib.sha256("".join("%d,%d,%d\n" % x for x in r).encode()).hexdigest() for r in found]
            if {"collapsed", "collapsed_sha256"} & set(outputs):
                texts = []
                for row, a in zip(rows, begins.tolist()):
                    kept = keep_word[a : a + len(row)]
                    texts.append(" ".join(row if kept.all() else [row[i] for i in np.flatnonzero(kept)]))
                columns["collapsed"] = texts
                if "collapsed_sha256" in outputs:
                    columns["collapsed_sha256"] = [hashlib.sha256(t.encode()).hexdigest() for t in texts]
            given = [batch.column(c) for c in keep] + [columns[c] for c in outputs]
            yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in given], names=[*keep, *outputs])

    return source.mapInArrow(run, schema)
