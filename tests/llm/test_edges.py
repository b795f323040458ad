"""Equal ids, colliding hashes, large gaps: cases where the plain form of an operator costs too much or misses."""

import random
import time

import numpy as np
from pyspark.sql import functions as F

from grantflow.llm import mixing, suffixes

from . import brute


def test_rows_of_one_id_cost_no_more_than_others(spark):
    rng = random.Random(8)
    shared = "".join(rng.choice("abcdefgh ") for _ in range(150))
    texts = [("".join(rng.choice("abcdefgh ") for _ in range(120)) + shared) for _ in range(3000)] + [shared] * 1500 + [""] * 500
    took = {}
    for name, ids in (("own", range(len(texts))), ("null", [None] * len(texts))):
        df = spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string").repartition(4).cache()
        df.count()
        start = time.time()
        out = suffixes.remove_repeats(df).select("n_bytes", "n_removed", F.length("kept").alias("left")).collect()
        took[name] = time.time() - start
        assert all(r["n_bytes"] == r["n_removed"] + r["left"] for r in out)
        # Of the shared passage one copy stays, whatever the ids are.
        assert sum(r["n_removed"] >= 150 for r in out) == 3000 + 1500 - 1
    assert took["null"] < 4 * took["own"] + 5


def test_strings_of_hot_leads_are_told_apart_by_two_hashes(spark, monkeypatch):
    """With a first hash that is the same for all strings the second one still decides."""
    rng = random.Random(9)
    lead = "".join(rng.choice("xyz ") for _ in range(60))
    texts = [lead + "".join(rng.choice("xyz ") for _ in range(90)) for _ in range(40)]
    texts += texts[:5]
    flat = np.frombuffer("".join(texts).encode(), np.uint8)
    start = np.arange(len(texts)) * 150
    one, two = (suffixes.Hashes(flat, k).of(start, 150) for k in (0, 1))
    assert len(set(one.tolist())) == len(set(two.tolist())) == 40
    assert len(set((one ^ two).tolist())) == 40
    monkeypatch.setattr(suffixes, "HOT_ROWS", 0)
    monkeypatch.setattr(suffixes, "HOT_SAMPLE", 1)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = suffixes.remove_repeats(df).orderBy("doc_id").collect()
    want = brute.without_repeats([t.encode() for t in texts])
    assert [(r["n_removed"], len(r["removed"]), bytes(r["kept"])) for r in rows] == want


def least_gap(sizes, rest):
    """The smallest distance from ``rest`` that any set of the sizes can have."""
    sums = 1
    for s in sizes:
        sums |= sums << s
    return min(abs(k - rest) for k in range(2 * rest + 1) if sums >> k & 1)


def test_one_huge_document_leaves_no_gap(spark):
    for huge_id in (0, 17, 500, 999, 5000):
        rows = [(i, 10) for i in range(1000) if i != huge_id] + [(huge_id, 10_000)]
        docs = spark.createDataFrame(rows, "doc_id long, words long").withColumn("source", F.lit("a"))
        out = mixing.mix(docs, F.array("source"), F.col("words"), mixing.cycle_weights).collect()
        target = 1.5 * sum(n for _, n in rows)
        assert abs(sum(r["size"] * r["copies"] for r in out) - target) <= 10


def independent_targets(sizes, weights, share, most):
    """Raise a common level in small steps of what is left; a source stops at its cap."""
    level = lambda x: sum(min(x * weights[s], most * sizes[s]) for s in sizes)
    low, high, total = 0.0, 1e12, min(share * sum(sizes.values()), most * sum(sizes.values()))
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if level(middle) < total else (low, middle)
    return {s: min(high * weights[s], most * sizes[s]) for s in sizes}


def test_sources_come_as_near_as_any_choice(spark):
    rng = random.Random(10)
    for trial in range(4):
        rows = [(i, rng.choice("abcd"), int(rng.choice([1, 3, 10, 200, 900]) * (1 + rng.random() * trial))) for i in range(60)]
        docs = spark.createDataFrame(rows, "doc_id long, source string, words long")
        out = mixing.mix(docs, F.array("source"), F.col("words"), mixing.cycle_weights).collect()
        sizes = {s: sum(n for _, x, n in rows if x == s) for s in sorted({x for _, x, _ in rows})}
        weights = dict(zip(sorted(sizes), (5, 2, 1, 5)))
        targets = independent_targets(sizes, weights, 1.5, 2)
        for s, size in sizes.items():
            mine = [r for r in out if r["sources"] == [s]]
            assert abs(mine[0]["target"] - targets[s]) < 1e-3 * size and mine[0]["source_size"] == size
            taken = sum(r["size"] * r["copies"] for r in mine)
            rest = int(round(targets[s])) % size
            assert abs(taken - targets[s]) <= max(0.01 * targets[s], least_gap([n for _, x, n in rows if x == s], rest) + 1)
            assert all(0 <= r["copies"] <= 2 for r in mine)


def test_nearest_sums():
    rng = random.Random(11)
    for _ in range(200):
        sizes = [rng.randrange(1, 40) for _ in range(rng.randrange(9))]
        gap = rng.randrange(1, 80)
        chosen = mixing.nearest_sum(sizes, gap)
        assert len(set(chosen)) == len(chosen) and abs(sum(sizes[i] for i in chosen) - gap) == least_gap(sizes, gap)


def test_gap_of_nothing_and_of_unfitting_documents(spark):
    for sizes in ([], [0, 0], [7], [5, 5, 5], [100, 1]):
        docs = spark.createDataFrame([(i, n) for i, n in enumerate(sizes)], "doc_id long, words long").withColumn("source", F.lit(None).cast("string"))
        out = mixing.mix(docs, F.array("source"), F.col("words"), mixing.cycle_weights).collect()
        assert len(out) == len(sizes) and all(0 <= r["copies"] <= 2 for r in out)
        if sum(sizes):
            assert abs(sum(r["size"] * r["copies"] for r in out) - 1.5 * sum(sizes)) <= max(sizes) / 2 + 1
