"""Periodic runs, SentencePiece and whitening against plain versions, on the small tables and on odd ones."""

import hashlib
import math
import random
import re
import struct
import zlib

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

from grantflow.llm import periodic, pieces, whitening
from grantflow.llm.queries import QUERIES, vocabulary

from ..conftest import SMALL
from .test_operators import DOCS, odd_rows

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
MODEL = "piece_bpe_32k.model"


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), DOCS).repartition(3).cache()


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()


def plain_runs(words, min_length=6, min_exponent=4):
    """Every maximal stretch for every period by comparing all words; the first period of a stretch is its smallest."""
    found = {}
    for q in range(1, len(words) // min_exponent + 1):
        i = 0
        while i + q < len(words):
            if words[i] == words[i + q]:
                s = i
                while i + q < len(words) and words[i] == words[i + q]:
                    i += 1
                if i - s >= q:
                    found.setdefault((s, i + q), q)
            i += 1
    return sorted((s, e - s, q) for (s, e), q in found.items() if e - s >= max(min_length, min_exponent * q))


def collapsed(words, runs):
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def repeating(rng):
    words = [str(rng.randrange(rng.choice([1, 2, 3, 20]))) for _ in range(rng.randrange(50))]
    unit = [str(rng.randrange(3)) for _ in range(rng.randrange(1, 6))]
    at = rng.randrange(len(words) + 1)
    words = words[:at] + unit * rng.randrange(2, 9) + unit[: rng.randrange(len(unit))] + words[at:]
    return words * rng.choice([1, 1, 1, 4])


@pytest.mark.parametrize("least", [(6, 4), (1, 2), (5, 3)])
def test_runs_are_all_found(least):
    rng = random.Random(sum(least))
    docs = [repeating(rng) for _ in range(400)] + [[]] * 3 + [["a"] * 5, ["a"] * 6, ["a"] * 300, ["a", "b"] * 100]
    numbers = {}
    words = np.array([numbers.setdefault(w, len(numbers)) for d in docs for w in d], np.int64)
    begins = np.append(0, np.cumsum([len(d) for d in docs]))
    doc = np.repeat(np.arange(len(docs)), np.diff(begins))
    got = [[] for _ in docs]
    for s, length, q in zip(*periodic.runs_of(words, doc, *least)):
        got[doc[s]].append((int(s - begins[doc[s]]), int(length), int(q)))
    assert got == [plain_runs(d, *least) for d in docs]


def test_runs_of_a_long_text_end():
    word = [0], [0, 1]
    while len(word[1]) < 60_000:
        word = word[1], word[1] + word[0]
    for words in (np.zeros(200_000, np.int64), np.array(word[1]), np.arange(200_000) % 7):
        periodic.runs_of(words, np.zeros(len(words), np.int64), 6, 4)


def planted(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def test_run_query(spark, documents):
    rows = {r["doc_id"]: r for r in QUERIES["op11_periodic_runs"](spark, SMALL).collect()}
    assert len(rows) == len(documents)
    with_runs = 0
    for d in documents:
        words = planted(d["doc_id"], WORDS.findall(d["text"] or ""))
        runs = plain_runs(words) if len(words) < 1500 else None
        r = rows[d["doc_id"]]
        if runs is None:
            continue
        best = min(runs, key=lambda x: (-x[1] / x[2], x[0], x[2]), default=(None,) * 3)
        with_runs += bool(runs)
        assert (r["n_runs"], (r["start"], r["length"], r["period"])) == (len(runs), best)
        assert r["exponent_milli"] == (1000 * best[1] // best[2] if runs else None)
        assert r["runs_sha256"] == sha("".join("%d,%d,%d\n" % x for x in runs))
        assert r["collapsed_sha256"] == sha(collapsed(words, runs))
    assert with_runs > 10


def test_runs_on_odd_rows(spark, odd):
    both = [(1, "go " * 9 + "on", "x", 1), (None, None, "x", 2), (3, "", None, 3), (3, "a b a b a b a b", None, 3), (3, "a b a b a b a b", None, 3)]
    table = spark.createDataFrame(both, "doc_id long, text string, runs string, n_words long")
    rows = periodic.find_runs(table).collect()
    assert sorted((r["n_words"], r["collapsed"], [tuple(x) for x in r["runs"]]) for r in rows) == [
        (0, "", []), (0, "", []), (8, "a b", [(0, 8, 2)]), (8, "a b", [(0, 8, 2)]), (10, "go on", [(0, 9, 1)])]
    out = periodic.find_runs(odd, ("n_words", "collapsed")).collect()
    assert len(out) == odd.count() and {"score", "_id", "fp", "size"} <= set(out[0].asDict())
    assert all(r["n_words"] >= len(WORDS.findall(r["collapsed"])) for r in out)
    assert periodic.find_runs(odd.limit(0)).count() == 0


def test_equal_strength_goes_to_the_first():
    assert periodic.strongest([(0, 8, 2), (20, 4, 1), (30, 9, 2), (50, 18, 4)]) == (30, 9, 2)


def library():
    return sentencepiece.SentencePieceProcessor(model_file=vocabulary(MODEL))


def odd_texts():
    rng = random.Random(2)
    letters = [*"the in on at er", "▁", "é", "的", "\U0001f600", "\x01", "\x00", "́", " "]
    texts = ["", " ", "▁a▁▁b", "<s>hi</s> <0x41>", "a\n\nb ", " " * 300, "a" * 700, "x" + " " * 100 + "y", "的中文" * 300, "abc" * 500]
    texts += [" " * k + "z" for k in range(40)]
    texts += ["".join(rng.choice(letters) for _ in range(rng.randrange(300))) for _ in range(200)]
    return texts + ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(0xA0, 0x2FF), 0x20, 0x2581, rng.randrange(0x3040, 0x9FFF)])) for _ in range(200)) for _ in range(100)]


def test_pieces_as_the_library_has_them(monkeypatch):
    sp, texts = library(), odd_texts()
    for window in (pieces.WINDOW, 40):
        monkeypatch.setattr(pieces, "WINDOW", window)
        ids, decoded = pieces.Encoder(pieces.pieces(vocabulary(MODEL))).encode(texts)
        assert [[int(i) for part in x for i in part] for x in ids] == [sp.encode(t) for t in texts]
        assert ["".join(x) for x in decoded] == [sp.decode(sp.encode(t, add_bos=True, add_eos=True)) for t in texts]


def test_piece_table_is_started_anew(monkeypatch):
    texts = odd_texts()
    whole = pieces.Encoder(pieces.pieces(vocabulary(MODEL))).encode(texts)
    monkeypatch.setattr(pieces, "TABLE_CHUNKS", 50)
    monkeypatch.setattr(pieces, "JOINED", 30)
    again = pieces.Encoder(pieces.pieces(vocabulary(MODEL))).encode(texts)
    assert [[int(i) for p in x for i in p] for x in whole[0]] == [[int(i) for p in x for i in p] for x in again[0]]
    assert ["".join(x) for x in whole[1]] == ["".join(x) for x in again[1]]


def test_piece_query(spark, documents):
    sp = library()
    rows = {r["doc_id"]: r for r in QUERIES["op12_sentencepiece"](spark, SMALL).collect()}
    assert len(rows) == len(documents)
    for d in documents:
        ids = sp.encode(d["text"] or "", add_bos=True, add_eos=True)
        r = rows[d["doc_id"]]
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (len(ids), sha(struct.pack(f"<{len(ids)}I", *ids)), sha(sp.decode(ids)))


def test_pieces_on_odd_rows(spark, odd):
    sp = library()
    clash = odd.withColumn("ids", F.lit("x")).withColumn("n_tokens", F.lit(None).cast("string"))
    rows = pieces.encode(clash.withColumn("same", F.col("text")), vocabulary(MODEL), ("n_tokens", "ids", "decoded")).collect()
    assert len(rows) == odd.count()
    for r in rows:
        assert r["ids"] == sp.encode(r["same"] or "", add_bos=True, add_eos=True) and r["n_tokens"] == len(r["ids"])
        assert r["decoded"] == (r["same"] or "")
    assert pieces.encode(odd.limit(0), vocabulary(MODEL)).count() == 0
    bare = pieces.encode(odd, vocabulary(MODEL), ("n_tokens",), begin=False, end=False)
    assert bare.where("n_tokens = 0").count() == odd.where("coalesce(text, '') = ''").count()


def test_models_that_cannot_be_cut_are_refused(tmp_path):
    def field(number, value):
        if isinstance(value, int):
            return bytes([number << 3 & 127 | (128 if number > 15 else 0)]) + (bytes([number >> 4]) if number > 15 else b"") + bytes([value])
        return bytes([number << 3 | 2, len(value)]) + value

    piece = lambda text: field(1, field(1, text.encode()))
    path = tmp_path / "crossing.model"
    path.write_bytes(piece("a") + piece("a▁b") + field(2, field(3, 2) + field(35, 1)) + field(3, field(3, 1) + field(4, 0)))
    with pytest.raises(ValueError, match="crosses"):
        pieces.Pieces(str(path))


def plain_whitening(vectors, components):
    x = np.floor(64 * np.array(vectors, np.float64)).astype(np.int64) + 1_000_000
    n = len(x)
    spread = n * x - x.sum(0)
    y = spread / n
    variances, vectors = np.linalg.eigh(y.T @ y / n)
    variances, vectors = variances[::-1][:components], vectors[:, ::-1][:, :components]
    return (spread * spread).sum(1), y @ vectors / np.sqrt(variances), variances / np.trace(y.T @ y / n)


def test_whitening_query(spark):
    rows = QUERIES["op13_whitening"](spark, SMALL).orderBy("vec_id", "component").collect()
    given = spark.read.parquet(f"{SMALL}/embeddings.parquet").orderBy("vec_id").collect()
    n = len(given)
    deviation, white, explained = plain_whitening([r["embedding"] for r in given], 32)
    assert [(r["vec_id"], r["component"], r["n"]) for r in rows] == [(g["vec_id"], c, n) for g in given for c in range(1, 33)]
    got = np.array([r["whitened"] for r in rows]).reshape(n, 32)
    assert np.abs(got * np.sign((got * white).sum(0)) - white).max() < 1e-9
    assert [r["deviation"] for r in rows[::32]] == deviation.tolist()
    assert np.allclose([r["explained"] for r in rows[:32]], explained, rtol=1e-9)
    assert len({r["identity_error"] for r in rows}) == 1 and rows[0]["identity_error"] < 1e-9


VECTORS = "vec_id long, embedding array<float>, n string, _x int"


def test_whitening_on_odd_rows(spark):
    rng = np.random.default_rng(4)
    nan, inf = math.nan, math.inf
    good = [(i, (rng.standard_normal(5) * [5, 3, 2, 1, 1]).tolist()) for i in range(40)]
    good += [good[3], (None, good[4][1]), (7, [1.5, -2.0]), (8, [])]
    bad = [(50, None), (51, [1.0, None, 1.0, 1.0, 1.0]), (52, [nan] * 5), (53, [1.0, inf, 0.0, 0.0, 0.0]), (54, [1e30] * 5)]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in good + bad], VECTORS).repartition(4)
    rows = whitening.whiten(df, components=3).collect()
    full = [v + [0.0] * (5 - len(v)) for _, v in good]
    deviation, white, explained = plain_whitening(np.float32(full), 3)
    assert len(rows) == len(good) and {r["n"] for r in rows} == {len(good)} and {r["_x"] for r in rows} == {1}
    assert sorted(int(r["deviation"]) for r in rows) == sorted(deviation.tolist())
    assert sorted(abs(r["whitened"][0]) for r in rows) == pytest.approx(sorted(np.abs(white[:, 0]).tolist()), abs=1e-9)
    assert np.allclose(rows[0]["explained"], explained)


def test_equal_deviations_and_flat_directions(spark):
    """Two directions of equal variance, one of another, and three without any: restarts find the pair."""
    rows = [(i, [float(s * (k == d)) * (2 if d == 2 else 1) for k in range(6)]) for i, (d, s) in enumerate([(d, s) for d in range(3) for s in (-4, 4)] * 3)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    out = whitening.whiten(df).collect()
    white = np.array([r["whitened"] for r in out])
    assert white.shape == (18, 3) and np.allclose(white.T @ white / 18, np.eye(3))
    assert np.allclose(out[0]["explained"], [4 / 6, 1 / 6, 1 / 6]) and out[0]["identity_error"] < 1e-9
    same = whitening.whiten(spark.createDataFrame([(1, [2.0, 3.0])] * 3, "vec_id long, embedding array<double>")).collect()
    assert [(r["n"], int(r["deviation"]), r["whitened"], r["explained"]) for r in same] == [(3, 0, [], [])] * 3
    assert whitening.whiten(df.limit(0)).count() == 0


def test_many_dimensions_stop_when_found(spark, monkeypatch):
    monkeypatch.setattr(whitening, "FULL_STEPS", 10)
    rng = np.random.default_rng(6)
    x = rng.standard_normal((300, 40)) * np.append([90.0, 70.0, 50.0], np.full(37, 1.0))
    out = whitening.whiten(spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>"), components=3).orderBy("vec_id").collect()
    _, white, explained = plain_whitening(x, 3)
    got = np.array([r["whitened"] for r in out])
    assert np.abs(got * np.sign((got * white).sum(0)) - white).max() < 1e-8 and np.allclose(out[0]["explained"], explained)


def test_large_numbers_stay_exact():
    x = np.array([[2**50, -(2**50)], [3, 2**49], [-7, 11]], np.int64)
    sums = [int(s) for s in x.astype(object).sum(0)]
    assert whitening.squares(x, 3, sums) == [sum((3 * int(v) - s) ** 2 for v, s in zip(row, sums)) for row in x]
