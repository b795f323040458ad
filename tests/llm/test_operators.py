"""The ten operators against plain versions, on the small tables and on odd ones."""

import math
import os
import random
import zlib
from collections import Counter
from datetime import datetime, timezone

import numpy as np
import pytest
from pyspark.sql import functions as F

from grantflow.llm import bpe, digest, dom, kneser, langid, mainpage, mixing, mtree, simhash, suffixes, urlfilter
from grantflow.llm.queries import ORACLE, QUERIES, vocabulary

from ..conftest import SMALL
from ..oracle import compare, connect
from . import brute

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, _id string, fp string, size string"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


def odd_rows():
    """Nulls, empty and very long texts, repeated rows, equal ids, near and exact copies, and clashing columns."""
    rng = random.Random(5)
    words = ["alpha", "Beta", "gámma", "delta", "ß", "epsilon", "zeta", "eta", "theta", "Iota"]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    long, shared = prose(9000), prose(60)
    rows = [
        (1, long, "en", "a"), (2, None, "en", "a"), (3, "", None, None), (4, "  \n\t ", "de", "b"), (5, shared, "de", "b"),
        (6, prose(30) + " " + shared, "de", None), (6, shared + "!", "en", "c"), (7, shared, "en", "c"), (7, shared, "en", "c"),
        (None, shared, "en", "a"), (None, prose(40), None, "a"), (8, "x", "en", "a"), (9, "123 456 !!", "en", "a"), (10, "á" * 300, "de", "b"),
        (11, "ab" * 400, "de", "b"), (12, long[:3000] + "Z" + long[3001:], "en", "a"), (13, "的中文", None, "c"),
    ]
    rows += [(20 + i, prose(rng.randint(1, 200)), rng.choice(["en", "de", None]), rng.choice("abc")) for i in range(30)]
    return [(i, t, lang, s, len(t) if t else None, 1.5, "x", "y", "z") for i, t, lang, s in rows]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), DOCS).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql(spark, name):
    assert compare(spark, connect(SMALL), name, QUERIES[name], ORACLE[name], SMALL) == ""


def test_every_operator_has_a_query():
    assert all(sum(q.startswith(f"op{n}_") for q in QUERIES) == 1 for n in range(1, 11))


# 1: main text


def test_blocks_decode_and_join():
    page = "<html><head><title>T</title></head><body><p>a &lt; b&nbsp;&amp c\n d<br>e<p>f<b>g</b><script>x</script><!-- y -->h</p>tail <div cla"
    assert [b.text for b in dom.blocks(page)] == ["a < b & c d e", "fgh", "tail"]
    assert dom.blocks(None) == dom.blocks("") == dom.blocks("<script>unclosed") == []
    assert [b.text for b in dom.blocks("1 < 2 and 3 > 2")] == ["1 < 2 and 3 > 2"]


@pytest.mark.parametrize("page, texts", [
    ("<p>a</p><svg-icon name=x></svg-icon><p>b</p>", ["a", "b"]),
    ("<title-bar>a</title-bar><template-x><p>b</p></template-x><p>c", ["a", "b", "c"]),
    ("<p>a <svg class=i/> b <math/> c</p><p>d", ["a b c", "d"]),
    ("<div>a<object data=x></div><div>b<svg><path d=z></div><p>c", ["a", "b", "c"]),
    ("<div>a<noscript>x</div><p>b</p><noscript>y</noscript><p>c", ["a", "b", "c"]),
    ("<div>a<noscript>b<p>c</div><p>d", ["ab", "c", "d"]),
    ("<svg><svg><path/></svg><title>x</title></svg><p>a", ["a"]),
    ("<svg><title>x<path><p>a</p><p>b", ["a", "b"]),
    ("<p>if <math><mrow><mi>x</mi><mo>=</mo><mn>2</mn></mrow><annotation>x</annotation></math> then</p>", ["if x=2 then"]),
    ("<svg><text>a</text><text>b</text><style>x</style></svg><template><p>x</p></template><p>c", ["a b", "c"]),
    ("<svg><foreignObject><p>a</p></foreignObject><text>b</text></svg>c", ["a", "b c"]),
    ("a<!-->b<!-- x --!>c<iframe>x</iframe>d<style>x</style >e<script>x</scripts></script y>f", ["abcdef"]),
])
def test_blocks_are_not_cut_by_hidden_elements(page, texts):
    assert [b.text for b in dom.blocks(page)] == texts


def test_field_finds_main_text_of_unseen_layouts(spark):
    sample = [r.html for r in spark.read.parquet(f"{SMALL}/pages.parquet").select("html").collect()]
    pages, labels = mainpage.labelled_pages(sample[:30], layouts=8)
    field = mainpage.fit([mainpage.features(p) for p in pages], labels)
    unseen, truth = mainpage.labelled_pages(sample[30:], seed=99)
    wrong = total = 0
    for page, label in zip(unseen, truth):
        scores = [sum(field.weights.get(f, 0.0) for f in fs) for fs in mainpage.features(page)]
        wrong += sum(a != b for a, b in zip(mainpage.viterbi(scores, field.moves), label))
        total += len(label)
    assert wrong / total < 0.02


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(3)
    for _ in range(50):
        s, m = rng.normal(size=6), rng.normal(size=(2, 2))
        value = lambda y: sum(s[i] * y[i] for i in range(6)) + sum(m[y[i]][y[i + 1]] for i in range(5))
        best = max(([n >> i & 1 for i in range(6)] for n in range(64)), key=value)
        assert mainpage.viterbi(s.tolist(), m.tolist()) == best


def test_extraction_of_the_small_pages(spark):
    rows = QUERIES["op1_html_extraction"](spark, SMALL).collect()
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()}
    assert len(rows) == len(pages)
    for r in rows:
        found = dom.blocks(pages[r.page_id])
        assert r.text == "\n".join(b.text for b, keep in zip(found, mainpage.landmark_labels(found)) if keep)
        assert r.n_chars == len(r.text)


def test_extraction_of_odd_pages(spark):
    pages = spark.createDataFrame([(1, None, "t"), (2, "", "t"), (None, "<p>" + "word " * 50_000, None), (2, "", "t")], "page_id long, html string, text string")
    out = mainpage.extract(pages)
    assert out.columns == ["page_id", "html", "text", "n_chars"] and out.count() == 4
    assert sorted(r.n_chars for r in out.where("html = '' or html is null").collect()) == [0, 0, 0]
    assert mainpage.extract(pages.limit(0)).count() == 0


# 2: near duplicates


def check_simhash(df):
    rows = [(r.doc_id, r.text) for r in df.collect()]
    prints = [brute.simhash(t) for _, t in rows]
    number = brute.classes(prints, lambda a, b: (a ^ b).bit_count() <= 4)
    least = {}
    for (i, _), c in zip(rows, number):
        least[c] = min((x for x in (i, least.get(c)) if x is not None), default=None)
    want = sorted((str(i), format(p, "016x"), str(least[c])) for (i, _), p, c in zip(rows, prints, number))
    got = sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in simhash.near_duplicates(df).collect())
    assert got == want


def test_simhash(documents):
    check_simhash(documents)


def test_simhash_of_odd_documents(odd, none):
    check_simhash(odd)
    assert simhash.near_duplicates(none).count() == 0


def test_trees_find_every_near_value(monkeypatch):
    monkeypatch.setattr(simhash, "FRONTIER", 300)
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 40, dtype=np.uint64)
    values = np.unique(np.concatenate([base ^ (np.uint64(1) << rng.integers(0, 64, 40).astype(np.uint64)) for _ in range(20)] + [base]))
    group = rng.integers(0, 3, len(values))
    got = {p for a, b in simhash.Trees(values, group).within(values, group, 4) for p in zip(a.tolist(), b.tolist())}
    near = np.bitwise_count(values[:, None] ^ values[None]) <= 4
    assert got == {(i, j) for i, j in zip(*map(np.ndarray.tolist, np.nonzero(near))) if group[i] == group[j]}


@pytest.mark.parametrize("pieces", [5, 6, 7])
def test_links_connect_all_near_fingerprints(spark, monkeypatch, pieces):
    """Large groups of near fingerprints, cut into parts."""
    monkeypatch.setattr(simhash, "pieces_for", lambda *a, **b: pieces)
    rng = random.Random(pieces)
    base = [rng.getrandbits(64) for _ in range(5)]
    values = sorted({b ^ sum(1 << rng.randrange(64) for _ in range(3)) for b in base for _ in range(60)} | {rng.getrandbits(64) for _ in range(50)})
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    links = simhash.near_links(spark.createDataFrame([(v,) for v in signed], "fp long"), len(values), part=16).collect()
    pairs = {(r.a, r.b) for r in links}
    assert len(links) <= len(values) * 35
    joined = brute.classes(signed, lambda a, b: (a, b) in pairs or (b, a) in pairs)
    want = brute.classes(values, lambda a, b: (a ^ b).bit_count() <= 4)
    assert joined == want


# 3: fingerprints


def check_digests(df, per_part):
    rows = sorted(((r.doc_id, r.text or "") for r in df.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    got = digest.against_next(df, per_part).collect()
    texts = [t for _, t in rows]
    following = texts[1:] + texts[:1]
    want = sorted((str(i), len(t), digest.edited(t, n)) for (i, t), n in zip(rows, following))
    assert sorted((str(r.doc_id), r.n_chars, r.edited_text) for r in got) == want
    own = {}
    for r in got:
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        assert r.near_edited == pytest.approx(digest.compare(r.fingerprint, r.edited_fingerprint))
        own[r.doc_id] = r
    for r in digest.fingerprint(df).collect():
        assert r.fingerprint in {x.fingerprint for x in got if x.doc_id == r.doc_id}
    return own


def test_digests(documents):
    own = check_digests(documents, 30)
    texts = {r.doc_id: r.text for r in documents.collect()}
    order = sorted(texts)
    for a, b in zip(order, order[1:]):
        assert own[a].near_next == pytest.approx(digest.compare(own[a].fingerprint, own[b].fingerprint))
        if texts[a] == texts[b]:
            assert own[a].near_next == 1
    long = [r for i, r in own.items() if len(texts[i]) > 1000]
    assert np.median([r.near_edited for r in long]) > 0.4 > 0.2 > np.median([r.near_next for r in long])


def test_digests_of_odd_documents(odd, none):
    check_digests(odd, 1000)
    assert digest.against_next(none).count() == 0 and digest.fingerprint(none).count() == 0


def test_windows_have_their_entropy():
    flat = np.random.default_rng(0).integers(97, 103, 500, dtype=np.uint8)
    level = digest.window_levels(flat, np.array([0, 200, 205, 500]))
    for i in range(500):
        end = 200 if i < 200 else 205 if i < 205 else 500
        if i + digest.WINDOW > end:
            assert level[i] == -1
        else:
            n = np.unique(flat[i : i + digest.WINDOW], return_counts=True)[1] / digest.WINDOW
            assert level[i] == pytest.approx(-(n * np.log2(n)).sum() / np.log2(digest.WINDOW) * digest.LEVELS, abs=1)


# 4: language


def test_language_accuracy_on_held_out_documents(spark, documents):
    truth = {r.doc_id: r.lang for r in documents.collect()}
    rows = QUERIES["op4_language_id"](spark, SMALL).collect()
    assert len(rows) == len(truth)
    held = [r for r in rows if r.held_out]
    assert {r.doc_id for r in held} == {i for i in truth if zlib.crc32(str(i).encode()) % 5 == 0}
    assert np.mean([truth[r.doc_id] == r.lang_pred for r in held]) > 0.95
    assert np.mean([r.accepted for r in rows]) > 0.98


def test_language_of_odd_documents(odd, none):
    out = langid.identify(odd, F.lit(True))
    rows = out.collect()
    assert out.columns == [*odd.columns[:5], *odd.columns[6:], "lang_pred", "score", "accepted"] and len(rows) == odd.count()
    for r in rows:
        blank = not any(map(str.isalpha, r.text or ""))
        assert (r.lang_pred == "und") == blank and 0 <= r.score <= 1 and not (blank and r.accepted)
    assert langid.identify(none, F.lit(True)).count() == 0
    assert {r.lang_pred for r in langid.identify(odd, F.lit(False)).collect()} == {"und"}


def test_noise_is_rejected_sooner_than_text(documents):
    rows = documents.select("text", "lang").collect()
    pieces = [r.text[:200] for r in rows]
    model = langid.train(pieces, [r.lang for r in rows], np.arange(len(rows)) % 5 == 0)
    assert langid.predict(model, pieces)[2].mean() > 0.98
    assert langid.predict(model, ["", None, "12 34"])[0] == ["und"] * 3


# 5: repeated passages


def check_repeats(df):
    rows = sorted(((r.doc_id, r.text or "") for r in df.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode()))
    want = brute.without_repeats([t.encode() for _, t in rows])
    got = suffixes.remove_repeats(df).collect()
    key = lambda i, n, removed, runs, kept: (str(i), n, removed, runs, kept)
    assert sorted(key(r.doc_id, r.n_bytes, r.n_removed, len(r.removed), bytes(r.kept)) for r in got) == sorted(
        key(i, len(t.encode()), *w) for (i, t), w in zip(rows, want))


def test_repeats(documents):
    check_repeats(documents)


def test_repeats_of_odd_documents(odd, none):
    check_repeats(odd)
    assert suffixes.remove_repeats(none).count() == 0


def test_repeats_with_hot_leads(spark, monkeypatch):
    """A short line in every document, a long one in most, dealt string by string."""
    monkeypatch.setattr(suffixes, "HOT_ROWS", 3)
    monkeypatch.setattr(suffixes, "HOT_SAMPLE", 1)
    monkeypatch.setattr(suffixes, "COMPARED", 50)
    rng = random.Random(2)
    noise = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    line, passage = noise(60), noise(180)
    rows = [(i, noise(rng.randint(0, 200)) + line + noise(rng.randint(0, 80)) + (passage if i % 3 else "") + noise(rng.randint(0, 90))) for i in range(60)]
    check_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))


def test_kept_text_has_no_broken_characters(spark):
    rows = [(1, "é" * 60 + "x"), (2, "aé" + "é" * 60 + "x")]
    out = {r.doc_id: r for r in suffixes.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), as_text=True).collect()}
    assert out[1].n_removed == 0 or out[1].kept.count("�") == 0
    assert "�" not in out[2].kept and out[2].n_removed > 0


# 6: URL filters


def test_filters_as_of_fetch_time(spark):
    day = lambda n: datetime.fromtimestamp(86_400 * n, timezone.utc).replace(tzinfo=None)
    entries = spark.createDataFrame([
        ("spam", "Bad.org", "add", day(10)), ("spam", "bad.org", "remove", day(20)), ("spam", "bad.org", "add", day(30)),
        ("spam", "bad.org", "remove", day(30)), ("adult", "x.bad.org", "add", day(5)), (None, "ok.org/p/Q", "add", day(0)),
        ("spam", None, "add", day(1)), ("spam", "z.org", "add", None), ("spam", "bad.org", "add", day(10)),
    ], "list string, pattern string, action string, at timestamp")
    captures = spark.createDataFrame([
        (1, "http://u:p@X.bad.ORG:80/a?q", day(15)), (2, "https://bad.org", day(20)), (3, "https://bad.org/", day(9)), (4, "https://bad.org#f", day(400)),
        (5, "http://ok.org/p/Q/r.html", day(3)), (6, "http://ok.org/p/q", day(3)), (7, None, day(3)), (8, "http://bad.org", None), (9, "", day(3)),
        (10, "http://notbad.org/", day(15)), (2, "https://bad.org", day(20)), (11, "https://bad.org/z", day(10)),
    ], "page_id long, url string, fetched_at timestamp").withColumn("_url", F.lit("u")).withColumn("lists", F.lit("l"))
    out = urlfilter.filter_captures(captures, entries)
    got = sorted((r.page_id, r.blocked, r.n_entries, tuple(r.lists), r.rule) for r in out.collect())
    clear = (False, 0, (), None)
    assert got == [
        (1, True, 2, ("adult", "spam"), "x.bad.org"), (2, *clear), (2, *clear), (3, *clear), (4, True, 1, ("spam",), "bad.org"),
        (5, True, 1, ("",), "ok.org/p/Q"), (6, *clear), (7, *clear), (8, *clear), (9, *clear), (10, *clear), (11, True, 1, ("spam",), "bad.org"),
    ]
    assert urlfilter.filter_captures(captures, entries.limit(0)).where("blocked").count() == 0
    assert urlfilter.filter_captures(captures.limit(0), entries).count() == 0


# 7: top k


@pytest.mark.parametrize("small", [False, True])
def test_top_k(spark, monkeypatch, small):
    if small:
        for name, n in (("SHARD", 40), ("LEAF", 9), ("PAGE", 4), ("QUERIES", 5)):
            monkeypatch.setattr(mtree, name, n)
    rng = np.random.default_rng(4)
    x = np.round(rng.normal(size=(300, 6)), 1)
    x[50:150] = x[50]
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(900, None), (920, [1.0, None] * 3), (940, [float("nan")] * 6), (None, [1.0] * 6), (960, [1.0, 2.0]), (980, []), (3, x[3].tolist())]
    out = mtree.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3), F.col("vec_id") % 20 == 0)
    q = np.floor(64 * x).astype(int)
    want = []
    for i in range(0, 300, 20):
        scores = sorted((-int(q[i] @ q[j]), j) for j in range(300) if j != i)[:20]
        want += [(i, n, j, -s) for n, (s, j) in enumerate(scores, 1)]
    assert sorted(tuple(r) for r in out.collect()) == sorted(want)


def test_top_k_of_nothing(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert mtree.top_k(empty, F.col("vec_id") % 20 == 0).count() == 0
    one = spark.createDataFrame([(0, [1.0])], "vec_id long, embedding array<float>")
    assert mtree.top_k(one, F.col("vec_id") % 20 == 0).count() == 0


# 8: mixing


def test_targets_are_capped_and_reshared():
    sizes, weights = {0: 100, 1: 1000, 2: 10}, {0: 5, 1: 2, 2: 1}
    t = mixing.capped_targets(sizes, weights, 1.5, 2)
    assert t == {0: 200, 2: 20, 1: pytest.approx(1.5 * 1110 - 220)}


def test_flow_prefers_first_repetitions():
    flow = mixing.min_cost_flow({"a": 10, "ab": 10, "b": 10}, {"a": {0}, "ab": {0, 1}, "b": {1}}, {0: 15, 1: 15}, 2, lambda k: k * k + k)
    use = {p: sum(n for (q, _), n in flow.items() if q == p) for p in ("a", "ab", "b")}
    assert use == {"a": 10, "ab": 10, "b": 10}
    assert sum(n for (_, s), n in flow.items() if s == 0) == 15


def test_mixture(spark, documents):
    rows = QUERIES["op8_mixing"](spark, SMALL).collect()
    source = {r.doc_id: r.source for r in documents.collect()}
    size = {r.doc_id: len(brute.WORDS.findall(r.text or "")) for r in documents.collect()}
    assert {r.doc_id: r.size for r in rows} == size
    totals = {s: sum(size[i] for i in size if source[i] == s) for s in set(source.values())}
    names = sorted(totals)
    targets = mixing.capped_targets(totals, {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}, 1.5, 2)
    for s in names:
        own = [r for r in rows if source[r.doc_id] == s]
        assert {r.source_size for r in own} == {totals[s]} and own[0].target == pytest.approx(targets[s])
        assert abs(sum(r.taken for r in own) - targets[s]) <= max(r.size for r in own) / 2
        assert all(r.taken in (0, r.size, 2 * r.size) for r in own)
    assert sorted(map(tuple, rows)) == sorted(map(tuple, QUERIES["op8_mixing"](spark, SMALL).collect()))


def test_mixture_of_odd_documents(odd, none):
    mixed = mixing.mix(odd, F.array("source"), mixing.word_count(F.col("text")), mixing.cycle_weights)
    rows = mixed.collect()
    assert len(rows) == odd.count() and all(0 <= r.copies <= 2 and (r.size or not r.copies) for r in rows)
    assert {None} in [set(r.sources) for r in rows]
    both = mixing.mix(odd, F.array(F.col("source"), F.lit("all")), mixing.word_count(F.col("text")), mixing.cycle_weights)
    assert both.count() == odd.count()
    assert mixing.mix(none, F.array("source"), mixing.word_count(F.col("text")), mixing.cycle_weights).count() == 0


# 9: BPE


def library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(vocabulary())
    t.no_padding()
    t.no_truncation()
    return t


def check_encoding(df):
    t = library()
    made = bpe.encode(df.withColumn("_raw", F.col("text")), vocabulary(), ("n_tokens", "ids", "decoded", "ids_sha256", "decoded_sha256")).collect()
    assert len(made) == df.count()
    for r in made:
        ids = t.encode(r._raw or "", add_special_tokens=False).ids
        decoded = t.decode(ids, skip_special_tokens=False)
        assert r.ids == ids and r.n_tokens == len(ids) and r.decoded == decoded
        assert r.ids_sha256 == brute.sha(np.array(ids, "<u4").tobytes()) and r.decoded_sha256 == brute.sha(decoded.encode())


def test_encoding(documents):
    check_encoding(documents)


def test_encoding_of_odd_texts(spark, odd, none, monkeypatch):
    monkeypatch.setattr(bpe, "WORD_TABLE", 50)
    check_encoding(odd)
    texts = ["<|endoftext|>a<|startoftext|> B<|end", "aaaaaaaaaaa", "I'm we'LL 3½ ٣٤ ΣΑΣ İstanbul é ﬁ", "  \x1cx\x85y", "🎉👩‍👩‍👧 !!??", "hellohellohello" * 300]
    check_encoding(spark.createDataFrame([(t,) for t in texts], "text string"))
    assert bpe.encode(none, vocabulary()).count() == 0


# 10: language model


def check_model(df, learn):
    rows = df.collect()
    model = brute.KneserNey([r.text for r in rows if r.doc_id is not None and learn(r.doc_id)])
    got = kneser.fit_and_score(df, langid.fold(F.col("doc_id"), 7) != 2).collect()
    assert len(got) == len(rows)
    for r in got:
        tokens, known, base, score = model.score(r.text)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (tokens, known, model.tokens_)
        assert r.base_score == pytest.approx(base) and r.score == pytest.approx(score, rel=1e-6)


def learned(i):
    return zlib.crc32(str(i).encode()) % 7 != 2


def test_model(documents):
    check_model(documents, learned)


def test_model_with_hot_contexts(odd, monkeypatch):
    for name, n in (("HOT_SHARE", 0.02), ("COUNTED", 300), ("SHARD_BYTES", 5000)):
        monkeypatch.setattr(kneser, name, n)
    check_model(odd, learned)


def test_model_of_nothing(none, odd):
    assert kneser.fit_and_score(none, F.lit(True)).count() == 0
    rows = kneser.fit_and_score(odd, F.lit(False)).collect()
    assert {(r.train_tokens, r.n_known, r.base_score, r.score) for r in rows} == {(0, 0, 0.0, 0.0)}


def test_chances_sum_to_one(documents):
    meta = kneser.fit(documents.limit(50))
    reader = kneser.Reader(meta)
    shards = [reader.arrays("words", s, np.uint64, np.int64)[0] for s in range(1 << meta.bits)]
    words = np.concatenate([*shards, [np.uint64(12345)]])
    context = words[5]
    token = np.stack([np.full(len(words), context), words], 1).ravel()
    both = reader.score(token, np.arange(0, len(token) + 1, 2))[2]
    one = reader.score(np.full(len(words), context), np.arange(len(words) + 1))[2]
    assert np.sum(10 ** (both - one)) == pytest.approx(1)
    assert os.path.isdir(meta.folder)


class AnyOrder:
    """Model of runs of ``order`` words from texts, with words as they are."""

    def __init__(self, texts, order):
        self.order, self.count = order, Counter()
        levels = {k: Counter() for k in range(1, order + 1)}
        for t in texts:
            words = brute.KneserNey.tokens(t)
            self.count.update(words)
            for i in range(len(words)):
                run = self.run(words, i)
                levels[len(run)][run] += 1
        for k in range(order, 1, -1):
            levels[k - 1].update(r[1:] for r in levels[k])
        self.levels, self.discounts = levels, {k: brute.KneserNey.discounts(c.values()) for k, c in levels.items()}
        if order > 2:
            self.discounts = {k: [d or u for d, u in zip(c, [0, 0.5, 0.75, 0.9])] for k, c in self.discounts.items()}
        self.after, self.left = Counter(), Counter()
        for k in levels:
            for r, n in levels[k].items():
                self.after[r[:-1]] += n
                self.left[r[:-1]] += self.discounts[k][min(n, 3)]

    def run(self, words, i):
        return tuple(["<begin>", *words][max(0, i + 2 - self.order) : i + 2])

    def chance(self, run):
        if not run:
            return 1 / (len(self.count) + 1)
        p = self.chance(run[1:])
        if not self.after[run[:-1]]:
            return p
        n = self.levels[len(run)][run]
        return (max(n - self.discounts[len(run)][min(n, 3)], 0) + self.left[run[:-1]] * p) / self.after[run[:-1]]

    def score(self, text):
        words = brute.KneserNey.tokens(text)
        return sum(math.log10(self.chance(self.run(words, i))) for i in range(len(words)))


@pytest.mark.parametrize("order", [2, 3, 4])
def test_model_of_longer_runs(odd, monkeypatch, order):
    for name, n in (("HOT_SHARE", 0.004), ("COUNTED", 300), ("SHARD_BYTES", 5000), ("SUMMED", 2)):
        monkeypatch.setattr(kneser, name, n)
    rows = odd.collect()
    model = AnyOrder([r.text for r in rows if r.doc_id is not None and learned(r.doc_id)], order)
    got = kneser.fit_and_score(odd, langid.fold(F.col("doc_id"), 7) != 2, order=order).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.score == pytest.approx(model.score(r.text), rel=1e-6)


def test_query_uses_contexts_of_two_words(spark, documents):
    texts = {r.doc_id: r.text for r in documents.collect()}
    model = AnyOrder([t for i, t in texts.items() if learned(i)], 3)
    got = QUERIES["op10_lm_scoring"](spark, SMALL).collect()
    assert len(got) == len(texts)
    assert [r.score for r in got] == pytest.approx([model.score(texts[r.doc_id]) for r in got], rel=1e-6)


@pytest.mark.parametrize("most", [3, 300, 70_000, 1 << 20])
def test_bounds_in_blocks(most):
    steps = np.random.default_rng(most).integers(1, 5, 2000)
    steps[[0, 700, 1999]] = most
    bounds = np.append(0, np.cumsum(steps))
    power, blocks, small = kneser.packed_bounds(bounds)
    assert (blocks[np.arange(len(bounds)) >> power[0]].astype(np.int64) + small == bounds).all()


def test_words_with_equal_half_hashes_stay_apart(tmp_path):
    words = np.array([1 << 40 | 1, 1 << 40 | 2], np.uint64)
    kneser.write_arrays(f"{tmp_path}/words-0", words, np.array([3, 4]))
    ids = kneser.Words(str(tmp_path), 2, np.array([0, 2, 2, 2, 2])).ids(words)
    assert ids.tolist() == [0, 1]
