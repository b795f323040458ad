"""The pipeline against plain versions of its stages."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline

from ..conftest import SMALL
from . import brute
from .test_operators import library, odd_rows

COLUMNS = pipeline.COLUMNS


def rows(df):
    return sorted(map(tuple, df.select(*COLUMNS).collect()), key=str)


@pytest.fixture(scope="module")
def documents(spark):
    odd = spark.createDataFrame([r[:5] for r in odd_rows()], "doc_id long, text string, lang string, source string, n_chars long")
    return spark.read.parquet(f"{SMALL}/documents.parquet").unionByName(odd.withColumn("doc_id", F.col("doc_id") + 100_000))


@pytest.fixture(scope="module")
def results(spark, documents, tmp_path_factory):
    """What each stage was given and what it gave."""
    out, docs = {}, documents
    for name, stage in pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage"))
        stage(spark, docs, SMALL).write.mode("overwrite").parquet(path)
        made = spark.read.parquet(path)
        out[name] = (docs, made)
        docs = made
    return out


def test_language_keeps_all_text(results):
    given, kept = (rows(x) for x in results["language ID"])
    gone = [r for r in given if r not in kept]
    assert all(r in given for r in kept) and len(gone) < 0.1 * len(given)
    assert all(r in gone for r in given if not any(map(str.isalpha, r[1] or "")))


def test_one_document_of_each_group_stays(results):
    given, kept = (rows(x) for x in results["SimHash near-dedup"])
    prints = [brute.simhash(r[1]) for r in given]
    number = brute.classes(prints, lambda a, b: (a ^ b).bit_count() <= 4)
    by = {}
    for r, c in zip(given, number):
        by.setdefault(c, []).append(r)
    assert len(kept) == len(by)
    ids = sorted(str(min((r[0] for r in group if r[0] is not None), default=None)) for group in by.values())
    assert sorted(str(r[0]) for r in kept) == ids and all(r in given for r in kept)


def test_passages_are_cut_out(results):
    given, kept = results["suffix-array dedup"]
    given = sorted(((r.doc_id, r.text or "", r.lang, r.source) for r in given.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode()))
    texts = [k.decode("utf-8", "ignore") for _, _, k in brute.without_repeats([r[1].encode() for r in given])]
    assert rows(kept) == sorted([(r[0], t, r[2], r[3], len(t)) for r, t in zip(given, texts)], key=str)


def test_mixture_repeats_whole_documents(results):
    given, taken = (rows(x) for x in results["mixing to target weights"])
    words = lambda rs, s: sum(len(brute.WORDS.findall(r[1] or "")) for r in rs if r[3] == s)
    assert set(taken) <= set(given) and all(taken.count(r) <= 2 * given.count(r) for r in set(taken))
    total = sum(words(given, s) for s in {r[3] for r in given})
    assert sum(words(taken, s) for s in {r[3] for r in given}) == pytest.approx(1.5 * total, rel=0.03)


def test_tokens(results):
    given, made = results["BPE encoding"]
    tokenizer = library()
    want = sorted((r.doc_id, tuple(tokenizer.encode(r.text or "", add_special_tokens=False).ids)) for r in given.collect() if r.doc_id is not None)
    assert sorted((r.doc_id, tuple(r.ids)) for r in made.collect() if r.doc_id is not None) == want


def test_run_and_empty_documents(spark, tmp_path):
    spark.read.parquet(f"{SMALL}/documents.parquet").limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    assert pipeline.run(spark, str(tmp_path)).count() == 0
