"""A training corpus from raw documents: five stages, each an operator of ``grantflow.llm``.

Every stage takes the documents its predecessor kept and returns documents of the same columns; the last one returns
them as tokens. Between stages the documents are a Parquet table in the shared folder. Rows are told apart by their
content, so repeated rows, null ids and equal ids are handled like others.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from grantflow.llm import bpe, langid, mixing, simhash, suffixes
from grantflow.llm.queries import vocabulary
from grantflow.session import shared_folder

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def row_keys() -> list[Column]:
    """Two hashes of all columns; rows of equal content have equal ones, nulls are values of their own."""
    nulls = F.concat(*[F.col(c).isNull().cast("int").cast("string") for c in COLUMNS])
    return [F.xxhash64(*COLUMNS, nulls, F.lit(k)).alias(f"_key{k}") for k in (1, 2)]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; texts without letters and doubtful ones go."""
    remainder = langid.fold(F.col("doc_id"), 5)
    return langid.identify(docs.select(*COLUMNS), remainder != 0).where("accepted").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one of smallest id."""
    keyed = docs.select(*COLUMNS, *row_keys())
    found = simhash.near_duplicates(keyed, carry=("_key1", "_key2"))
    first = found.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "_key1", "_key2")).alias("k"))
    kept = keyed.join(first.select("k._key1", "k._key2"), ["_key1", "_key2"], "left_semi")
    once = Window.partitionBy("_key1", "_key2").orderBy(F.lit(0))
    return kept.withColumn("_n", F.row_number().over(once)).where("_n = 1").select(*COLUMNS)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that occur earlier; characters cut in two go, and ``n_chars`` is counted anew."""
    kept = suffixes.remove_repeats(docs, carry=("lang", "source"), as_text=True)
    return kept.select("doc_id", F.col("kept").alias("text"), "lang", "source", F.length("kept").cast("long").alias("n_chars"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture of sources takes them."""
    keyed = docs.select(*COLUMNS, *row_keys())
    mixed = mixing.mix(keyed, F.array("source"), mixing.word_count(F.col("text")), mixing.cycle_weights, carry=("_key1", "_key2"))
    copies = mixed.groupBy("_key1", "_key2").agg(F.sort_array(F.collect_list("copies")).alias("_copies"))
    same = Window.partitionBy("_key1", "_key2").orderBy(F.lit(0))
    taken = keyed.join(copies, ["_key1", "_key2"]).withColumn("_n", F.row_number().over(same))
    return mixing.repeat_rows(taken, F.get("_copies", F.col("_n") - 1)).select(*COLUMNS)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document; their decoded form is checked by its digest."""
    return bpe.encode(docs.select(*COLUMNS), vocabulary(), ("n_tokens", "ids", "decoded_sha256"))


STAGES = [
    ("language ID", language),
    ("SimHash near-dedup", near_duplicates),
    ("suffix-array dedup", repeated_passages),
    ("mixing to target weights", mixture),
    ("BPE encoding", token_ids),
]

#: Language ID, SimHash, mixing and encoding are beyond SQL; the tests compare with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for number, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{number}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
