"""One registered query per operator, over its whole table and with production parameters."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import bpe, digest, kneser, langid, mainpage, mixing, mtree, periodic, pieces, simhash, suffixes, urlfilter, whitening
from .catalog import ORACLE, QUERIES, query, table
from .common import WORD

__all__ = ["ORACLE", "QUERIES"]


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    """Path of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


URL_SQL = r"""
WITH captures AS (
  SELECT page_id, url, page_id * 37 % 400 AS fetched_day,
         regexp_extract(lower(url), '^[a-z][a-z0-9+.\-]*://(?:[^/?#@]*@)?\[?([^/?#:\]]*)', 1) AS host,
         regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)', 1) AS path
  FROM pages),
hosts AS (SELECT host, min(page_id) AS m, min(nullif(regexp_extract(path, '^/*([^/]+)', 1), '')) AS folder
          FROM captures WHERE host <> '' GROUP BY host),
entries AS (
  SELECT 'list' || (m % 4) AS list, host AS pattern, 'add' AS action, m % 200 AS day FROM hosts
  UNION ALL SELECT 'list' || (m % 4), host, 'remove', m % 200 + 30 + m % 50 FROM hosts
  UNION ALL SELECT 'list' || (m % 4), host, 'add', m % 200 + 120 FROM hosts WHERE m % 3 = 0
  UNION ALL SELECT 'folders', host || '/' || folder, 'add', m % 300 FROM hosts WHERE folder IS NOT NULL AND m % 2 = 0),
spans AS (
  SELECT list, pattern, action, day AS valid_from, lead(day) OVER (PARTITION BY list, pattern ORDER BY day) AS valid_to
  FROM (SELECT list, pattern, day, min(action) AS action FROM entries GROUP BY ALL)),
hits AS (
  SELECT c.page_id, s.list, s.pattern
  FROM captures c JOIN spans s ON s.action = 'add' AND (
         c.host = s.pattern OR ends_with(c.host, '.' || s.pattern)
         OR (s.list = 'folders' AND (c.host || c.path = s.pattern OR starts_with(c.host || c.path, s.pattern || '/'))))
   AND c.fetched_day >= s.valid_from AND (s.valid_to IS NULL OR c.fetched_day < s.valid_to))
SELECT c.page_id, c.url, c.host, c.fetched_day, count(h.list) > 0 AS blocked, count(h.list) AS n_entries,
       coalesce(string_agg(DISTINCT h.list, ',' ORDER BY h.list), '') AS lists,
       min_by(h.pattern, (-length(h.pattern), h.pattern)) AS rule
FROM captures c LEFT JOIN hits h ON h.page_id = c.page_id
GROUP BY c.page_id, c.url, c.host, c.fetched_day
"""


def captures_and_lists(spark, sf_dir):
    """Captures of all pages with a fetch day derived from the page number, and dated lists derived from their hosts."""
    at = lambda day: F.timestamp_seconds(day * 86_400)
    captures = table(spark, sf_dir, "pages").select(
        "page_id", "url", (F.col("page_id") * 37 % 400).alias("fetched_day")).withColumn("fetched_at", at(F.col("fetched_day")))
    path = F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)", 1)
    folder = F.get(F.filter(F.split(path, "/"), lambda x: x != ""), 0)
    hosts = (
        captures.withColumn("host", urlfilter.url_host(F.col("url"))).where("host <> ''")
        .groupBy("host").agg(F.min("page_id").alias("m"), F.min(folder).alias("folder"))
    )
    m, lists = F.col("m"), F.concat(F.lit("list"), F.col("m") % 4)

    def entry(name, pattern, action, day, where=None):
        rows = hosts.where(where) if where is not None else hosts
        return rows.select(name.alias("list"), pattern.alias("pattern"), F.lit(action).alias("action"), at(day).alias("at"))

    entries = (
        entry(lists, F.col("host"), "add", m % 200)
        .unionByName(entry(lists, F.col("host"), "remove", m % 200 + 30 + m % 50))
        .unionByName(entry(lists, F.col("host"), "add", m % 200 + 120, m % 3 == 0))
        .unionByName(entry(F.lit("folders"), F.concat_ws("/", "host", "folder"), "add", m % 300, F.col("folder").isNotNull() & (m % 2 == 0)))
    )
    return captures, entries


@query("op1_html_extraction")
def op1_html_extraction(spark, sf_dir):
    return mainpage.extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


@query("op2_simhash")
def op2_simhash(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash.near_duplicates(docs, shingle=4, radius=4).select("doc_id", "fingerprint", "component_id")


@query("op3_fingerprints")
def op3_fingerprints(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return digest.against_next(docs).select(
        "doc_id", "n_chars", F.sha2("edited_text", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint", "near_edited", "near_next")


@query("op4_language_id")
def op4_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    remainder = langid.fold(F.col("doc_id"), 5)
    held_out = F.coalesce(remainder == 0, F.lit(False)).alias("held_out")
    return langid.identify(docs, remainder != 0).select("doc_id", held_out, "lang_pred", "score", "accepted")


@query("op5_suffix_dedup")
def op5_suffix_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffixes.remove_repeats(docs).select(
        "doc_id", "n_bytes", "n_removed", F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@query("op6_url_filters", URL_SQL)
def op6_url_filters(spark, sf_dir):
    captures, entries = captures_and_lists(spark, sf_dir)
    out = urlfilter.filter_captures(captures, entries)
    return out.select("page_id", "url", "host", "fetched_day", "blocked", "n_entries", F.array_join("lists", ",").alias("lists"), "rule")


def products_sql() -> str:
    """Every query against every other row by brute force."""
    return """
WITH usable AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS DOUBLE)) AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS query_id, b.vec_id, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
  FROM usable a JOIN usable b ON a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM scored)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM ranked WHERE n <= 20
"""


@query("op7_exact_top_k", products_sql())
def op7_exact_top_k(spark, sf_dir):
    return mtree.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@query("op8_mixing")
def op8_mixing(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    mixed = mixing.mix(docs, F.array("source"), mixing.word_count(F.col("text")), mixing.cycle_weights)
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


@query("op9_bpe")
def op9_bpe(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.encode(docs, vocabulary(), ("n_tokens", "ids_sha256", "decoded_sha256"))


@query("op10_lm_scoring")
def op10_lm_scoring(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    remainder = langid.fold(F.col("doc_id"), 7)
    scored = kneser.fit_and_score(docs, remainder != 2, order=3)
    return scored.select(
        "doc_id", F.coalesce(remainder == 2, F.lit(False)).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def with_planted_runs(doc_id, text):
    """Texts in which every tenth document, by the checksum of its id, repeats a stretch of its words to its end."""
    checksum = F.crc32(doc_id.cast("string"))
    g = F.floor(checksum / 10)

    def plant(words):
        n = F.size(words)
        a = (g % n).cast("int")
        p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        return F.transform(words, lambda w, i: F.when(i < a, w).otherwise(F.get(words, a + (i - a) % p)))

    # The list of words is bound to a variable, so it is made once a text.
    found = F.transform(F.array(F.regexp_extract_all(text, F.lit(f"({WORD})"), 1)), plant)
    planted = F.get(found, 0)
    return F.when((checksum % 10 == 0) & (F.regexp_instr(text, F.lit(WORD)) > 0), F.array_join(planted, " ")).otherwise(text)


@query("op11_periodic_runs")
def op11_periodic_runs(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", with_planted_runs(F.col("doc_id"), F.col("text")).alias("text"))
    return periodic.find_runs(docs, ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"), min_length=6, min_exponent=4)


@query("op12_sentencepiece")
def op12_sentencepiece(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pieces.encode(docs, vocabulary("piece_bpe_32k.model"), ("n_tokens", "ids_sha256", "decoded_sha256"))


@query("op13_whitening")
def op13_whitening(spark, sf_dir):
    white = whitening.whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), components=32)
    return white.select(
        "vec_id", "n", F.expr("try_cast(deviation AS BIGINT)").alias("deviation"), "explained", "identity_error", F.posexplode("whitened").alias("i", "whitened"),
    ).select("vec_id", (F.col("i") + 1).cast("int").alias("component"), "n", "deviation", "whitened", F.get("explained", F.col("i")).alias("explained"), "identity_error")
