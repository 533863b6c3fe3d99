"""Queries of the training-data operators, and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slowtide.llm import bpe, chat, fingerprint, jaccard, language, lines, mixing, neardup, periodic, search, substrings, tokencount, warc
from slowtide.llm.common import table
from slowtide.session import fresh_folder

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

TOKENIZER = "word_bpe_49k.json"
BOILERPLATE_RATIO, BOILERPLATE_PAGES = 0.08, 5
MIX_POWER, MIX_SEED = 0.5, 7


def tokenizer_path() -> str:
    return public_tokenizers.path(TOKENIZER)


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


@query("op1_jaccard_join")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_join(table(spark, sf_dir, "documents"), num=90, den=100, words=3)


@query("op2_bpe_round_trip")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(table(spark, sf_dir, "documents"), tokenizer_path(), ["n_tokens", "ids_sha256", "decoded_sha256"], ["doc_id"])


# Ids are distinct in the given tables, so no row needs the number that repeated rows get.
MIX_SQL = f"""
WITH sizes AS (SELECT source, CAST(sum(coalesce(length(text), 0)) AS DOUBLE) AS chars FROM documents GROUP BY source),
rates AS (
    SELECT source, CASE WHEN chars = 0 THEN 1.0
        ELSE (SELECT sum(chars) FROM sizes) * pow(chars, {MIX_POWER}) / (SELECT sum(pow(chars, {MIX_POWER})) FROM sizes) / chars END AS rate FROM sizes),
steps AS (SELECT source, rate, unnest(generate_series(0, CAST(ceil(rate + 12 * sqrt(rate) + 30) AS BIGINT))) AS k FROM rates),
cdf AS (SELECT source, sum(exp(k * ln(rate) - rate - lgamma(k + 1))) OVER (PARTITION BY source ORDER BY k) AS p FROM steps),
tables AS (SELECT source, list(p) AS ps FROM cdf GROUP BY source),
drawn AS (
    SELECT d.*, len(list_filter(ps, lambda p: p < (CAST('0x' || substr(md5('{MIX_SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))), 1, 13) AS BIGINT) + 0.5) / 4503599627370496.0)) AS copies
    FROM documents d JOIN tables t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, text, lang, source, n_chars, CAST(copy AS INTEGER) AS copy,
       substr(md5('{MIX_SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, '')) || ':' || copy), 1, 16) AS shuffle_key
FROM (SELECT *, unnest(generate_series(1, copies)) AS copy FROM drawn)
"""


@query("op3_mix_sources", MIX_SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), power=MIX_POWER, seed=MIX_SEED)


CHAT_SQL = """
WITH own AS (SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
numbered AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos FROM own),
prefixes AS (
    SELECT conv_id, pos, count(*) OVER (PARTITION BY conv_id) AS n_turns,
           string_agg('<|' || role || '|>' || chr(10) || text || chr(10), '') OVER (PARTITION BY conv_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS chat,
           list(struct_pack(r := role, t := text)) OVER (PARTITION BY conv_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS turns
    FROM numbered),
whole AS (SELECT min(conv_id) AS conv_id, n_turns, any_value(chat) AS chat, turns FROM prefixes WHERE pos = n_turns GROUP BY turns, n_turns)
SELECT conv_id, n_turns, chat FROM whole WHERE turns NOT IN (SELECT turns FROM prefixes WHERE pos < n_turns)
"""


@query("op4_format_chats", CHAT_SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_conversations(table(spark, sf_dir, "conversations"))


@query("op5_fingerprints")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    edits = fingerprint.fingerprint_edits(table(spark, sf_dir, "documents"))
    return edits.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprint.as_text(F.col("sketch")).alias("fingerprint"),
        fingerprint.as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )


@query("op6_language_id")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language.fit(docs)
    known = language.predict(docs.select("doc_id", "text"), model)
    return known.select("doc_id", (language.fold_of() == 2).alias("held_out"), "lang_pred", "score", "ambiguous")


@query("op7_near_vectors")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "embeddings"))


@query("op8_substring_dedup")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(table(spark, sf_dir, "documents"), ["n_words", "n_removed", "kept_sha256"])


LINES_SQL = f"""
WITH pages AS (SELECT source, count(*) AS n FROM documents WHERE source IS NOT NULL GROUP BY source),
seen AS (SELECT source, unnest(list_distinct(string_split(text, chr(10)))) AS line FROM documents WHERE source IS NOT NULL AND text IS NOT NULL),
boilerplate AS (
    SELECT source, list(line) AS b
    FROM (SELECT source, line, count(*) AS k FROM seen WHERE trim(line) <> '' GROUP BY source, line) JOIN pages USING (source)
    WHERE k >= {BOILERPLATE_PAGES} AND k > {BOILERPLATE_RATIO}::DOUBLE * n GROUP BY source),
cut AS (
    SELECT doc_id, d.source, text, string_split(text, chr(10)) AS was,
           list_filter(string_split(text, chr(10)), lambda l: b IS NULL OR trim(l) = '' OR NOT list_contains(b, l)) AS kept
    FROM documents d LEFT JOIN boilerplate ON d.source = boilerplate.source)
SELECT doc_id, source, CASE WHEN text IS NOT NULL THEN array_to_string(kept, chr(10)) END AS text,
       CAST(coalesce(len(was), 0) AS BIGINT) AS n_lines, CAST(coalesce(len(was) - len(kept), 0) AS BIGINT) AS n_dropped
FROM cut
"""


@query("op9_line_dedup", LINES_SQL)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return lines.drop_boilerplate_lines(docs, BOILERPLATE_RATIO, BOILERPLATE_PAGES)


@query("op10_token_counts")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.token_counts(table(spark, sf_dir, "documents"), tokenizer_path())


@query("op11_periodic_runs")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return periodic.runs_report(docs.withColumn("text", periodic.stuttered(F.col("text"), F.col("doc_id"))))


WARC_SQL = f"""
WITH sized AS (SELECT page_id, coalesce(html, '') AS html, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes FROM pages),
heads AS (SELECT *, CASE WHEN payload_bytes >= {warc.LEAST_BYTES} THEN max(page_id) OVER (PARTITION BY html) END AS head FROM sized),
typed AS (SELECT *, CASE WHEN head IS DISTINCT FROM page_id THEN head END AS refers_to FROM heads)
SELECT page_id, payload_bytes, sha1(html) AS payload_digest, CASE WHEN refers_to IS NULL THEN 'response' ELSE 'revisit' END AS record_type, refers_to
FROM typed
"""


@query("op12_warc_round_trip", WARC_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_folder(spark, "warc")
    warc.write_pages(table(spark, sf_dir, "pages"), path)
    return warc.page_report(warc.read_archives(spark, path))


SEARCH_SQL = r"""
WITH lowered AS (SELECT doc_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
split AS (SELECT doc_id, regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM lowered WHERE text IS NOT NULL),
docs AS (SELECT row_number() OVER () AS r, doc_id, terms, CAST(len(terms) AS BIGINT) AS n FROM split WHERE len(terms) > 0),
corpus AS (SELECT CAST(count(*) AS BIGINT) AS big_n, CAST(sum(n) AS BIGINT) AS big_l FROM docs),
wanted AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                       '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
postings AS (SELECT r, doc_id, n, term, CAST(count(*) AS BIGINT) AS tf FROM (SELECT r, doc_id, n, unnest(terms) AS term FROM docs)
             WHERE term IN (SELECT term FROM wanted) GROUP BY r, doc_id, n, term),
weights AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * big_n + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w FROM postings, corpus GROUP BY term, big_n),
scored AS (
    SELECT item_id, r, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * big_n) // big_l)))) AS BIGINT) AS score
    FROM wanted JOIN postings USING (term) JOIN weights USING (term), corpus GROUP BY item_id, r, doc_id),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""


@query("op13_ranked_search", SEARCH_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)
