"""From documents to token ids: language, boilerplate lines, near duplicates, source mix, encoding.

Each stage takes (spark, docs, sf_dir) and returns a table that is written and read again as the next
stage's docs; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slowtide.llm import bpe, jaccard, language, lines, mixing
from slowtide.llm.catalog import BOILERPLATE_PAGES, BOILERPLATE_RATIO, MIX_POWER, MIX_SEED, tokenizer_path
from slowtide.llm.common import stored, table


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
COLUMNS = {"doc_id", "text", "lang", "source", "n_chars"}


def extras_apart(stage: Stage) -> Stage:
    """The stage, with other columns than those of ``documents`` under private names while it runs."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        private = [c if c.lower() in COLUMNS else f"extra_{k}" for k, c in enumerate(docs.columns)]
        return stage(spark, docs.toDF(*private), sf_dir).toDF(*docs.columns)

    return run_stage


@extras_apart
def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``lang`` becomes the predicted language; documents without letters or with an ambiguous language go.

    The model learns from the documents' own labels, outside the held-out fold; a table without labels
    teaches nothing, so all of it goes.
    """
    model = language.fit(docs)
    known = language.predict(docs, model).filter((F.col("lang_pred") != language.UNKNOWN) & ~F.col("ambiguous"))
    return known.withColumn("lang", F.col("lang_pred")).select(docs.columns)


@extras_apart
def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines of a source leave the text; ``n_chars`` follows. Every document stays.

    Rows come from a join by source; they are dealt anew, or a large source would make large files and tasks of later stages.
    """
    cleaned = lines.drop_boilerplate_lines(docs, BOILERPLATE_RATIO, BOILERPLATE_PAGES)
    return cleaned.withColumn("n_chars", F.char_length("text").cast("long")).select(docs.columns).repartition("doc_id", "text")


@extras_apart
def join_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by word 5-grams of Jaccard similarity 0.8 or more the row of smallest doc_id stays.

    Rows of equal id and text are one document. Rows without id are members like others and stay only where
    no member has an id, one of them; texts without words link with nothing. Of one id, any one text stays.
    """
    rows = docs.withColumn("_row", F.xxhash64("doc_id", "text"))
    groups = jaccard.jaccard_components(rows, id_col="_row").select(F.col("doc_id").alias("_row"), F.col("component_id").alias("_group"))
    members = rows.select("doc_id", "_row").distinct().join(groups.distinct(), "_row")
    heads = members.groupBy("_group").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "_row")).alias("head"))
    return rows.join(heads.select("head._row"), "_row").dropDuplicates(["_row"]).select(docs.columns)


@extras_apart
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated towards the sources' target shares, in globally shuffled order."""
    return mixing.mix(docs, power=MIX_POWER, seed=MIX_SEED).select(docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, their number, and a digest of what they decode to."""
    return bpe.encode_documents(docs, tokenizer_path(), ["n_tokens", "ids", "decoded_sha256"], ["doc_id", "lang", "source"])


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", drop_lines),
    ("ngram_jaccard_join", join_near_duplicates),
    ("mix_sources", mix_sources),
    ("bpe_encode", encode),
]

#: SQL has no counterpart of the learned language model nor of the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
