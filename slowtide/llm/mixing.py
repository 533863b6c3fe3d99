"""Mixing sources to target weights by Poisson replication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slowtide.llm.common import beside, stored


def uniform(seed: int, *cols: Column) -> Column:
    """A number in (0, 1) with 52 bits, from a digest of the seed and the columns."""
    text = F.concat_ws(":", F.lit(str(seed)), *cols)
    return (F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def mix(
    docs: DataFrame,
    weights: dict[str, float] | None = None,
    power: float = 0.5,
    epochs: float = 1.0,
    seed: int = 7,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
) -> DataFrame:
    """Documents repeated so that sources reach their target share of the characters, in shuffled order.

    ``weights`` are target shares by source (scaled to 1; sources without one are left out, as asked
    for); without them a source's share is its characters to the ``power``. The mean repetition rate
    of a source is epochs * all characters * share / its characters; a source without any
    characters keeps each document once. How often a document comes is the inverse of the Poisson
    distribution with that mean at a number drawn from the seed, its id and a digest of its text; rows
    that repeat both draw each for themselves, by their place in the input. Adds ``copy`` (1, 2, …) and ``shuffle_key``; rows are ordered by it, which is independent
    of the source. Null ids and sources are values like others (null source: a source of its own
    that ``weights`` cannot name), null texts have no characters. Empty tables give no rows. Input
    columns named ``copy`` or ``shuffle_key`` come out with ``_input`` added to their name.

    The distribution is tabulated once per source, in logarithms, as far as 12 deviations and 30
    more above the mean; only that table is joined to the documents.
    """
    names = beside(docs.columns, {"copy", "shuffle_key"})
    # Under private names no column clashes with those made here.
    columns = [f"in_{k}" for k in range(len(names))]
    private = dict(zip((c.lower() for c in docs.columns), columns, strict=True))
    docs, id_col, source_col, text_col = docs.toDF(*columns), *(private[c.lower()] for c in (id_col, source_col, text_col))
    sizes = stored(
        docs.groupBy(F.col(source_col).alias("_source")).agg(F.sum(F.coalesce(F.char_length(text_col), F.lit(0))).cast("double").alias("_chars")), "source-sizes"
    )
    if weights is None:
        shares = sizes.withColumn("_weight", F.pow(F.col("_chars"), F.lit(power)))
    else:
        if not weights or min(weights.values()) < 0 or sum(weights.values()) <= 0:
            raise ValueError("weights must not be negative, and some must be above zero")
        named = docs.sparkSession.createDataFrame([(k, float(v)) for k, v in weights.items()], "_source string, _weight double")
        shares = sizes.join(named, "_source")
    all_chars, all_weights = sizes.agg(F.sum("_chars")).first()[0], shares.agg(F.sum("_weight")).first()[0]
    mean = F.lit(epochs * (all_chars or 0.0)) * F.col("_weight") / F.lit(all_weights or 1.0) / F.col("_chars")
    rates = shares.select("_source", F.when(F.col("_chars") == 0, F.lit(1.0)).otherwise(mean).alias("_rate"))
    tables = rates.filter("_rate > 0").select("_source", F.expr(_CDF).alias("_cdf"))
    digest = F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary"))
    docs = docs.withColumn("_row", F.concat_ws(":", F.coalesce(F.col(id_col).cast("string"), F.lit("")), digest))
    # Only rows that repeat need a number of their own; the table of them is stored, so that its size decides how it is joined.
    repeats = stored(docs.groupBy(F.xxhash64("_row").alias("_again")).agg(F.count("*").alias("_n")).filter("_n > 1").select("_again"), "mix-repeats")
    numbered = docs.withColumn("_place", F.monotonically_increasing_id()).join(repeats, F.xxhash64("_row") == F.col("_again"), "left")
    place = F.when(F.col("_again").isNotNull(), F.col("_place").cast("string"))
    docs = numbered.withColumn("_row", F.concat_ws(":", "_row", place)).drop("_place", "_again")
    drawn = uniform(seed, F.col("_row"))
    joined = docs.join(tables, docs[source_col].eqNullSafe(tables["_source"])).withColumn("_u", drawn)
    copies = joined.withColumn("_copies", F.size(F.filter("_cdf", lambda p: p < F.col("_u"))))
    repeated = copies.filter("_copies > 0").select(*columns, "_row", F.explode(F.sequence(F.lit(1), "_copies")).alias("copy"))
    key = F.concat_ws(":", F.lit(str(seed)), "_row", F.col("copy").cast("string"))
    ordered = repeated.withColumn("shuffle_key", F.substring(F.md5(key.cast("binary")), 1, 16)).drop("_row").orderBy("shuffle_key", id_col, "copy")
    return ordered.toDF(*names, "copy", "shuffle_key")


#: P(count <= k) for k = 0, 1, …, from the logarithm of P(count = k), which cannot underflow on the way.
_CDF = """
aggregate(
    sequence(1, cast(ceil(_rate + 12 * sqrt(_rate) + 30) as int)),
    named_struct('log', -_rate, 'sum', exp(-_rate), 'cdf', array(exp(-_rate))),
    (a, k) -> named_struct(
        'log', a.log + ln(_rate / k),
        'sum', a.sum + exp(a.log + ln(_rate / k)),
        'cdf', concat(a.cdf, array(a.sum + exp(a.log + ln(_rate / k))))),
    a -> a.cdf)
"""
