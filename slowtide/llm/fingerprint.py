"""Document fingerprints: bottom-k sketches of word-shingle hashes, as column expressions.

A sketch is the ascending array of the k smallest distinct 64-bit shingle hashes. Sketches of parts
merge to the sketch of the whole; resemblance, containment and the number of distinct shingles
follow from sketches alone, exactly while they hold fewer than k hashes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SIZE, SHINGLE_WORDS = 128, 5
_SPACE = r"[\x20\x09-\x0D]+"


def sketch(text: Column, size: int = SIZE, words: int = SHINGLE_WORDS) -> Column:
    """Sketch of the text's shingles; fewer words make one shingle, no word or no text an empty sketch."""
    tokens = F.filter(F.split(F.coalesce(text, F.lit("")), _SPACE), lambda w: w != "")

    def hashes(w: Column) -> Column:
        runs = F.transform(F.sequence(F.lit(0), F.size(w) - words), lambda i: F.xxhash64(*(F.get(w, i + k) for k in range(words))))
        return F.when(F.size(w) >= words, runs).when(F.size(w) > 0, F.array(F.xxhash64(w))).otherwise(F.array().cast("array<bigint>"))

    # One-element array, so that the words are split once and not once for each use.
    return F.get(F.transform(F.array(tokens), lambda w: F.slice(F.array_sort(F.array_distinct(hashes(w))), 1, size)), 0)


def merged(a: Column, b: Column, size: int = SIZE) -> Column:
    """Sketch of both parts together; shingles across the cut belong to neither."""
    return F.slice(F.array_sort(F.array_union(a, b)), 1, size)


def merged_by(df: DataFrame, keys: list[str], sketch_col: str, size: int = SIZE) -> DataFrame:
    """One sketch per key for any number of parts: the smallest hashes by a window that keeps ``size`` rows per group."""
    hashes = df.select(*keys, F.explode(sketch_col).alias("_hash")).distinct()
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy("_hash"))
    return hashes.withColumn("_rank", rank).filter(F.col("_rank") <= size).groupBy(*keys).agg(F.array_sort(F.collect_list("_hash")).alias(sketch_col))


def resemblance(a: Column, b: Column, size: int = SIZE) -> Column:
    """Estimated intersection over union, 0 to 1; two empty sketches are alike."""
    union = merged(a, b, size)
    both = F.size(F.array_intersect(F.array_intersect(union, a), b))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).otherwise(both / F.size(union))


def containment(a: Column, b: Column, size: int = SIZE) -> Column:
    """Estimated share of a's shingles that b has, 0 to 1: of the hashes of ``a`` below both sketches' reach. Empty ``a``: 1."""
    reach = F.least(
        F.when(F.size(a) >= size, F.element_at(a, -1)).otherwise(F.lit((1 << 63) - 1)),
        F.when(F.size(b) >= size, F.element_at(b, -1)).otherwise(F.lit((1 << 63) - 1)),
    )
    seen = F.filter(a, lambda x: x <= reach)
    return F.when(F.size(seen) == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(seen, b)) / F.size(seen))


def distinct_shingles(a: Column, size: int = SIZE) -> Column:
    """Estimated number of distinct shingles: the k-th smallest hash against the range of all."""
    fraction = (F.element_at(a, -1).cast("double") + F.lit(2.0**63)) / F.lit(2.0**64)
    return F.when(F.size(a) < size, F.size(a).cast("double")).otherwise((size - 1) / fraction)


def as_text(a: Column) -> Column:
    """The sketch as one string: 16 hexadecimal digits per hash."""
    return F.array_join(F.transform(a, lambda x: F.lpad(F.hex(x), 16, "0")), "")


def with_next(docs: DataFrame, order_col: str, values: dict[str, Column], tie_col: str) -> DataFrame:
    """``docs`` with each of ``values``, and in ``next_<name>`` its value and that of ``tie_col`` in the next row; the last row's next is the first row.

    Rows are in order of ``order_col`` (whole numbers, nulls first) and of ``tie_col`` where equal. No
    window over all rows: quantiles cut them in ranges, four per shuffle partition, and each range
    gets a copy of the first row after it. ``values`` are computed before the one shuffle.
    """
    n = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = docs.agg(F.percentile_approx(order_col, [k / n for k in range(1, n)], 10 * n)).first()[0] or []
    cuts = sorted(set(found))
    spread = docs.withColumn("_range", _place(F.col(order_col), cuts))
    least = spread.groupBy("_range").agg(F.min(F.coalesce(F.col(order_col), F.lit(-(1 << 63)))).alias("_least"))
    before = Window.orderBy("_range")  # one row per range
    target = least.select("_range", "_least", F.coalesce(F.lag("_range").over(before), F.max("_range").over(Window.partitionBy())).alias("_to"))
    # One row per range, so at most four per shuffle partition and one more.
    heads = spread.join(F.broadcast(target), (spread["_range"] == target["_range"]) & (F.coalesce(spread[order_col], F.lit(-(1 << 63))) == target["_least"]))
    top = F.row_number().over(Window.partitionBy("_to").orderBy(F.col(order_col).asc_nulls_first(), F.col(tie_col).asc_nulls_first()))
    heads = heads.withColumn("_top", top).filter("_top = 1").select(*docs.columns, F.col("_to").alias("_range"))
    rows = spread.withColumn("_copied", F.lit(False)).unionByName(heads.withColumn("_copied", F.lit(True)))
    rows = rows.select("*", *(v.alias(k) for k, v in values.items()))
    within = Window.partitionBy("_range").orderBy("_copied", F.col(order_col).asc_nulls_first(), F.col(tie_col).asc_nulls_first())
    return rows.select("*", *(F.lead(k).over(within).alias(f"next_{k}") for k in (tie_col, *values))).filter("NOT _copied").drop("_copied", "_range")


def _place(value: Column, cuts: list[int]) -> Column:
    """How many cuts are at or below the value, by halving; null: none."""
    if not cuts:
        return F.lit(0)
    steps = F.array(*map(F.lit, cuts))
    halves = F.array(*(F.lit(1 << k) for k in reversed(range(len(cuts).bit_length()))))
    return F.aggregate(halves, F.lit(0), lambda low, half: F.when(F.get(steps, low + half - 1) <= value, low + half).otherwise(low))


def fingerprint_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE, words: int = SHINGLE_WORDS) -> DataFrame:
    """Rows (doc_id, n_chars, edited, sketch, edited_sketch, near_edited, near_next), one for each row of ``docs``.

    ``edited`` is the text with its last half of code points (rounded down) replaced by as many first
    ones of the next document's text, or all of them. Null texts count as empty; other columns are
    ignored. A table of one row is its own next; rows with equal ids follow each other by text.
    """
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = with_next(own, "doc_id", {"sketch": sketch(F.col("text"), size, words)}, "text")
    chars = F.char_length("text")
    half = (chars / 2).cast("int")
    edited = F.concat(F.col("text").substr(F.lit(1), chars - half), F.col("next_text").substr(F.lit(1), half))
    rows = rows.select("doc_id", chars.cast("long").alias("n_chars"), edited.alias("edited"), "sketch", "next_sketch")
    rows = rows.withColumn("edited_sketch", sketch(F.col("edited"), size, words))
    return rows.select(
        "doc_id",
        "n_chars",
        "edited",
        "sketch",
        "edited_sketch",
        resemblance(F.col("sketch"), F.col("edited_sketch"), size).alias("near_edited"),
        resemblance(F.col("sketch"), F.col("next_sketch"), size).alias("near_next"),
    )
