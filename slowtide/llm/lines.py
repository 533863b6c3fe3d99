"""Line dedup by site-relative frequency."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def drop_boilerplate_lines(
    docs: DataFrame, ratio: float = 0.08, least_pages: int = 5, host_col: str = "source", text_col: str = "text"
) -> DataFrame:
    """``docs`` with boilerplate lines taken out of the text, and columns ``n_lines`` and ``n_dropped``.

    A line is boilerplate on a host if it stands on at least ``least_pages`` of the host's pages and
    on more than ``ratio`` of them; a page counts once however often it has the line. Lines are
    what stands between line feeds, compared whole. Lines of nothing but spaces are never counted
    nor dropped. Rows without host form no site and stay as they are, null texts stay null with
    no lines, a text can become empty but its row stays. Repeated rows are pages of their own.

    Lines are counted as 64-bit hashes with partial sums, so a hot host or line moves one row per
    task. A host has at most (lines per page) / ratio boilerplate lines, so its list is short, and
    the list is joined to the pages; a hot host's pages are split by the skew join.
    """
    columns = docs.columns
    taken = {c.lower() for c in columns}
    if clash := taken & {"n_lines", "n_dropped", "_host", "_boilerplate"}:
        raise ValueError(f"columns clash with outputs: {sorted(clash)}")
    host, lines = F.col(host_col).cast("string"), F.split(F.col(text_col), "\n", -1)
    pages = docs.filter(host.isNotNull()).select(host.alias("_host"), F.col(text_col).alias("_text"))
    totals = pages.groupBy("_host").agg(F.count("*").alias("_pages"))
    hashes = F.array_distinct(F.transform(F.filter(F.split("_text", "\n", -1), lambda x: F.trim(x) != ""), lambda x: F.xxhash64(x)))
    on_pages = (
        pages.select("_host", F.explode(hashes).alias("_line"))
        .groupBy("_host", "_line")
        .agg(F.count("*").alias("_n"))
        .filter(F.col("_n") >= least_pages)
    )
    boilerplate = (
        on_pages.join(totals, "_host")
        .filter(F.col("_n") > ratio * F.col("_pages"))
        .groupBy("_host")
        .agg(F.collect_list("_line").alias("_boilerplate"))
    )
    joined = docs.withColumn("_host", host).join(boilerplate, "_host", "left")
    kept = F.filter(lines, lambda x: (F.trim(x) == "") | ~F.array_contains("_boilerplate", F.xxhash64(x)))
    cleaned = F.when(F.col("_boilerplate").isNull(), F.col(text_col)).otherwise(F.array_join(kept, "\n"))
    n_lines = F.coalesce(F.size(lines), F.lit(0)).cast("long")
    n_kept = F.when(F.col("_boilerplate").isNull(), n_lines).otherwise(F.coalesce(F.size(kept), F.lit(0)).cast("long"))
    n_lines = F.when(F.col(text_col).isNull(), F.lit(0).cast("long")).otherwise(n_lines)
    n_kept = F.when(F.col(text_col).isNull(), F.lit(0).cast("long")).otherwise(n_kept)
    return joined.select(
        *(cleaned.alias(c) if c.lower() == text_col.lower() else F.col(c) for c in columns),
        n_lines.alias("n_lines"),
        (n_lines - n_kept).alias("n_dropped"),
    )
