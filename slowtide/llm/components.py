"""Connected components of a graph given by its links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slowtide.llm.common import stored

#: Rounds after which a graph must have settled; alternating stars take about log2 of the longest path.
MOST_ROUNDS = 60
#: Links that a round writes to a file, about.
LINKS_PER_FILE = 1 << 18


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Rows (node, root) for every node with a link to another one; root is the smallest node that can be reached.

    Alternates two steps until nothing changes: every node's larger neighbours are hung to its smallest
    one, then its smaller neighbours are. Minima are partial sums before the shuffle, joins split hot
    nodes, each round is written to the shared folder, in as many files as the links need; the driver
    sees counts only. Nulls link nothing.
    """
    edges = stored(
        links.filter(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "links"
    )
    state = _state(edges)
    for _ in range(MOST_ROUNDS):
        if not state[0]:
            break
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small_least = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(small_least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        own = small_least.select("u", F.col("m").alias("v"))
        # No round has more links than the one before.
        files = -(-state[0] // LINKS_PER_FILE)
        edges = stored(hung.unionByName(own).filter("u != v").distinct().coalesce(files), "links")
        before, state = state, _state(edges)
        if before == state:
            break
    else:
        raise RuntimeError("components did not settle")
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.shiftright(F.xxhash64("v", "u"), 24))).first()
    return tuple(row)
