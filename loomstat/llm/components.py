"""Connected components of a link table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomstat.session import ensure_checkpoint_dir


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """One step: hang every node's larger (or smaller and own) neighbours on its least neighbour.

    The least neighbour is a grouped minimum, combined before the shuffle; a node with very many
    neighbours only meets its own one-row minimum in a join that Spark may split.
    """
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    # in the small step each edge runs from its larger to its smaller end
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    joined = both.join(least, "u")
    if large:
        out = joined.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            least.select("u", F.col("m").alias("v"))
        )
    return out.filter(F.col("u") != F.col("v")).distinct()


def components(links: DataFrame) -> DataFrame:
    """``(u, v)`` links to ``(u, v)`` rows that hang each node on the least node of its component.

    Nodes may be of any type with an order; the least node itself has no row. Self-links and repeated
    links change nothing; an empty table gives an empty one. The steps go on until the edges are stars,
    which they become after a number of steps that grows as the logarithm of the nodes. Every step is written to the checkpoint
    folder, so neither the plan nor what a lost executor costs grows with the number of steps.
    """
    ensure_checkpoint_dir(links.sparkSession)
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    edges = down.filter(F.col("u") != F.col("v")).distinct().checkpoint()
    sign = None
    while True:
        edges = _stars(_stars(edges, True), False).checkpoint()
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")))
        now = tuple(now.first())
        if now == sign:
            return edges
        sign = now
