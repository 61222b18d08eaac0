"""Connected components of links, and tiles of groups that are too large for one task."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formtide.llm.common import materialise


def local_roots(linked: np.ndarray) -> np.ndarray:
    """Smallest index reachable from every index of a symmetric boolean matrix."""
    roots = np.arange(len(linked))
    while True:
        least = np.where(linked, roots[None, :], len(roots)).min(axis=1, initial=len(roots))
        new = np.minimum(roots, least)
        new = new[new]
        if (new == roots).all():
            return roots
        roots = new


def components(links: DataFrame) -> DataFrame:
    """``node, component`` of links ``a, b`` (long): the smallest node that links lead to.

    Large and small stars by turns; every round's links go to the shared folder, and only their number
    and a checksum reach the driver. Nodes without a link to another one are not in the result.
    """

    def stars(pairs: DataFrame) -> DataFrame:
        both = pairs.select("a", "b").union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.filter("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(least, "a")
        small = joined.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        return small.union(least.select("a", F.col("m").alias("b"))).distinct()

    def checksum(pairs: DataFrame):
        return pairs.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()

    ordered = links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    pairs = materialise(ordered.distinct(), "links")
    before = checksum(pairs)
    while before[0]:
        pairs = materialise(stars(pairs), "links")
        now = checksum(pairs)
        if now == before:
            break
        before = now
    nodes = pairs.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.union(nodes.select("component", "component").distinct())


def tiled(rows: DataFrame, group: list[str], id_column: str, limit: int) -> DataFrame:
    """Rows with the tiles ``tile_i <= tile_j`` in which they meet all other rows of their group.

    A group of up to ``limit`` rows is one tile. A larger one is dealt into parts of about that size by
    a hash of the id, and every pair of parts is a tile. ``part`` tells a row's part.
    """
    sizes = rows.groupBy(*group).agg(F.count("*").alias("_n"))
    parts = F.ceil(F.col("_n") / F.lit(limit)).cast("int")
    own = F.pmod(F.xxhash64(id_column, F.lit(17)), F.col("_parts")).cast("int")
    dealt = rows.join(sizes, group).withColumn("_parts", parts).withColumn("part", own)
    other = F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)).alias("_other")
    dealt = dealt.select("*", other)
    return dealt.select(
        "*", F.least("part", "_other").alias("tile_i"), F.greatest("part", "_other").alias("tile_j")
    ).drop("_n", "_parts", "_other")
