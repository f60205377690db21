"""Connected components of a graph whose links lie in a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmill.llm.base import saved


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node with a link; the root is the smallest node reachable.

    ``links`` has long columns a and b. Stars are made in turn around the larger
    and the smaller neighbours of each node, until nothing changes. Each step is
    a minimum per node, combined before it is shuffled, and a join with it, so a
    node with very many neighbours is never gathered in one place.
    """
    known = saved(_down(links), "links")
    while True:
        large = _stars(known.unionByName(known.select(F.col("b").alias("a"), F.col("a").alias("b"))), True)
        after = saved(_down(_stars(large, False)), "links")
        if _same(known, after):
            return after.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                after.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        known = after


def _down(links: DataFrame) -> DataFrame:
    """Each link once, from its larger to its smaller end."""
    return (
        links.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )


def _stars(links: DataFrame, large: bool) -> DataFrame:
    """Links a node's larger (else smaller) neighbours to the smallest one it knows of."""
    least = links.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    joined = links.join(least, "a")
    if large:
        return joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
        least.select("a", F.col("m").alias("b"))
    )


def _same(one: DataFrame, other: DataFrame) -> bool:
    """Both are sets of links: equal when counts and checksums are."""
    digest = [F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a"))]
    return one.agg(*digest).first() == other.agg(*digest).first()
