"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from brightweir.llm.common import staged


def _lowest(links: DataFrame) -> DataFrame:
    return links.groupBy("a").agg(F.min("b").alias("low"))


def _step(links: DataFrame) -> DataFrame:
    """Point larger neighbours at the smallest, then each node at the smallest it points to."""
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    large = both.join(_lowest(both), "a").where("b > a").select(F.col("b").alias("a"), F.least("a", "low").alias("b"))
    low = _lowest(large)
    moved = large.join(low, "a").where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return moved.union(low.select("a", F.col("low").alias("b"))).distinct()


def _mark(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())


def members(links: DataFrame) -> DataFrame:
    """Per linked node ``member`` the smallest node it is connected to, ``root``.

    ``links`` has two columns of long, ``a`` and ``b``; their order and repeats
    do not matter.  Every step is written to the shared folder; the number of
    steps grows with the logarithm of the longest path.
    """
    links = staged(links.where("a <> b").select("a", "b").distinct(), "links")
    mark = _mark(links)
    while True:
        links = staged(_step(links), "links")
        mark, last = _mark(links), mark
        if mark == last:
            break
    roots = links.select(F.col("b").alias("member"), F.col("b").alias("root")).distinct()
    return links.select(F.col("a").alias("member"), F.col("b").alias("root")).union(roots)
