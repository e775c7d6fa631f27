"""Connected components of a table of links, and the written tables the steps read."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from brightweir.session import scratch_path


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back, which cuts the lineage."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def components(links: DataFrame) -> DataFrame:
    """Per linked node the smallest node it is connected to: ``node``, ``root``.

    ``links`` has two columns of bigint, ``a`` and ``b``.  In each round a node
    takes over the smallest root among its neighbours, and then the root of its
    root; so rounds grow with the logarithm of the longest path.  Minima combine
    before they are shuffled, so a node with very many links is no hot key there.
    """
    both = links.where("a <> b").select("a", "b")
    both = written(both.union(both.select("b", "a")).distinct(), "component-links")
    roots = written(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low")).select("node", F.least("node", "low").alias("root")), "component-roots")
    while True:
        seen = both.join(roots.select(F.col("node").alias("b"), F.col("root").alias("low")), "b").groupBy(F.col("a").alias("node")).agg(F.min("low").alias("low"))
        nearer = roots.join(seen, "node").select("node", "root", F.least("root", "low").alias("near"))
        # The old root learns of the new one, so that whole components move at once.
        told = nearer.where("near < root").groupBy(F.col("root").alias("node")).agg(F.min("near").alias("told"))
        moved = nearer.join(told, "node", "left").select("node", "root", F.least("near", "told").alias("near"))
        parents = moved.select(F.col("node").alias("near"), F.col("near").alias("further"))
        after = written(
            moved.join(parents, "near", "left").select("node", "root", F.least("near", F.coalesce("further", "near")).alias("now")), "component-roots"
        )
        roots = after.select("node", F.col("now").alias("root"))
        if after.where("now < root").limit(1).count() == 0:
            return roots
