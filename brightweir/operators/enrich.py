"""Star counts of code repositories."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from brightweir.functions.urls import repo_key
from brightweir.operators.lookup import key_counts, spread_lookup


def with_stars(
    df: DataFrame, repo: str, own_stars: str, repo_stats: DataFrame, spread_by: Sequence[str]
) -> DataFrame:
    """Add ``stars``: the record's own count, else that of its repository, else null.

    ``repo_stats`` has one row per ``repo_key`` with ``stars``.  Only records
    that have a repository and no count of their own take part in the lookup.
    """
    needed = F.when(F.col(own_stars).isNull(), repo_key(F.col(repo)))
    keyed = df.withColumn("_repo_key", needed)
    stats = repo_stats.select(
        F.col("repo_key").alias("_repo_key"), F.col("stars").cast("bigint").alias("_looked_up")
    )
    # Only repositories that are asked for take part.
    dimension = key_counts(keyed, "_repo_key").join(stats, "_repo_key")
    joined = spread_lookup(keyed, dimension, "_repo_key", spread_by)
    return joined.withColumn("stars", F.coalesce(F.col(own_stars).cast("bigint"), "_looked_up")).drop(
        "_repo_key", "_looked_up"
    )
