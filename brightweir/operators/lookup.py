"""Planning helpers: lookups safe for hot keys, columns computed once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

# A key that holds more than one in HOT_SHARE rows is spread, so that each part
# holds about that share.  At most HOT_SHARE keys can do so, which bounds what is
# broadcast, and the parts of all of them together are at most twice as many.
HOT_SHARE = 1000
# Rows up to which a dimension is sent to every executor.
BROADCAST_ROWS = 100_000


def computed_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that later steps read instead of recomputing.

    A filter on a computed column is normally pushed below the projection, with
    the whole expression copied into it.  Behind a generator it stays a column.
    """
    made = F.struct(*[c.alias(name) for name, c in columns.items()])
    return df.select("*", F.explode_outer(F.array(made)).alias("_made")).select("*", "_made.*").drop("_made")


def small_or_shuffled(dimension: DataFrame) -> DataFrame:
    """Mark a dimension for broadcast if its counted size allows it."""
    counted = dimension.limit(BROADCAST_ROWS + 1).count()
    return F.broadcast(dimension) if counted <= BROADCAST_ROWS else dimension


def key_counts(df: DataFrame, key: str) -> DataFrame:
    """How many rows each key has (``n_rows``); rows without a key are left out."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"))


def spread_lookup(
    df: DataFrame, dimension: DataFrame, key: str, spread_by: Sequence[str], counts: DataFrame | None = None
) -> DataFrame:
    """Left join on a key some values of which may hold a large share of ``df``.

    ``dimension`` has one row per key, with ``n_rows``: how often the key occurs
    in ``df`` (see ``key_counts``).  Rows of a hot key, and rows without a key,
    are spread by a hash of ``spread_by``, the more ways the more rows there are;
    the dimension rows of hot keys are repeated to match.  A costly dimension is planned once if ``counts`` gives
    the keys and ``n_rows`` apart from it.
    """
    counts = dimension if counts is None else counts
    total = counts.agg(F.sum("n_rows")).scalar()
    # 1 for other keys; a share is rounded up, so a hot key has two ways at least.
    ways = F.greatest(F.lit(1), F.ceil(F.col("n_rows") * HOT_SHARE / total)).cast("int")
    hot = counts.select(key, ways.alias("ways")).where("ways > 1")
    spread = F.pmod(F.xxhash64(*spread_by), F.coalesce("ways", F.lit(HOT_SHARE))).cast("int")

    left = df.join(F.broadcast(hot), key, "left").withColumn(
        "salt", F.when(F.col("ways").isNotNull() | F.col(key).isNull(), spread).otherwise(F.lit(0))
    )
    right = dimension.withColumn("salt", F.explode(F.sequence(F.lit(0), ways - 1))).drop("n_rows")
    return left.drop("ways").join(right, [key, "salt"], "left").drop("salt")


def shuffle_partitions(df: DataFrame) -> int:
    """Partitions for few bytes that mean much work: as configured, and one per core at least."""
    spark = df.sparkSession
    return max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
