"""Run metrics: what was read, kept, repeated and rejected."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def ingest_metrics(judged: DataFrame) -> DataFrame:
    """Per vertical: discovered = valid + duplicates + rejected.

    ``judged`` has every row read, with its ``vertical``, a rejection ``reason``
    (null when accepted) and the ``hash_key`` of accepted rows.
    """
    accepted = F.col("reason").isNull()
    counts = judged.groupBy("vertical").agg(
        F.count(F.lit(1)).alias("discovered"),
        F.countDistinct(F.when(accepted, F.col("hash_key"))).alias("valid"),
        F.sum(F.when(accepted, F.lit(0)).otherwise(F.lit(1))).alias("rejected"),
    )
    return counts.select(
        "vertical",
        "discovered",
        "valid",
        (F.col("discovered") - F.col("valid") - F.col("rejected")).alias("duplicates"),
        "rejected",
    )


def rejections(judged: DataFrame) -> DataFrame:
    """Rejected rows per vertical and reason."""
    return judged.where("reason is not null").groupBy("vertical", "reason").agg(F.count(F.lit(1)).alias("n_rows"))


def with_totals(metrics: DataFrame, elapsed_seconds: Column) -> DataFrame:
    """Metrics per vertical and in total (``ALL``), with records per second."""
    totals = metrics.rollup("vertical").agg(
        F.grouping("vertical").alias("is_total"),
        *[F.sum(c).alias(c) for c in ("discovered", "valid", "duplicates", "rejected")],
    )
    name = F.when(F.col("is_total") == 1, F.lit("ALL")).otherwise(F.col("vertical"))
    throughput = F.col("valid") / F.greatest(F.lit(0.1), elapsed_seconds.cast("double"))
    return totals.withColumn("vertical", name).withColumn("throughput", throughput).drop("is_total")


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count of each table; an empty table counts zero."""
    counted = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
               for name, df in tables.items()]
    return reduce(DataFrame.unionByName, counted)
