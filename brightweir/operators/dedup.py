"""First-wins deduplication, ledgers and idempotent appends.

Spark rows have no arrival order, so every operator takes the columns that
define it.  Together these columns must identify a row.

No operator here sends all rows of a key to one task: survivors come from
aggregates that combine before the shuffle, and flags are joined back on the
order columns, which are unique, never on the key, which may be hot.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from brightweir.functions.urls import canonical_url, url_key
from brightweir.operators.lookup import small_or_shuffled
from brightweir.session import scratch_path


def _order(columns: Sequence[str]) -> Column:
    return F.col(columns[0]) if len(columns) == 1 else F.struct(*columns)


def first_wins(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """One row per key: the earliest."""
    rest = [c for c in df.columns if c != key]
    kept = df.groupBy(key).agg(F.min_by(F.struct(*rest), _order(order)).alias("row"))
    return kept.select(key, "row.*").select(*df.columns)


def mark_repeats(df: DataFrame, key: str, order: Sequence[str], flag: str = "is_repeat") -> DataFrame:
    """Every row, with a flag that is false on the earliest row of its key."""
    firsts = df.groupBy(key).agg(F.min(_order(order)).alias("first"))
    values = [F.col("first")] if len(order) == 1 else [F.col(f"first.{c}") for c in order]
    names = [f"_first_{i}" for i in range(len(order))]
    firsts = firsts.select(F.col(key).alias("_first_key"), *[v.alias(n) for v, n in zip(values, names)], F.lit(False).alias("_is_first"))
    # Null order values are no repeats by themselves; the key tells such rows of two keys apart.
    same = df[key].eqNullSafe(F.col("_first_key"))
    for column, name in zip(order, names):
        same = same & df[column].eqNullSafe(F.col(name))
    marked = df.join(firsts, same, "left")
    return marked.select(*[df[c] for c in df.columns], F.coalesce("_is_first", F.lit(True)).alias(flag))


def new_rows(df: DataFrame, ledger: DataFrame, key: str) -> DataFrame:
    """Rows whose key the ledger does not hold."""
    return df.join(ledger.select(key), key, "left_anti")


def _held(ledger: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """The keys of a ledger that a batch has too; the ledger is not shuffled while the counted batch is small."""
    return ledger.select(key).join(small_or_shuffled(rows.select(key).distinct()), key, "left_semi")


def append_new(rows: DataFrame, path: str, key: str, partition_by: Sequence[str] = ()) -> None:
    """Append rows with distinct keys that the table does not hold yet.

    The table is usually far larger than a batch.  Its keys are first reduced
    to those of the batch, which needs no shuffle of the table while the
    counted batch is small enough to be broadcast.
    """
    existing = read_table(rows.sparkSession, path)
    if existing is not None:
        rows = new_rows(rows, _held(existing, rows, key), key)
    rows.write.mode("append").partitionBy(*partition_by).parquet(path)


def unseen_urls(df: DataFrame, url: str, ledger: DataFrame) -> DataFrame:
    """Rows whose canonical URL has not been processed yet."""
    keyed = df.withColumn("url_hash", url_key(F.col(url)))
    return new_rows(keyed, _held(ledger, keyed, "url_hash"), "url_hash")


def url_ledger(df: DataFrame, url: str, source: Column, processed_at: Column, order: Sequence[str]) -> DataFrame:
    """Processed-URL rows: the first spelling and source per canonical URL."""
    rows = df.select(
        *order,
        F.sha2(canonical_url(F.col(url)), 256).alias("url_hash"),
        F.col(url).alias("url"),
        source.alias("source_name"),
        processed_at.alias("processed_at"),
    )
    return first_wins(rows, "url_hash", order).select("url_hash", "url", "source_name", "processed_at")


def accounting(df: DataFrame, key: str, order: Sequence[str], source: str, ledger: DataFrame | None = None) -> DataFrame:
    """Per source: rows read, rows inserted, duplicates (of each other or of the ledger)."""
    read = df.groupBy(source).agg(F.count(F.lit(1)).alias("n_read"))
    winners = first_wins(df.select(key, *order, source), key, order)
    if ledger is not None:
        winners = new_rows(winners, ledger, key)
    inserted = winners.groupBy(source).agg(F.count(F.lit(1)).alias("n_inserted"))
    joined = read.join(inserted, source, "left")
    n_inserted = F.coalesce("n_inserted", F.lit(0))
    return joined.select(
        source, "n_read", n_inserted.alias("n_inserted"), (F.col("n_read") - n_inserted).alias("n_duplicates")
    )


def read_table(spark: SparkSession, path: str) -> DataFrame | None:
    """A Parquet table, or None where nothing has been written yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def upsert(df: DataFrame, path: str, key: str, order: Sequence[str], partition_by: Sequence[str] = ()) -> dict[str, int]:
    """Append the rows whose key the table does not hold yet; first arrival wins.

    Running the same batch again inserts nothing.  The table must have a single
    writer.  The batch is evaluated once: its winners are written to the shared
    folder with the number of rows each stands for.  Counts come from committed
    files, so retried tasks cannot distort them.
    """
    spark = df.sparkSession
    rest = [c for c in df.columns if c != key]
    winners = df.groupBy(key).agg(F.min_by(F.struct(*rest), _order(order)).alias("row"), F.count(F.lit(1)).alias("arrivals"))
    scratch = scratch_path(spark, "winners")
    winners.write.parquet(scratch)
    winners = spark.read.parquet(scratch)
    existing = read_table(spark, path)
    before = existing.count() if existing is not None else 0
    append_new(winners.select(key, "row.*").drop(*order), path, key, partition_by)
    inserted = spark.read.parquet(path).count() - before
    read = winners.agg(F.coalesce(F.sum("arrivals"), F.lit(0))).first()[0]
    return {"inserted": inserted, "duplicates": read - inserted}
