"""Exact duplicates by an index of cuckoo filters.

Texts are equal when they agree without white space; the SHA-256 of what is
left is the digest of a text.  The index deals the digests into buckets.  Each
bucket has a cuckoo filter and the stored keys behind it: a digest the filter
does not hold is new, a hit is verified against the keys of the bucket, and a
filter that overflows is built again, twice as large, from the stored keys.
Digests can be inserted, looked up and deleted.

Of equal texts the one with the most code points stays, then the smallest
document id (null last), then the first row, so of repeated rows one stays.
A null text counts as empty; an empty table gives an empty result.  Only
``doc_id`` and ``text`` are read; other columns may have any name.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from brightweir.llm.common import WHITE, empty, row_numbered, staged, whole_text
from brightweir.operators.lookup import spread_lookup

# Digests a bucket is meant to hold, and ways a digest is split before it is counted.
KEYS_PER_BUCKET = 50_000
WAYS = 32

KEY = "bucket int, digest binary, n_rows bigint, n_chars bigint, doc_id bigint, row_id bigint"
STATE = "kind string, " + KEY + ", slots binary"
_KEY_NAMES = [column.split()[0] for column in KEY.split(", ")]


class CuckooFilter:
    """A set of 64-bit hashes that may say yes for an absent one, never no for a present one.

    Four 16-bit marks per slot row; the two rows of a hash are told from each
    other by its mark, so a mark can be moved or removed without the hash.
    """

    ROW = 4
    MOVES = 500

    def __init__(self, rows: int) -> None:
        self.slots = np.zeros((rows, self.ROW), np.uint16)

    @classmethod
    def sized(cls, keys: int) -> CuckooFilter:
        """Room for a number of keys at most 80 per cent full."""
        return cls(1 << max(2, int(np.ceil(np.log2(max(1, keys) / (0.8 * cls.ROW))))))

    @classmethod
    def loaded(cls, slots: bytes) -> CuckooFilter:
        made = cls(0)
        made.slots = np.frombuffer(slots, np.uint16).reshape(-1, cls.ROW).copy()
        return made

    def _places(self, key: int) -> tuple[int, int, int]:
        mask = len(self.slots) - 1
        mark = (key >> 48) or 1
        row = key & mask
        return mark, row, self._other(row, mark)

    def _other(self, row: int, mark: int) -> int:
        return row ^ ((mark * 0x5BD1E995 >> 7) & (len(self.slots) - 1))

    def __contains__(self, key: int) -> bool:
        mark, a, b = self._places(key)
        return mark in self.slots[a].tolist() or mark in self.slots[b].tolist()

    def _put(self, row: int, mark: int) -> bool:
        for i, held in enumerate(self.slots[row].tolist()):
            if not held:
                self.slots[row, i] = mark
                return True
        return False

    def insert(self, key: int) -> bool:
        """Add a hash; False if there is no room, when the filter must be built again."""
        mark, a, b = self._places(key)
        if self._put(a, mark) or self._put(b, mark):
            return True
        row = b
        for turn in range(self.MOVES):
            i = (turn * 7 + mark) % self.ROW
            mark, self.slots[row, i] = int(self.slots[row, i]), mark
            row = self._other(row, mark)
            if self._put(row, mark):
                return True
        return False

    def delete(self, key: int) -> None:
        """Remove one mark of a hash that was inserted."""
        mark, a, b = self._places(key)
        for row in (a, b):
            held = self.slots[row].tolist()
            if mark in held:
                self.slots[row, held.index(mark)] = 0
                return


def hash_of(digest: bytes) -> int:
    return int.from_bytes(digest[-8:], "little")


class Bucket:
    """A filter and the keys behind it."""

    def __init__(self, keys: pd.DataFrame, slots: bytes | None, expected: int = 0) -> None:
        # One list per digest: rows, code points, document and row of the one that stays.
        self.keys = {bytes(d): list(rest) for d, *rest in keys[_KEY_NAMES[1:]].itertuples(index=False)}
        if slots is None:
            self.filter = CuckooFilter.sized(len(self.keys) + expected)
            self._fill(self.filter)
        else:
            self.filter = CuckooFilter.loaded(slots)

    def _fill(self, filter_: CuckooFilter) -> bool:
        return all(filter_.insert(hash_of(d)) for d in self.keys)

    def holds(self, digest: bytes) -> bool:
        """A hit of the filter that the stored keys confirm."""
        return hash_of(digest) in self.filter and digest in self.keys

    def insert(self, digest: bytes, n_rows: int, rank: tuple) -> None:
        if self.holds(digest):
            key = self.keys[digest]
            key[0] += n_rows
            if _order(rank) < _order(key[1:]):
                key[1:] = rank
            return
        self.keys[digest] = [n_rows, *rank]
        if not self.filter.insert(hash_of(digest)):
            rows = len(self.filter.slots)
            while True:
                rows *= 2
                larger = CuckooFilter(rows)
                if self._fill(larger):
                    break
            self.filter = larger

    def delete(self, digest: bytes) -> None:
        if self.holds(digest):
            del self.keys[digest]
            self.filter.delete(hash_of(digest))

    def rows(self, bucket: int) -> pd.DataFrame:
        """Its state: one row per key and one with the filter."""
        keys = pd.DataFrame([("key", bucket, d, *rest, None) for d, rest in self.keys.items()], columns=_STATE_NAMES)
        whole = pd.DataFrame([("filter", bucket, None, None, None, None, None, self.filter.slots.tobytes())], columns=_STATE_NAMES)
        return pd.concat([keys, whole], ignore_index=True).astype({c: "Int64" for c in ("n_rows", "n_chars", "doc_id", "row_id")})


_STATE_NAMES = ["kind", *_KEY_NAMES, "slots"]


def _order(rank) -> tuple:
    n_chars, doc_id, row_id = rank
    return (-n_chars, pd.isna(doc_id), 0 if pd.isna(doc_id) else doc_id, row_id)


def _bucket_of(keys: pd.DataFrame, filters: pd.DataFrame, expected: int = 0) -> Bucket:
    return Bucket(keys, bytes(filters["slots"].iloc[0]) if len(filters) else None, expected)


class CuckooIndex:
    """The index as tables in the shared folder; every change writes the next version."""

    def __init__(self, spark: SparkSession, expected: int) -> None:
        self.spark = spark
        self.buckets = max(1, -(-expected // KEYS_PER_BUCKET))
        self.state = empty(spark, STATE)

    def _bucketed(self, digests: DataFrame) -> DataFrame:
        return digests.withColumn("bucket", F.pmod(F.xxhash64("digest"), F.lit(self.buckets)).cast("int"))

    def _changed(self, rows: DataFrame, change) -> None:
        """Apply a change to every bucket: its state and the rows dealt to it."""

        def run(key, state: pd.DataFrame, arrived: pd.DataFrame) -> pd.DataFrame:
            keys, filters = state[state["kind"] == "key"], state[state["kind"] == "filter"]
            bucket = _bucket_of(keys, filters, len(arrived))
            change(bucket, arrived)
            return bucket.rows(int(key[0]))

        groups = self.state.groupBy("bucket").cogroup(self._bucketed(rows).groupBy("bucket"))
        self.state = staged(groups.applyInPandas(run, STATE), "cuckoo")

    def insert(self, rows: DataFrame) -> None:
        """Add rows of digest, n_rows, n_chars, doc_id, row_id; a digest may come in several rows."""

        def change(bucket: Bucket, arrived: pd.DataFrame) -> None:
            for d, n, chars, doc, row in arrived[["digest", "n_rows", "n_chars", "doc_id", "row_id"]].itertuples(index=False):
                bucket.insert(bytes(d), n, (chars, None if pd.isna(doc) else int(doc), row))

        self._changed(rows, change)

    def delete(self, digests: DataFrame) -> None:
        """Remove digests; those that are not live are passed over."""

        def change(bucket: Bucket, arrived: pd.DataFrame) -> None:
            for d in arrived["digest"]:
                bucket.delete(bytes(d))

        self._changed(digests.select("digest").distinct(), change)

    def keys(self) -> DataFrame:
        """The live digests with their group size and the row that stays."""
        return self.state.where("kind = 'key'").select(*_KEY_NAMES[1:])

    def live(self, digests: DataFrame) -> DataFrame:
        """Those of the digests that are live: hits of the filters, verified against the keys."""
        filters = self.state.where("kind = 'filter'").select("bucket", "slots")

        def probe(asked: pd.DataFrame, filters: pd.DataFrame) -> pd.DataFrame:
            held = CuckooFilter.loaded(bytes(filters["slots"].iloc[0])) if len(filters) else CuckooFilter(1)
            return asked[[hash_of(bytes(d)) in held for d in asked["digest"]]][["digest"]]

        asked = self._bucketed(digests.select("digest").distinct()).groupBy("bucket")
        hits = asked.cogroup(filters.groupBy("bucket")).applyInPandas(probe, "digest binary")
        return hits.join(self.keys().select("digest"), "digest", "left_semi")


def digest_of(text: Column) -> Column:
    """SHA-256 of a text without white space."""
    return F.unhex(F.sha2(F.translate(text, WHITE, "").cast("binary"), 256))


def indexed(docs: DataFrame) -> tuple[DataFrame, CuckooIndex]:
    """The digests of all rows, written down, and an index of them."""
    rows = row_numbered(
        docs.select(
            F.col("doc_id").cast("bigint"), F.length(whole_text()).cast("bigint").alias("n_chars"), digest_of(whole_text()).alias("digest")
        )
    )
    rows = staged(rows, "digests")
    index = CuckooIndex(docs.sparkSession, rows.count())
    # Copies are combined before they meet, so a hot digest arrives in WAYS rows.
    rank = F.struct((-F.col("n_chars")).alias("fewer"), F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row_id")
    combined = rows.groupBy("digest", F.pmod(F.xxhash64("row_id"), F.lit(WAYS)).alias("way")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.min(rank).alias("first")
    )
    index.insert(combined.select("digest", "n_rows", (-F.col("first.fewer")).alias("n_chars"), "first.doc_id", "first.row_id"))
    return rows, index


def deduplicated(docs: DataFrame) -> DataFrame:
    """Every row with the one that stays, the size of its group, and whether it is kept."""
    rows, index = indexed(docs)
    groups = index.keys().where("n_rows > 1").select(
        "digest", "n_rows", F.col("n_rows").alias("size"), F.col("doc_id").alias("keep"), F.col("row_id").alias("keep_row")
    )
    found = spread_lookup(rows, groups, "digest", ["row_id"])
    return found.select(
        "doc_id",
        F.when(F.col("size").isNull(), F.col("doc_id")).otherwise(F.col("keep")).alias("keep_id"),
        F.coalesce("size", F.lit(1).cast("bigint")).alias("group_size"),
        (F.col("size").isNull() | (F.col("keep_row") == F.col("row_id"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def first_of_equal(docs: DataFrame) -> DataFrame:
    """Pipeline stage: the rows that stay, in their own columns.

    Rows are matched by document id and digest; rows that repeat both are
    reduced to one after the join, in the order the join has left.
    """
    _, index = indexed(docs)
    winners = index.keys().select(F.struct("doc_id", "digest").alias("key"))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    keyed = docs.select(row, F.struct(F.col("doc_id").cast("bigint").alias("doc_id"), digest_of(whole_text()).alias("digest")).alias("key"))
    return keyed.join(winners, "key", "left_semi").groupBy("key").agg(F.first("row").alias("row")).select("row.*")
