"""Shards by a k-d tree over document metadata.

The documents are points: their length, language and source, each as a number
from 0 to 1.  A cell is split at the weighted median, by bytes, of the
dimension in which it is widest, and the halves again, until the leaves are the
shards wanted.  The law is ``bytes``: leaves differ by a few documents.

A median is found by counting.  The place of a document in a dimension is a
whole number: its coordinate, then the checksum of its text, then a hash of the
row.  So equal points can be divided, and equal texts stay side by side.
Bytes are summed per digit of that number, for all cells of a level at once,
and the digit that holds the median is opened by the next.  Only the sums per
cell and digit leave the executors' partial sums, and the driver gets one row
per cell.  Everything is DataFrame functions.

Defined results: a null text has no bytes, so size 1, and checksum 0; null
metadata has coordinate 0; repeated rows are rows of their own, told apart by a
row number; an empty table gives an empty result.  Only the named columns are
read; others may have any name, and a missing one counts as null.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from brightweir.llm.common import row_numbered, staged

SHARDS = 16
# Bits of a place: coordinate, checksum, row; and of the digits it is read in.
COORDINATE_BITS, CHECKSUM_BITS, ROW_BITS = 20, 20, 16
DIGIT_BITS = 14
PLACE_BITS = COORDINATE_BITS + CHECKSUM_BITS + ROW_BITS
# Rows that a task numbers at once.
ROWS_PER_BLOCK = 200_000

DIMENSIONS = ("length", "lang", "source")


def _level(value: Column) -> Column:
    """A coordinate in whole steps; a null one is 0."""
    steps = (1 << COORDINATE_BITS) - 1
    return F.coalesce(F.least(F.floor(value * steps), F.lit(steps)), F.lit(0)).cast("bigint")


def _hashed(name: Column) -> Column:
    """A name as a number from 0 to 1; the same name always has the same."""
    return F.when(name.isNotNull(), F.crc32(name.cast("string").cast("binary")) / float(1 << 32))


def _placed(docs: DataFrame, *more: Column) -> DataFrame:
    """Rows with their size, checksum and place in each dimension."""
    text = F.col("text").cast("binary")
    size = (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("bigint")

    def given(column: str) -> Column:
        return F.col(column) if column in docs.columns else F.lit(None).cast("string")

    # A length doubles 31 times at most, so its logarithm is scaled by 32.
    coordinates = {"length": F.log2(size.cast("double")) / 32.0, "lang": _hashed(given("lang")), "source": _hashed(given("source"))}
    rows = row_numbered(
        docs.select(
            F.col("doc_id").cast("bigint").alias("doc_id"),
            size.alias("size"),
            F.crc32(F.coalesce(text, F.lit("").cast("binary"))).alias("text_crc32"),
            *[_level(coordinates[name]).alias(f"at_{name}") for name in DIMENSIONS],
            *more,
        )
    )
    checksum = F.shiftright(F.col("text_crc32"), 32 - CHECKSUM_BITS)
    row = F.pmod(F.xxhash64("row_id"), F.lit(1 << ROW_BITS))
    low = F.shiftleft(checksum, ROW_BITS).bitwiseOR(row)
    places = {name: F.shiftleft(F.col(f"at_{name}"), CHECKSUM_BITS + ROW_BITS).bitwiseOR(low) for name in DIMENSIONS}
    return rows.withColumns(places).drop(*[f"at_{name}" for name in DIMENSIONS])


def points(docs: DataFrame) -> DataFrame:
    """Per row its size, checksum and place in each dimension, written down; the texts stay behind."""
    return staged(_placed(docs), "points")


class Split:
    """A cell of the tree: a leaf with its shard, or a dimension, a cut and two cells."""

    def __init__(self, first: int, shards: int) -> None:
        self.first, self.shards = first, shards
        self.dimension: str | None = None
        self.cut = 0
        self.low: Split | None = None
        self.high: Split | None = None

    @property
    def at(self) -> Column:
        return F.col(self.dimension)

    def open(self, dimension: str, cut: int) -> list[Split]:
        """Divide the shards, the larger half to the low side, at the first place of the high side."""
        half = (self.shards + 1) // 2
        self.dimension, self.cut = dimension, cut
        self.low, self.high = Split(self.first, half), Split(self.first + half, self.shards - half)
        return [self.low, self.high]

    def cell(self) -> Column:
        """The number of the leaf that a row falls into: the first of its shards."""
        if self.low is None:
            return F.lit(self.first)
        return F.when(self.at < F.lit(self.cut), self.low.cell()).otherwise(self.high.cell())


def _per_cell(cells: list[Split], value) -> Column:
    """A column that differs by cell, for rows with a ``cell`` number."""
    found = F.lit(None)
    for split in cells:
        found = F.when(F.col("cell") == split.first, value(split)).otherwise(found)
    return found


def _widest(rows: DataFrame, cells: list[Split]) -> dict[int, tuple[str, int]]:
    """Per cell the dimension in which its rows lie furthest apart, and its bytes."""
    spans = [(F.max(d) - F.min(d)).alias(d) for d in DIMENSIONS]
    found = rows.groupBy("cell").agg(F.sum("size").alias("bytes"), *spans).collect()
    wide = {r.cell: (max(DIMENSIONS, key=lambda d: (r[d], -DIMENSIONS.index(d))), r.bytes) for r in found}
    return {split.first: wide.get(split.first, (DIMENSIONS[0], 0)) for split in cells}


def _median_cuts(rows: DataFrame, cells: list[Split]) -> list[Split]:
    """Split cells at their weighted medians, digit by digit of the place."""
    widest = _widest(rows, cells)
    place = _per_cell(cells, lambda s: F.col(widest[s.first][0]))
    rows = rows.where(F.col("cell").isin([s.first for s in cells])).select("cell", "size", place.alias("place"))
    # Per cell: the digits found so far, the bytes below them, the bytes wanted below the cut.
    prefix = {s.first: 0 for s in cells}
    below = {s.first: 0 for s in cells}
    wanted = {s.first: widest[s.first][1] * ((s.shards + 1) // 2) / s.shards for s in cells}
    for shift in range(PLACE_BITS - DIGIT_BITS, -1, -DIGIT_BITS):
        inside = F.shiftright("place", shift + DIGIT_BITS) == _per_cell(cells, lambda s: F.lit(prefix[s.first]).cast("bigint"))
        digit = F.shiftright("place", shift).bitwiseAND(F.lit((1 << DIGIT_BITS) - 1)).alias("digit")
        sums = rows.where(inside).groupBy("cell", digit).agg(F.sum("size").alias("bytes"))
        so_far = F.sum("bytes").over(Window.partitionBy("cell").orderBy("digit"))
        run = sums.withColumn("to", so_far + _per_cell(cells, lambda s: F.lit(below[s.first]).cast("bigint")))
        goal = _per_cell(cells, lambda s: F.lit(float(wanted[s.first])))
        # The last digit is taken if rounding leaves the goal beyond it.
        reached = run.groupBy("cell").agg(
            F.min(F.when(F.col("to") >= goal, F.struct("digit", "to", "bytes"))).alias("hit"),
            F.max(F.struct("digit", "to", "bytes")).alias("last"),
        )
        for r in reached.collect():
            hit = r.hit or r.last
            prefix[r.cell] = prefix[r.cell] << DIGIT_BITS | hit.digit
            below[r.cell] = hit.to - hit.bytes
            if not shift and hit.to - wanted[r.cell] < wanted[r.cell] - below[r.cell]:
                prefix[r.cell] += 1  # the cut lies nearer behind the digit than before it
    return [half for s in cells for half in s.open(widest[s.first][0], prefix[s.first])]


def tree(rows: DataFrame, shards: int) -> Split:
    """The k-d tree of the rows of ``points`` with so many leaves."""
    root = Split(0, shards)
    level = [root]
    while level := [s for s in level if s.shards > 1]:
        level = _median_cuts(rows.withColumn("cell", root.cell()), level)
    return root


def _numbered(rows: DataFrame) -> DataFrame:
    """Number the rows of each shard from 0, without gaps.

    Shards are dealt to blocks by a hash of the row.  Blocks are numbered by
    themselves and then moved on by the rows of the blocks before them.
    """
    blocks = max(1, math.ceil(rows.count() / ROWS_PER_BLOCK))
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("row_id"), F.lit(blocks)))
    counts = dealt.groupBy("shard", "block").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("block")) - F.col("n")
    starts = counts.select("shard", "block", before.alias("start"))
    inside = F.row_number().over(Window.partitionBy("shard", "block").orderBy("row_id"))
    return dealt.withColumn("inside", inside).join(starts, ["shard", "block"]).withColumn("slot", F.col("start") + F.col("inside") - 1)


def sharded(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Per row its size, checksum, shard and slot."""
    rows = points(docs)
    placed = _numbered(rows.withColumn("shard", tree(rows, shards).cell().cast("int")))
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        F.col("slot").cast("bigint").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS) -> None:
    """Write the documents as one folder per shard, each row as the struct ``row``.

    The tree is applied where the texts are read, so they are not shuffled.
    """
    leaves = tree(points(docs), shards).cell().cast("int")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    _placed(docs, row).select(leaves.alias("shard"), "row").write.partitionBy("shard").parquet(path)
