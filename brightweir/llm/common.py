"""What the operators of this package share."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from typing import TypeVar

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from brightweir.session import scratch_path

# The white space that the contracts name: space and U+0009 to U+000D.
WHITE = " \t\n\x0b\x0c\r"

T = TypeVar("T")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, whole."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back.

    Cuts the lineage: what follows reads files that outlive any executor.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def empty(spark: SparkSession, schema: str) -> DataFrame:
    """A table without rows; ``schema`` lists names and types."""
    columns = (column.split() for column in schema.split(", "))
    return spark.range(0).select(*[F.lit(None).cast(kind).alias(name) for name, kind in columns])


def whole_text(name: str = "text") -> Column:
    """The text column, null as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def row_numbered(df: DataFrame) -> DataFrame:
    """Add ``row_id``, which tells repeated rows apart.

    Stage the result before it is read twice: the numbers depend on how the
    input is split, and only a written table holds them fast.
    """
    return df.withColumn("row_id", F.monotonically_increasing_id())


def in_slices(items: Sequence[T], sizes: Sequence[int], most: int) -> Iterator[tuple[int, int]]:
    """Cut a list into runs ``[start, stop)`` whose sizes add up to ``most`` or hold one item."""
    start, held = 0, 0
    for i, size in enumerate(sizes):
        if i > start and held + size > most:
            yield start, i
            start, held = i, 0
        held += size
    if start < len(items):
        yield start, len(items)


# A white-space character between two letters, where a long text can be cut.
_CUT = re.compile(r"(?<=[^\W\d_])[ \n](?=[^\W\d_])")


def pieces_of(text: str, most: int) -> Iterator[str]:
    """Cut a text of over ``most`` characters before single white space between letters.

    A piece is longer only where the text has no such place.
    """
    start = 0
    while len(text) - start > most:
        cut = _CUT.search(text, start + most)
        if cut is None:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:] if start else text
