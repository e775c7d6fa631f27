"""Cutting documents into chunks and fitting payloads into budgets."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, StringType

from brightweir import fixed_values as fixed
from brightweir.functions.text import reduced, token_estimate

_SENTENCE_END = re.compile(fixed.SENTENCE_END_PATTERN)
_PARAGRAPH_BREAK = "\n\n"


class _Packer:
    """Greedy packing of pieces into chunks of a limited size."""

    def __init__(self, limit: int, strict: bool):
        self.limit = limit
        self.strict = strict
        self.done: list[str] = []
        self.pieces: list[str] = []
        self.size = 0

    def add(self, piece: str, gap: str) -> None:
        if self.pieces and self.size + len(piece) + len(gap) > self.limit:
            self.close(gap)
        self.pieces.append(piece)
        self.size += len(piece) + len(gap)

    def close(self, gap: str) -> None:
        if self.pieces:
            self.done.append((" " if self.strict else gap).join(self.pieces))
        self.pieces, self.size = [], 0


def _words(sentence: str, limit: int, strict: bool) -> Iterator[str]:
    for word in sentence.split(" "):
        if strict:
            yield from (word[i : i + limit] for i in range(0, max(len(word), 1), limit))
        else:
            yield word


def chunk_one(text: str | None, limit: int, strict: bool = False) -> list[str]:
    """Chunks of one text.  ``strict`` guarantees the limit by cutting long words."""
    if not text:
        return []
    if len(text) <= limit:
        return [text]
    packer = _Packer(limit, strict)
    for paragraph in filter(None, map(str.strip, text.split(_PARAGRAPH_BREAK))):
        if len(paragraph) <= limit:
            packer.add(paragraph, _PARAGRAPH_BREAK)
            continue
        for sentence in _SENTENCE_END.split(paragraph):
            if len(sentence) <= limit:
                packer.add(sentence, " ")
                continue
            # Words of an over-long sentence never share a chunk with what came before it.
            packer.close(" ")
            for word in _words(sentence, limit, strict):
                packer.add(word, " ")
    packer.close(_PARAGRAPH_BREAK)
    return packer.done


def chunk_table(
    df: DataFrame, text: str, max_chars: int = fixed.MAX_CHUNK_CHARS, strict: bool = False
) -> DataFrame:
    """One row per chunk: the other columns, ``chunk_no``, ``chunk``, ``n_chars``, ``over_limit``."""

    @F.pandas_udf(ArrayType(StringType()))
    def cut(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: chunk_one(t, max_chars, strict))

    kept = [c for c in df.columns if c != text]
    exploded = df.select(*kept, F.posexplode(cut(F.col(text))).alias("chunk_no", "chunk"))
    length = F.length("chunk")
    return exploded.withColumns({"n_chars": length, "over_limit": length > max_chars})


def chunk_stats(chunks: DataFrame, by: list[str]) -> DataFrame:
    """Chunk counts, sizes and limit violations per group."""
    return chunks.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_chunks"),
        F.sum("n_chars").alias("total_chars"),
        F.max("n_chars").alias("max_chars"),
        F.sum(F.col("over_limit").cast("bigint")).alias("n_over_limit"),
    )


def fitted(text: Column, budget: int, factor: float = 0.5, retries: int = fixed.MAX_RETRIES) -> Column:
    """Shrink a payload until it fits: struct of its text and the steps taken.

    At most ``retries + 1`` steps are taken, as a provider would be asked.
    """

    def step(state: Column, _: Column) -> Column:
        too_large = F.length(state["text"]) > budget
        return F.when(
            too_large,
            F.struct(reduced(state["text"], factor).alias("text"), (state["steps"] + 1).alias("steps")),
        ).otherwise(state)

    start = F.struct(F.coalesce(text, F.lit("")).alias("text"), F.lit(0).alias("steps"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(retries + 1)), start, step)


def token_budget(df: DataFrame, text: str, by: list[str]) -> DataFrame:
    """Documents, characters and estimated tokens per group."""
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.sum(F.length(text).cast("bigint")).alias("total_chars"),
        F.sum(token_estimate(F.col(text))).alias("total_tokens"),
    )
