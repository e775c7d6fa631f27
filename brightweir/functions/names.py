"""Organisation names: normal form and similarity."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, functions as F
from pyspark.sql.types import StringType

from brightweir import fixed_values as fixed
from brightweir.functions.text import bind, squeeze

_NON_ASCII = r"[^\x00-\x7F]"
_SUFFIXES = (
    f"(?<!{fixed.WORD_CLASS})(?:" + "|".join(fixed.LEGAL_SUFFIXES) + rf")(?!{fixed.WORD_CLASS})"
)
# Characters that are neither part of a word nor white space.
_PUNCTUATION = r"[^\p{L}\p{N}_\s]"
# Longest side for which the alignment fits the bits of one long value.
_BIT_LIMIT = 62


@F.pandas_udf(StringType())
def _unaccented(names: pd.Series) -> pd.Series:
    def fold(name: str | None) -> str | None:
        if name is None:
            return None
        return "".join(ch for ch in unicodedata.normalize("NFKD", name) if not unicodedata.combining(ch))

    return names.map(fold, na_action="ignore")


def without_accents(c: Column) -> Column:
    """Compatibility decomposition without combining marks.

    Plain ASCII text is its own decomposition, so only other text is handed to
    the Python worker.  Call it on distinct names.
    """
    foreign = F.rlike(c, F.lit(_NON_ASCII))
    return F.coalesce(_unaccented(F.when(foreign, c)), c)


def normal_name(unaccented: Column) -> Column:
    """Lower case, legal suffix words and punctuation removed, spaces collapsed."""
    bare = F.regexp_replace(F.lower(unaccented), _SUFFIXES, "")
    return squeeze(F.regexp_replace(bare, _PUNCTUATION, " "))


def title_name(normal: Column) -> Column:
    """Each word of a normal name with a capital first letter."""
    return F.initcap(normal)


def sorted_tokens(c: Column) -> Column:
    """The words of a text in sorted order, joined by single spaces."""
    words = F.filter(F.split(squeeze(c), " "), lambda w: w != "")
    return F.array_join(F.array_sort(words), " ")


def _letters(c: Column) -> Column:
    return F.filter(F.split(c, ""), lambda ch: ch != "")


def _bit(position: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), position)


def _alignment_bits(short: Column, long: Column) -> Column:
    # Bit i of the state is cleared once i letters of the short text are aligned.
    full = _bit(F.length(short)) - F.lit(1)
    letters = _letters(short)
    alphabet = F.array_distinct(letters)

    def places(ch: Column) -> Column:
        bits = F.transform(letters, lambda other, i: F.when(other == ch, _bit(i)).otherwise(F.lit(0).cast("bigint")))
        return F.aggregate(bits, F.lit(0).cast("bigint"), lambda acc, bit: acc.bitwiseOR(bit))

    masks = bind(
        F.map_from_arrays(alphabet, F.transform(alphabet, places)),
        lambda table: F.transform(
            _letters(long), lambda ch: F.coalesce(F.try_element_at(table, ch), F.lit(0).cast("bigint"))
        ),
    )
    state = F.aggregate(
        masks,
        full,
        lambda v, m: (v + v.bitwiseAND(m)).bitwiseOR(v.bitwiseAND(F.bitwise_not(m))).bitwiseAND(full),
    )
    return F.length(short) - F.bit_count(state)


def _alignment_rows(short: Column, long: Column) -> Column:
    # Row update of the alignment table, for texts beyond the bit limit.
    letters = _letters(short)
    width = F.length(short)

    def next_row(row: Column, ch: Column) -> Column:
        def best(j: Column) -> Column:
            taken = F.get(row, j - 1) + F.when(F.get(letters, j - 1) == ch, 1).otherwise(0)
            return F.greatest(F.get(row, j), taken)

        merged = F.concat(F.array(F.lit(0)), F.transform(F.sequence(F.lit(1), width), best))
        # The one-element array binds the merged row, so that it is computed once.
        running = F.transform(
            F.array(merged),
            lambda m: F.transform(m, lambda _, i: F.array_max(F.slice(m, F.lit(1), i + 1))),
        )
        return F.get(running, F.lit(0))

    start = F.array_repeat(F.lit(0), width + 1)
    last = F.aggregate(_letters(long), start, next_row)
    return F.element_at(last, -1)


def common_letters(a: Column, b: Column) -> Column:
    """Length of the longest common subsequence of two non-empty texts."""
    short = F.when(F.length(a) <= F.length(b), a).otherwise(b)
    long = F.when(F.length(a) <= F.length(b), b).otherwise(a)
    return F.when(F.length(short) <= _BIT_LIMIT, _alignment_bits(short, long)).otherwise(
        _alignment_rows(short, long)
    )


def sorted_similarity(a: Column, b: Column) -> Column:
    """Similarity 0-100 of two texts whose words are already sorted."""
    total = F.length(a) + F.length(b)
    score = F.lit(200.0) * common_letters(a, b) / total
    return F.when((F.length(a) == 0) | (F.length(b) == 0), F.lit(0.0)).otherwise(score)


def token_similarity(a: Column, b: Column) -> Column:
    """Similarity 0-100 of two texts regardless of word order."""
    return sorted_similarity(sorted_tokens(a), sorted_tokens(b))
