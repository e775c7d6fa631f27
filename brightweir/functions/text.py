"""Column expressions over plain text.  Everything here stays in the JVM."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

from brightweir import fixed_values as fixed


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip(c: Column) -> Column:
    """Remove surrounding Unicode white space (``trim`` alone removes only spaces)."""
    return F.btrim(c, F.lit(fixed.WHITESPACE))


def squeeze(c: Column) -> Column:
    """Turn every run of white space into one space and strip the ends."""
    return F.btrim(F.regexp_replace(c, fixed.WHITESPACE_CLASS + "+", " "), F.lit(" "))


def is_blank(c: Column) -> Column:
    """True for null, empty and white-space-only values."""
    # The search ends at the first other character; stripping looks at both ends against the whole list.
    return F.coalesce(~F.rlike(c, F.lit("[^" + fixed.WHITESPACE_CLASS[1:])), F.lit(True))


def first_filled(*columns: Column) -> Column:
    """The first value that is neither null nor empty."""
    filled = [F.nullif(c, F.lit("")) for c in columns]
    return F.coalesce(*filled) if len(filled) > 1 else filled[0]


def token_estimate(c: Column) -> Column:
    """Four characters per token, at least one, zero for no text."""
    length = F.length(c)
    return (
        F.when(F.coalesce(length, F.lit(0)) == 0, F.lit(0))
        .otherwise(F.greatest(F.lit(1), (length / 4).cast("int")))
        .cast("bigint")
    )


def reduced(c: Column, factor: float = 0.5) -> Column:
    """Cut a payload to a share of its length, but not below the minimum."""
    keep = F.greatest(F.lit(fixed.MIN_PAYLOAD_CHARS), (F.length(c) * F.lit(float(factor))).cast("int"))
    return F.coalesce(strip(F.substring(c, F.lit(1), keep)), F.lit(""))


def snippet(text: Column, term: Column, max_chars: int = fixed.MAX_SNIPPET_CHARS) -> Column:
    """Text around the first case-insensitive match of a term.

    A cut side is marked with dots.  Without a match the head of the text is
    returned without marks.
    """
    term = F.coalesce(term, F.lit(""))
    found = F.when(term == "", F.lit(0)).otherwise(F.instr(F.lower(text), F.lower(term)))
    half = F.greatest(F.lit(10), F.floor((F.lit(max_chars) - F.length(term)) / 2)).cast("int")
    start = F.greatest(F.lit(0), found - 1 - half)
    end = F.least(F.length(text), start + max_chars)
    window = strip(F.substring(text, start + 1, end - start))
    marked = F.concat(
        F.when(start > 0, F.lit("...")).otherwise(F.lit("")),
        window,
        F.when(end < F.length(text), F.lit("...")).otherwise(F.lit("")),
    )
    head = strip(F.substring(text, F.lit(1), F.lit(max_chars)))
    return F.when(F.coalesce(text, F.lit("")) == "", F.lit("")).when(found == 0, head).otherwise(marked)


def first_line_name(c: Column) -> Column:
    """Rule-based name: the stripped head of the first line."""
    # The line boundaries of Unicode text, "\r\n" counting as one.
    line = F.element_at(F.split(c, r"\r\n|[\n\r\x0B\x0C\x1C-\x1E\x{85}\x{2028}\x{2029}]", 2), 1)
    name = strip(F.substring(line, 1, fixed.RULE_NAME_CHARS))
    return F.when(F.coalesce(c, F.lit("")) == "", F.lit(fixed.UNKNOWN_NAME)).otherwise(name)
