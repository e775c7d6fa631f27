"""Publication times: absolute and relative parsing, priority, rendering.

All results are timestamps in UTC (the session zone must be UTC).  Each text is
matched against a list of usual shapes first, so that a formatter only ever
sees text of its own shape: a failing formatter costs a Java exception per row.
Other texts go through a general parser made of column expressions.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, functions as F

from brightweir import fixed_values as fixed
from brightweir.functions.text import bind, strip

_ISO_DATE = r"^\d{4}-\d{2}-\d{2}$"
_ISO = r"^\d{4}-\d{2}-\d{2}(?:[Tt ]\d{2}:\d{2}(?::\d{2}(?:\.\d+)?)?)?\s*(?:[Zz]|[+-]\d{2}:?\d{2})?$"
_MAIL = r"(?i)^(?:[a-z]{3},?\s+)?\d{1,2}\s+[a-z]{3}\s+\d{4}\s+\d{1,2}:\d{2}(?::\d{2})?(?:\s*(?:[+-]\d{4}|[a-z]{1,3}))?$"
_MAIL_PARTS = r"(?i)^(?:[a-z]{3},?\s+)?(\d{1,2})\s+([a-z]{3})\s+(\d{4})\s+(\d{1,2}:\d{2})(:\d{2})?\s*([+-]\d{4}|[a-z]*)$"
# The usual spelling, which a cast reads as it is.
_ISO_PLAIN = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}Z?\z"
# Text with nothing to strip at either end, as most date texts are.
_TIGHT = r"^[!-~](?s:.*[!-~])?\z"
_SHORT_MONTH = r"(?i)^[a-z]{3}\.?\s+\d{1,2},\s*\d{4}$"
_LONG_MONTH = r"(?i)^[a-z]{4,9}\s+\d{1,2},\s*\d{4}$"
_DAY_MONTH = r"(?i)^\d{1,2}\s+[a-z]{3}\s+\d{4}$"
_SLASHED = r"^\d{4}/\d{2}/\d{2}$"


def reference(moment: datetime | str) -> Column:
    """The reference time of a run as a literal timestamp."""
    return F.lit(str(moment)).cast("timestamp")


def _zone_offset(zone: Column) -> Column:
    offsets = F.create_map(*[F.lit(x) for item in fixed.ZONE_OFFSETS.items() for x in item])
    return F.when(zone == "", F.lit("+0000")).otherwise(
        F.coalesce(F.try_element_at(offsets, F.upper(zone)), F.when(F.rlike(zone, F.lit(r"^[+-]\d{4}$")), zone))
    )


def parse_absolute(c: Column) -> Column:
    """Timestamp of an absolute date text, null if it names no whole date.

    Usual shapes: ISO 8601 with zone, offset, neither, or date only; RFC 2822;
    ``Sep 12, 2026``; ``September 12, 2026``; ``12 Sep 2026``; ``2026/09/12``.
    Every other text with two numbers or eight digits goes to ``parse_general``.
    Without a zone the text is read as UTC.
    """
    other = bind(F.when(F.rlike(c, F.lit(_TIGHT)), c).otherwise(strip(c)), _absolute)
    return F.when(F.rlike(c, F.lit(_ISO_PLAIN)), c.try_cast("timestamp")).otherwise(other)


def _mail(text: Column) -> Column:
    """A text of the mail shape as the formatter reads it; its parts are matched once."""

    def joined(p: Column) -> Column:
        day, month, year, clock, seconds, zone = (F.get(p, F.lit(i)) for i in range(6))
        timed = F.concat(clock, F.coalesce(F.nullif(seconds, F.lit("")), F.lit(":00")))
        return F.concat_ws(" ", day, F.initcap(month), year, timed, _zone_offset(zone))

    return bind(F.split(F.regexp_replace(text, _MAIL_PARTS, "$1|$2|$3|$4|$5|$6"), r"\|"), joined)


def _absolute(text: Column) -> Column:
    iso = F.regexp_replace(F.upper(text), r"\s*([+-]\d{2}):?(\d{2})$", "$1:$2")
    spaced = F.initcap(F.regexp_replace(text, r"\s+", " "))
    worded = F.regexp_replace(F.replace(spaced, F.lit("."), F.lit("")), r",\s*", ", ")
    return (
        F.when(F.rlike(text, F.lit(_ISO_DATE)), text.try_cast("timestamp"))
        .when(F.rlike(text, F.lit(_ISO)), iso.try_cast("timestamp"))
        .when(F.rlike(text, F.lit(_MAIL)), F.try_to_timestamp(_mail(text), F.lit("d MMM yyyy H:mm:ss Z")))
        .when(F.rlike(text, F.lit(_SHORT_MONTH)), F.try_to_timestamp(worded, F.lit("MMM d, yyyy")))
        .when(F.rlike(text, F.lit(_LONG_MONTH)), F.try_to_timestamp(worded, F.lit("MMMM d, yyyy")))
        .when(F.rlike(text, F.lit(_DAY_MONTH)), F.try_to_timestamp(spaced, F.lit("d MMM yyyy")))
        .when(F.rlike(text, F.lit(_SLASHED)), F.try_to_timestamp(text, F.lit("yyyy/MM/dd")))
        .when(F.rlike(text, F.lit(r"\d\D+\d|\d{8}")), parse_general(text))
    )


# Twelve-hour or 24-hour clock, then a zone: an offset, one behind UTC or GMT, or a known name.
_HALF = r"([AP])\.?M\b\.?"
_ZONE = r"((?:UTC|GMT)?[+-]\d{1,2}(?::?\d{2})?(?!\d)|(?:" + "|".join(fixed.ZONE_OFFSETS) + r")(?![A-Z]))"
_CLOCK = (
    r"(?<![\d:.])(\d{1,2})(?=:\d|\s*[AP]\.?M\b)(?::(\d{2})(?::(\d{2}(?:[.,]\d{1,6})?)\d*)?)?"
    + rf"(?:\s*{_HALF})?(?:\s*{_ZONE})?(?:\s*\([A-Z ]*\))?"
)
_COMPACT = r"^(\d{4})(\d{2})(\d{2})(?=T?(?:\d{4}|\d{6})?(?:\D|$))"


def parse_general(c: Column) -> Column:
    """Timestamp of a date written in words and numbers in any usual order.

    The text is cut into words and numbers.  A clock (``10:00``, ``3pm``,
    ``3:04:05.5 PM``) with the zone right behind it goes first; what is left has
    to be one date, whatever stands between its parts:

    * a month by name, a day and a year: the year is the number over 31 or of
      four digits; of two small numbers the day stands next to the month, so
      the last is the year;
    * three numbers: year first if the first is over 31 or of four digits; else
      day first if the first is over 12; else month first;
    * eight digits, with four or six more for the clock.

    Years of two digits below 69 are of this century, others of the last.
    Weekdays, ordinal endings and words like ``at`` are passed over.  Nothing is
    filled in from today: a text without a day, a month or a year is null, and so is
    one with a word or number that has no place, or with parts that are no
    date.  Zone names mean their fixed offsets, and a twelve-hour clock counts in
    every order of parts.
    """
    text = F.regexp_replace(F.upper(strip(c)), _COMPACT, "$1-$2-$3 ")
    text = F.regexp_replace(text, r"^(\d{4}-\d{2}-\d{2} )T?(\d{2})(\d{2})(\d{2})?(?=\D|$)", "$1$2:$3:$4")
    # A clock without seconds is left with a colon by the line before.
    return bind(F.regexp_replace(text, r":(?=\D|$)", ""), _general)


# Names of months, found by their first three letters, and all that may stand in a date.
_MONTH = r"^(?:" + "|".join([*fixed.MONTHS, *fixed.MONTHS_SHORT]) + r")$"
_KNOWN = r"^(?:\d{1,4}|" + "|".join([*fixed.MONTHS, *fixed.MONTHS_SHORT, *fixed.WEEKDAYS, *fixed.DATE_FILLERS]) + r")$"
_PART = r"^\d+$|" + _MONTH
_MARKS = r"^[A-Z\d\s.,;/'-]*$"
_SHORT = "".join(fixed.MONTHS_SHORT[:12])


def _matches(c: Column, pattern: str) -> Column:
    return F.rlike(c, F.lit(pattern))


def _general(text: Column) -> Column:
    clocks = F.regexp_extract_all(text, F.lit(_CLOCK), F.lit(0))
    rest = F.regexp_replace(text, _CLOCK, " ; ")
    read = F.struct(clocks.alias("clocks"), F.regexp_extract_all(rest, F.lit(r"[A-Z]+|\d+"), F.lit(0)).alias("tokens"), _matches(rest, _MARKS).alias("plain"))

    def dated(r: Column) -> Column:
        sound = r["plain"] & (F.size(r["clocks"]) <= 1) & F.forall(r["tokens"], lambda t: _matches(t, _KNOWN))
        parts = F.when(sound, F.filter(r["tokens"], lambda t: _matches(t, _PART)))
        return F.struct(bind(parts, lambda p: F.when(F.size(p) == 3, _of_parts(p))).alias("date"), F.get(r["clocks"], F.lit(0)).alias("clock"))

    return bind(bind(read, dated), lambda r: F.when(r["date"].isNotNull(), _at_clock(r["date"], F.coalesce(r["clock"], F.lit("")))))


def _of_parts(parts: Column) -> Column:
    """Year, month and day of three parts, one of which may be a month by name."""

    def ordered(p: Column) -> Column:
        """The places of year, month and day among the parts."""
        at, a, b = F.array_position(p["named"], F.lit(True)), F.get(p["years"], F.lit(0)), F.get(p["years"], F.lit(1))
        return (
            F.when(at == 0, F.when(a, F.lit("123")).when(F.get(parts, F.lit(0)).cast("int") > 12, F.lit("321")).otherwise(F.lit("312")))
            .when(at == 1, F.when(b, F.lit("213")).otherwise(F.lit("312")))
            .when(at == 2, F.when(a, F.lit("123")).otherwise(F.lit("321")))
            .otherwise(F.when(b, F.lit("231")).otherwise(F.lit("132")))
        )

    named = F.transform(parts, lambda t: _matches(t, _MONTH))
    years = F.transform(parts, lambda t: (F.length(t) > 2) | (t.try_cast("int") > 31))
    shape = F.struct(named.alias("named"), years.alias("years"))

    def date(order: Column) -> Column:
        y, m, d = (F.get(parts, F.substring(order, i, 1).cast("int") - 1) for i in (1, 2, 3))
        century = F.when(F.length(y) > 2, F.lit(0)).when(y.try_cast("int") < 69, F.lit(2000)).otherwise(F.lit(1900))
        month = F.when(_matches(m, _MONTH), (F.instr(F.lit(_SHORT), F.left(m, F.lit(3))) + F.lit(2)).cast("int") / 3).when(F.length(m) <= 2, m.try_cast("int"))
        day = F.when(F.length(d) <= 2, d.try_cast("int"))
        return F.struct((y.try_cast("int") + century).alias("y"), month.cast("int").alias("m"), day.alias("d"))

    several = F.size(F.filter(named, lambda t: t)) > 1
    return F.when(~several, bind(bind(shape, ordered), date))


_OFFSETS = ",".join(f"{name}:{offset}" for name, offset in fixed.ZONE_OFFSETS.items())
_NUMERIC = r"([+-]\d{1,2}):?(\d{2})?$"


def _at_clock(date: Column, clock: Column) -> Column:
    """The moment of a date and a clock, which may be empty."""
    hour, minute, second, half, zone = (F.regexp_extract(clock, _CLOCK, i) for i in range(1, 6))
    read = F.struct(
        hour.try_cast("int").alias("hour"), minute.try_cast("int").alias("minute"),
        F.translate(second, ",", ".").try_cast("decimal(8,6)").alias("second"), half.alias("half"),
        F.coalesce(F.try_element_at(F.str_to_map(F.lit(_OFFSETS)), zone), zone).alias("zone"),
    )

    def turned(c: Column) -> Column:
        twelve = F.when(c["hour"].between(1, 12), c["hour"] % 12 + F.when(c["half"] == "P", F.lit(12)).otherwise(F.lit(0)))
        hours = F.when(c["half"] == "", c["hour"]).otherwise(twelve)
        return F.when(clock == "", F.lit(0)).otherwise(hours)

    def moment(c: Column) -> Column:
        at = F.try_make_timestamp(date["y"], date["m"], date["d"], turned(c), F.coalesce(c["minute"], F.lit(0)), F.coalesce(c["second"], F.lit(0)))
        hours, minutes = (F.coalesce(F.regexp_extract(c["zone"], _NUMERIC, i).try_cast("int"), F.lit(0)) for i in (1, 2))
        shift = F.when(c["zone"].contains("-"), F.lit(-1)).otherwise(F.lit(1)) * (F.abs(hours) * 60 + minutes)
        # Nowhere is the clock a day or more apart.
        return F.when(F.abs(shift) < 1440, F.timestamp_micros(F.unix_micros(at) - shift.cast("bigint") * 60000000))

    return bind(read, moment)


def parse_relative(c: Column, ref: Column) -> Column:
    """Timestamp of a text such as ``3 hours ago``, ``yesterday`` or ``just now``."""
    return bind(F.lower(strip(c)), lambda text: _relative(text, ref))


def _relative(text: Column, ref: Column) -> Column:
    units = F.create_map(*[F.lit(x) for item in fixed.UNIT_SECONDS.items() for x in item])
    amount = F.regexp_extract(text, fixed.RELATIVE_PATTERN, 1).try_cast("bigint")
    seconds = F.try_element_at(units, F.regexp_extract(text, fixed.RELATIVE_PATTERN, 2)).cast("bigint")
    # Nothing was published before the year one.
    oldest = F.unix_timestamp(ref) + F.lit(62135596800)
    past = bind(
        F.try_multiply(amount, seconds),
        lambda age: F.when(age < oldest, F.timestamp_micros(F.unix_micros(ref) - age * 1000000)),
    )
    return (
        F.when(text.contains("just now") | text.contains("moments ago"), ref)
        .when(text.contains("yesterday"), ref - F.expr("INTERVAL 1 DAY"))
        .when(F.rlike(text, F.lit(fixed.RELATIVE_PATTERN)), past)
    )


def _first(candidates: list[tuple[str, Column]], parse: Callable[[Column], Column]) -> Column:
    """The first text that parses, as ``(ts, date_source)``.

    The texts go through one expression as an array; a parser is large, and
    building and planning it once per candidate costs seconds.
    """

    def tagged(parsed: Column) -> Column:
        found = [F.get(parsed, F.lit(i)) for i in range(len(candidates))]
        structs = [F.when(ts.isNotNull(), F.struct(ts.alias("ts"), F.lit(name).alias("date_source"))) for ts, (name, _) in zip(found, candidates)]
        return F.coalesce(*structs) if len(structs) > 1 else structs[0]

    return bind(F.transform(F.array(*[c.cast("string") for _, c in candidates]), parse), tagged)


def publication_time(
    ref: Column,
    feed: Column | None = None,
    json_ld: Column | None = None,
    open_graph: Column | None = None,
    time_tag: Column | None = None,
    raw: Column | None = None,
    relative: Column | None = None,
) -> Column:
    """Best publication time of several candidates, with the candidate's name.

    Returns a struct ``(ts, date_source)``.  Absolute texts win in the order
    feed, JSON-LD, OpenGraph, time tag, raw; after them relative texts in the
    order relative, raw, time tag.
    """
    absolute = [
        ("feed", feed), ("json_ld", json_ld), ("open_graph", open_graph),
        ("time_tag", time_tag), ("raw", raw),
    ]
    fallback = [("relative", relative), ("relative_raw", raw), ("relative_time_tag", time_tag)]
    found = []
    for candidates, parse in ((absolute, parse_absolute), (fallback, lambda c: parse_relative(c, ref))):
        given = [(name, c) for name, c in candidates if c is not None]
        if given:
            found.append(_first(given, parse))
    return F.coalesce(*found) if len(found) > 1 else found[0]


def epoch_or_text(c: Column, ref: Column) -> Column:
    """Timestamp of epoch seconds written as a number, or of a date text."""
    number = F.rlike(c, F.lit(r"^[0-9]+(\.[0-9]+)?([eE]\+?[0-9]+)?$"))
    epoch = F.timestamp_seconds(F.when(number, c.try_cast("decimal(20,6)")))
    return F.when(number, epoch).otherwise(publication_time(ref, raw=c)["ts"])


def iso_utc(c: Column) -> Column:
    """ISO 8601 text in UTC with second precision."""
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'")
