"""Freshness of records against a reference time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from brightweir import fixed_values as fixed
from brightweir.functions.dates import parse_absolute


def _bounds(ref: Column, kind: str, max_age_hours: int, drift_minutes: int) -> tuple[Column, Column]:
    # Literals of the column's own type, so that the scan can use the range.
    base = ref.cast(kind)
    earliest = base - F.make_dt_interval(hours=F.lit(max_age_hours))
    latest = base + F.make_dt_interval(mins=F.lit(drift_minutes))
    return earliest, latest


def fresh_only(
    df: DataFrame,
    ts: str,
    ref: Column,
    max_age_hours: int = fixed.MAX_AGE_HOURS,
    drift_minutes: int = fixed.DRIFT_MINUTES,
) -> DataFrame:
    """Rows inside the closed freshness interval, as a range on the typed column."""
    earliest, latest = _bounds(ref, dict(df.dtypes)[ts], max_age_hours, drift_minutes)
    return df.where(F.col(ts).between(earliest, latest))


def reason_code(
    ts: Column,
    ref: Column,
    max_age_hours: int = fixed.MAX_AGE_HOURS,
    drift_minutes: int = fixed.DRIFT_MINUTES,
    missing: str = fixed.REASON_INVALID_TYPE,
) -> Column:
    """Why a time is not fresh; null when it is."""
    earliest, latest = _bounds(ref, "timestamp", max_age_hours, drift_minutes)
    return (
        F.when(ts.isNull(), F.lit(missing))
        .when(ts < earliest, F.lit(fixed.REASON_STALE))
        .when(ts > latest, F.lit(fixed.REASON_FUTURE))
    )


def with_freshness(
    df: DataFrame,
    ts: str,
    ref: Column,
    max_age_hours: int = fixed.MAX_AGE_HOURS,
    drift_minutes: int = fixed.DRIFT_MINUTES,
) -> DataFrame:
    """Add ``is_fresh``, ``reason_code``, ``reason`` and ``age_seconds``.

    The column may hold times or date texts; a text without a readable date and
    a missing value get different codes.
    """
    column = F.col(ts)
    is_text = dict(df.dtypes)[ts] == "string"
    time = parse_absolute(column) if is_text else column.cast("timestamp")
    missing = F.when(column.isNotNull() & time.isNull(), F.lit(fixed.REASON_UNPARSEABLE)) if is_text else None
    code = reason_code(time, ref, max_age_hours, drift_minutes)
    if missing is not None:
        code = F.coalesce(missing, code)
    age = (F.unix_micros(ref) - F.unix_micros(time)) / F.lit(1000000.0)
    judged = df.withColumns({"reason_code": code, "age_seconds": age})
    text = (
        F.when(
            F.col("reason_code") == fixed.REASON_STALE,
            F.format_string(
                f"{fixed.REASON_STALE} (age: %.1fh > {max_age_hours}h)", F.col("age_seconds") / 3600.0
            ),
        )
        .when(
            F.col("reason_code") == fixed.REASON_FUTURE,
            F.format_string(f"{fixed.REASON_FUTURE} (drift: +%.1fm)", -F.col("age_seconds") / 60.0),
        )
        .otherwise(F.col("reason_code"))
    )
    return judged.withColumns({"is_fresh": F.col("reason_code").isNull(), "reason": text})
