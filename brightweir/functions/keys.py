"""Stable record keys."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from brightweir.functions.text import strip


def entity_key(scope: str | Column, text: Column) -> Column:
    """SHA-256 of ``scope:text`` with the text stripped and lower-cased."""
    scope = F.lit(scope) if isinstance(scope, str) else scope
    return F.sha2(F.concat(scope, F.lit(":"), F.lower(strip(text))), 256)


def record_key(scope: str, name: Column, url: Column) -> Column:
    """Key of a record: its name and URL joined by a colon, within a scope."""
    return entity_key(scope, F.concat(name, F.lit(":"), url))


def fingerprint(url: Column, iso_time: Column) -> Column:
    """SHA-256 of a canonical URL followed by a publication time."""
    return F.sha2(F.concat(url, iso_time), 256)
