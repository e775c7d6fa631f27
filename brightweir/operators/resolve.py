"""Resolving organisation names to canonical names, with an audit log.

Costly work runs once per distinct name.  A name is looked up among the aliases
first; only names no alias knows are compared with the canonical names.  The
result is joined back to the records with hot names spread over many tasks.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from brightweir import fixed_values as fixed
from brightweir.functions.names import (
    normal_name,
    sorted_similarity,
    sorted_tokens,
    title_name,
    without_accents,
)
from brightweir.functions.text import is_blank, strip
from brightweir.operators.lookup import BROADCAST_ROWS, computed_once, key_counts, shuffle_partitions, spread_lookup

# Canonical names up to this many are compared as one literal list; a longer
# dictionary is matched by an equi-join on shared pieces.
LITERAL_CANONICALS = 500


@dataclass(frozen=True)
class Dictionary:
    """Aliases and canonical names as tables."""

    aliases: DataFrame  # alias_key, alias_name
    canonicals: DataFrame  # canonical_name, ord
    names: tuple[str, ...]  # canonical names in order
    alias_count: int


def dictionary(
    spark: SparkSession, table: dict[str, list[str]] | None = None, normalize_aliases: bool = False
) -> Dictionary:
    """Dictionary tables of a canonical-name-to-aliases mapping.

    Alias keys are lower-cased texts.  As names are normalised before the
    lookup, an alias holding a legal suffix word can never be hit unless
    ``normalize_aliases`` brings the keys into the same form.
    """
    table = fixed.ALIASES if table is None else table
    keys = {}
    for canonical, aliases in table.items():
        for alias in [canonical, *aliases]:
            keys[alias.lower().strip()] = canonical
    aliases = spark.createDataFrame(
        pd.DataFrame(keys.items(), columns=["alias_key", "alias_name"]), "alias_key string, alias_name string"
    )
    if normalize_aliases:
        normal = normal_name(without_accents(F.col("alias_key")))
        aliases = aliases.withColumn("alias_key", normal).where("alias_key <> ''").dropDuplicates(["alias_key"])
    canonicals = spark.createDataFrame(
        pd.DataFrame({"canonical_name": list(table), "ord": range(len(table))}), "canonical_name string, ord int"
    )
    return Dictionary(aliases, canonicals, tuple(table), len(keys))


def normalized_names(df: DataFrame, name: str) -> DataFrame:
    """Distinct names with how often they occur (``n_rows``) and their normal form."""
    # As a plain column, a filter on the normal form would be pushed below the grouping, where every row pays for it.
    return computed_once(key_counts(df, name), normal=normal_name(without_accents(strip(F.col(name)))))


def exact_matches(names: DataFrame, known: Dictionary) -> DataFrame:
    """Add ``alias_name``: the canonical name the normal form is an alias of."""
    aliases = F.broadcast(known.aliases) if known.alias_count <= BROADCAST_ROWS else known.aliases
    return names.join(aliases, F.col("normal") == F.col("alias_key"), "left").drop("alias_key")


def _check_mode(mode: str) -> None:
    if mode not in ("folded", "compat"):
        raise ValueError(f"unknown matching mode {mode}")


def _shape(name: Column, mode: str) -> Column:
    # "folded" compares in lower case; "compat" keeps the capitals of display names.
    return sorted_tokens(F.lower(name) if mode == "folded" else name)


def _shared_letters(a: Column, b: Column) -> Column:
    return F.length(a) - F.length(F.call_function("translate", a, b, F.lit("")))


def _reachable(a: Column, b: Column, floor: float) -> Column:
    # A bound on the score: the letters of either text that the other one has at all.
    shared = F.least(_shared_letters(a, b), _shared_letters(b, a))
    return F.lit(200.0) * shared >= F.lit(floor) * (F.length(a) + F.length(b))


def _best_of_literal(names: DataFrame, known: Dictionary, mode: str, floor: float) -> DataFrame:
    _check_mode(mode)
    # A foldable expression: the optimizer turns it into one literal.
    listed = [
        {"shape": " ".join(sorted((name.lower() if mode == "folded" else name).split())), "rank": -i, "name": name}
        for i, name in enumerate(known.names)
    ]
    canonicals = F.from_json(F.lit(json.dumps(listed)), "array<struct<shape:string,rank:int,name:string>>")
    tokens = F.col("tokens")
    scored = F.transform(
        F.filter(canonicals, lambda c: _reachable(tokens, c["shape"], floor)),
        lambda c: F.struct(
            sorted_similarity(tokens, c["shape"]).alias("score"), c["rank"].alias("rank"), c["name"].alias("name")
        ),
    )
    shaped = names.withColumn("tokens", sorted_tokens(F.col("normal")))
    best = computed_once(shaped, best=F.array_max(scored))
    return best.where(F.col("best.score") >= floor).select(
        "normal", F.col("best.name").alias("best_name"), F.col("best.score").alias("best_score")
    )


def _best_of_pieces(names: DataFrame, known: Dictionary, mode: str, floor: float) -> DataFrame:
    """Exact best matches without comparing all pairs.

    A score of at least ``floor`` allows a bounded number of insertions and
    deletions.  Cutting a canonical name into one piece more than that bound
    leaves at least one piece intact in every name that can reach the score,
    moved by no more than the bound.  Pieces are therefore join keys.
    """
    _check_mode(mode)
    slack = 1.0 - floor / 100.0
    allowed = lambda a, b: F.floor(F.lit(slack + 1e-9) * (a + b)).cast("int")

    shapes = known.canonicals.withColumn("shape", _shape(F.col("canonical_name"), mode)).withColumn(
        "width", F.length("shape")
    )
    tokens = names.withColumn("tokens", sorted_tokens(F.col("normal"))).where("tokens <> ''")
    # Lengths a partner can have: the shorter side holds at least floor/(200-floor) of the longer.
    ratio = floor / (200.0 - floor)
    lengths = F.sequence(
        F.ceil(F.length("tokens") * F.lit(ratio) - F.lit(1e-9)).cast("int"),
        F.floor(F.length("tokens") / F.lit(ratio) + F.lit(1e-9)).cast("int"),
    )
    probes = tokens.withColumn("width", F.explode(lengths)).withColumn("len", F.length("tokens"))
    wanted = probes.select("width", "len").distinct()
    # Pieces of each canonical name for every length of partner that occurs.
    pieces = (
        shapes.join(wanted, "width")
        .withColumn("n", F.least(allowed(F.col("width"), F.col("len")) + 1, F.col("width")))
        .withColumn("k", F.explode(F.expr("sequence(0, n - 1)")))
        .withColumn("start", F.floor(F.col("k") * F.col("width") / F.col("n")).cast("int"))
        .withColumn("stop", F.floor((F.col("k") + 1) * F.col("width") / F.col("n")).cast("int"))
        .select(
            "width", "len", "k", "canonical_name", "ord", "shape",
            F.expr("substring(shape, start + 1, stop - start)").alias("piece"),
        )
    )
    probes = (
        probes.withColumn("edits", allowed(F.col("width"), F.col("len")))
        .withColumn("n", F.least(F.col("edits") + 1, F.col("width")))
        .withColumn("k", F.explode(F.expr("sequence(0, n - 1)")))
        .withColumn("start", F.floor(F.col("k") * F.col("width") / F.col("n")).cast("int"))
        .withColumn("stop", F.floor((F.col("k") + 1) * F.col("width") / F.col("n")).cast("int"))
        .withColumn("shift", F.explode(F.expr("sequence(-edits, edits)")))
        .withColumn("at", F.col("start") + F.col("shift"))
        .where("at >= 0 and at + stop - start <= len")
        .select(
            "normal", "tokens", "width", "len", "k",
            F.expr("substring(tokens, at + 1, stop - start)").alias("piece"),
        )
        .distinct()
    )
    candidates = probes.join(pieces, ["width", "len", "k", "piece"]).select(
        "normal", "tokens", "canonical_name", "ord", "shape"
    ).distinct()
    scored = candidates.withColumn("score", sorted_similarity(F.col("tokens"), F.col("shape"))).where(
        F.col("score") >= floor
    )
    best = scored.groupBy("normal").agg(
        F.max(F.struct("score", (-F.col("ord")).alias("rank"), F.col("canonical_name").alias("name"))).alias("best")
    )
    return best.select("normal", F.col("best.name").alias("best_name"), F.col("best.score").alias("best_score"))


def fuzzy_matches(
    names: DataFrame, known: Dictionary, mode: str = "folded", floor: float = fixed.FUZZY_REVIEW
) -> DataFrame:
    """Best canonical name per normal form scoring at least ``floor``; first in order on ties.

    ``names`` has a column ``normal``.  The result has ``normal``, ``best_name``
    and the unrounded ``best_score``.
    """
    # Few bytes but much work per name: not to be merged by size.
    parts = shuffle_partitions(names)
    distinct = names.select("normal").where("normal <> ''").repartition(parts, "normal").distinct()
    if len(known.names) <= LITERAL_CANONICALS:
        return _best_of_literal(distinct, known, mode, floor)
    return _best_of_pieces(distinct, known, mode, floor)


def resolve_names(
    names: DataFrame,
    known: Dictionary,
    mode: str = "folded",
    accept: float = fixed.FUZZY_ACCEPT,
    review: float = fixed.FUZZY_REVIEW,
) -> DataFrame:
    """Add ``canonical_name``, ``method``, ``confidence``, ``best_score``, ``review``, ``empty_canonical``."""
    exact = exact_matches(names, known)
    open_names = exact.where("alias_name is null")
    best = fuzzy_matches(open_names, known, mode, min(accept, review))
    # The normal form is the join key only for names no alias knows.
    probed = exact.withColumn("probe", F.when(F.col("alias_name").isNull(), F.col("normal")))
    joined = probed.join(best.withColumnRenamed("normal", "probe"), "probe", "left").drop("probe")

    accepted = F.col("best_score") >= accept
    name = F.when(F.col("alias_name").isNotNull(), F.col("alias_name")).when(accepted, F.col("best_name"))
    return joined.select(
        *names.columns,
        F.coalesce(name, title_name(F.col("normal"))).alias("canonical_name"),
        F.when(F.col("alias_name").isNotNull(), F.lit(fixed.METHOD_EXACT))
        .when(accepted, F.lit(fixed.METHOD_FUZZY))
        .otherwise(F.lit(fixed.METHOD_TITLECASE))
        .alias("method"),
        F.when(F.col("alias_name").isNotNull(), F.lit(fixed.CONFIDENCE_EXACT))
        .when(accepted, F.bround("best_score", 1))
        .otherwise(F.lit(fixed.CONFIDENCE_TITLECASE))
        .alias("confidence"),
        "best_name",
        "best_score",
        F.coalesce((F.col("best_score") >= review) & (F.col("best_score") < accept), F.lit(False)).alias("review"),
        (F.col("normal") == "").alias("empty_canonical"),
    )


def resolve_entities(
    df: DataFrame,
    name: str,
    spread_by: Sequence[str],
    known: Dictionary,
    mode: str = "folded",
    accept: float = fixed.FUZZY_ACCEPT,
    review: float = fixed.FUZZY_REVIEW,
) -> DataFrame:
    """Every record with the canonical name of one of its columns.

    Adds ``canonical_name``, ``method``, ``confidence``, ``review`` and
    ``empty_canonical``.  Null and blank names become ``Unknown``.
    """
    filled = df.withColumn("_name", F.when(~is_blank(F.col(name)), strip(F.col(name))))
    names = normalized_names(filled, "_name")
    resolved = resolve_names(names, known, mode, accept, review)
    joined = spread_lookup(
        filled,
        resolved.select("_name", "n_rows", "canonical_name", "method", "confidence", "review", "empty_canonical"),
        "_name",
        spread_by,
        key_counts(filled, "_name"),
    )
    blank = F.col("_name").isNull()
    return joined.withColumns(
        {
            "canonical_name": F.when(blank, F.lit(fixed.UNKNOWN_NAME)).otherwise(F.col("canonical_name")),
            "method": F.when(blank, F.lit(fixed.METHOD_EMPTY)).otherwise(F.col("method")),
            "confidence": F.when(blank, F.lit(fixed.CONFIDENCE_EMPTY)).otherwise(F.col("confidence")),
            "review": F.coalesce("review", F.lit(False)),
            "empty_canonical": F.coalesce("empty_canonical", F.lit(False)),
        }
    ).drop("_name")


def mapping_log(resolved: DataFrame, name: str, url: str, timestamp: Column) -> DataFrame:
    """One log row per resolved record."""
    raw = F.when(is_blank(F.col(name)), F.coalesce(name, F.lit(""))).otherwise(strip(F.col(name)))
    return resolved.select(
        raw.alias("raw_name"),
        "canonical_name",
        "method",
        "confidence",
        F.col(url).alias("source_url"),
        timestamp.alias("timestamp"),
    )


def method_stats(log: DataFrame) -> DataFrame:
    """Mappings and mean confidence per resolution method."""
    return log.groupBy("method").agg(
        F.count(F.lit(1)).alias("n_mappings"), F.avg("confidence").alias("avg_confidence")
    )
