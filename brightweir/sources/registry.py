"""The source registry as a dimension table."""

from __future__ import annotations

from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from brightweir import fixed_values as fixed

# Why the items of a source that is switched off are rejected.
DISABLED_SOURCE = "DISABLED_SOURCE"

SCHEMA = (
    "vertical string, name string, type string, parser_type string, rate_limit_rps int, enabled boolean"
)


@dataclass(frozen=True)
class Source:
    """A source that an ingest reads: its name in the registry, and the layout of its pages."""

    name: str
    layout: str
    enabled: bool = True

    @property
    def recorded(self) -> str:
        """The name that its records carry."""
        return fixed.BOARD_NAMES.get(self.layout, self.name)


def sources_of(vertical: str, rows: list[tuple] | None = None) -> list[Source]:
    """The sources of a vertical whose layout is known, in the order of the registry."""
    rows = fixed.REGISTRY if rows is None else rows
    layouts = {name: fixed.LAYOUT_OF_PARSER.get((of, parser)) for of, name, _, parser, _, _ in rows if of == vertical}
    enabled = {name: on for of, name, _, _, _, on in rows if of == vertical}
    return [Source(name, layout, enabled[name]) for name, layout in layouts.items() if layout]


def registry(spark: SparkSession, rows: list[tuple] | None = None) -> DataFrame:
    """Registry rows; the default lists every known source."""
    rows = fixed.REGISTRY if rows is None else rows
    frame = pd.DataFrame(rows, columns=[part.split(" ")[0] for part in SCHEMA.split(", ")])
    frame["rate_limit_rps"] = frame["rate_limit_rps"].astype("Int64")
    return spark.createDataFrame(frame, SCHEMA)


def coverage(items: DataFrame, sources: DataFrame) -> DataFrame:
    """Every registered source with the items it delivered, and those turned away because it is off.

    ``items`` has ``source`` and ``fault``.
    """
    disabled = F.coalesce(F.col("fault") == DISABLED_SOURCE, F.lit(False))
    counts = items.groupBy(F.col("source").alias("name")).agg(
        F.count(F.when(F.col("fault").isNull(), F.lit(1))).alias("n_rows"), F.count(F.when(disabled, F.lit(1))).alias("n_disabled")
    )
    return sources.join(counts, "name", "left").select(
        "vertical", "name", "enabled", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n_rows", "n_disabled")]
    )
