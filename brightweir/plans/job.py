"""One run over landed tables: ingest, append, report, export."""

from __future__ import annotations

import time
from collections.abc import Sequence
from datetime import datetime

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from brightweir import fixed_values as fixed
from brightweir.functions.dates import reference
from brightweir.operators import report, resolve
from brightweir.plans import verticals
from brightweir.session import configure
from brightweir.sinks import export
from brightweir.sources.registry import Source

VERTICALS = ("startups", "products", "research_papers", "news", "jobs")


def run(
    spark: SparkSession,
    landed: dict[str, DataFrame],
    root: str,
    reference_time: datetime | str,
    collected_at: str,
    repo_stats: DataFrame | None = None,
    sources: dict[str, Sequence[Source]] | None = None,
    known: resolve.Dictionary | None = None,
    mode: str = "folded",
    limits: dict[str, int] | None = None,
    export_dir: str | None = None,
) -> DataFrame:
    """Ingest the given verticals and append their rows to the tables below ``root``.

    ``landed`` maps a vertical to its landed table (``source, page, payload``);
    verticals that are left out are not run.  ``sources`` overrides what the
    registry lists for a vertical.  Nothing depends on the clock but
    the elapsed time in the report, so a run can be repeated.  Returns one row
    per vertical and a total.
    """
    unknown = set(landed) - set(VERTICALS)
    if unknown:
        raise ValueError(f"unknown verticals {sorted(unknown)}")
    configure(spark)
    ref, collected = reference(reference_time), F.lit(collected_at)
    known = known or resolve.dictionary(spark)
    limits = limits or {}
    if repo_stats is None:
        repo_stats = spark.createDataFrame([], "repo_key string, stars long")
    sources = sources or {}

    def ingested(vertical: str) -> verticals.Ingested:
        table, limit, read = landed[vertical], limits.get(vertical), sources.get(vertical)
        if vertical == "startups":
            return verticals.ingest_startups(table, known, collected, mode, limit, read)
        if vertical == "products":
            return verticals.ingest_products(table, known, collected, mode, limit, read)
        if vertical == "research_papers":
            return verticals.ingest_papers(table, repo_stats, collected, limit, read)
        if vertical == "news":
            return verticals.ingest_news(table, ref, collected, limit, read)
        return verticals.ingest_jobs(table, known, ref, collected, mode, limit, read)

    started = time.monotonic()
    counts = []
    for vertical in (v for v in VERTICALS if v in landed):
        done = verticals.run_vertical(ingested(vertical), root)
        discovered = done["inserted"] + done["duplicates"] + done["rejected"]
        counts.append((vertical, discovered, done["inserted"], done["duplicates"], done["rejected"]))
    if export_dir:
        tables = {name: export.read_output_table(spark, root, name) for name in fixed.OUTPUT_TABLES}
        export.export_csv({name: df for name, df in tables.items() if df is not None}, export_dir)

    columns = ["vertical", "discovered", "valid", "duplicates", "rejected"]
    metrics = spark.createDataFrame(
        pd.DataFrame(counts, columns=columns), "vertical string, discovered long, valid long, duplicates long, rejected long"
    )
    return report.with_totals(metrics, F.lit(time.monotonic() - started))
