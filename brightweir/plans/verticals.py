"""The five ingests: landed payloads to accepted, quarantined and logged rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, functions as F

from brightweir import fixed_values as fixed
from brightweir.functions.dates import epoch_or_text, iso_utc, parse_absolute, publication_time
from brightweir.functions.html import clean_html, json_ld_date
from brightweir.functions.keys import record_key
from brightweir.functions.text import first_filled
from brightweir.functions.urls import repo_url
from brightweir.operators.dedup import first_wins, upsert
from brightweir.operators.enrich import with_stars
from brightweir.operators.freshness import reason_code
from brightweir.operators.lookup import computed_once
from brightweir.operators.report import ingest_metrics, rejections
from brightweir.operators.resolve import Dictionary, mapping_log, resolve_entities
from brightweir.operators.validate import required
from brightweir.session import scratch_path
from brightweir.sources.landing import parse_items
from brightweir.sources.layouts import LAYOUTS
from brightweir.sources.registry import Source, sources_of

# Arrival order of an item: place of its source in the registry, source, page and position.
ARRIVAL = ["source_rank", "source", "page", "pos"]
NOT_TOPICAL = "NOT_TOPICAL"
EMPTY_RECORD = "EMPTY_RECORD"


@dataclass(frozen=True)
class Ingested:
    """Result of one ingest.

    ``screened`` has every row read, where it came from and its rejection
    ``reason``, before names are resolved or stars joined.  ``judged`` adds the
    output columns and ``hash_key`` of accepted rows; the other tables derive
    from it.  It is built when first asked for, because that stages the items.
    """

    vertical: str
    columns: list[str]
    screened: DataFrame
    finish: Callable[[], DataFrame]

    @cached_property
    def judged(self) -> DataFrame:
        """Every row with its reason or its output columns."""
        return self.finish()

    @property
    def rows(self) -> DataFrame:
        """Accepted rows, the first arrival of each key, in the output layout."""
        accepted = self.judged.where("reason is null").select(*ARRIVAL, *self.columns)
        return first_wins(accepted, "hash_key", ARRIVAL).select(*self.columns)

    @property
    def quarantine(self) -> DataFrame:
        """Rejected rows with their reason."""
        return self.judged.where("reason is not null")

    @property
    def mapping_log(self) -> DataFrame | None:
        """One row per accepted record whose name was resolved."""
        if "method" not in self.judged.columns:
            return None
        return mapping_log(self.judged.where("reason is null"), "raw_name", "source_url", F.col("collected_at"))

    @property
    def metrics(self) -> DataFrame:
        """Discovered, valid, duplicate and rejected rows."""
        return ingest_metrics(self.judged)

    @property
    def rejections(self) -> DataFrame:
        """Rejected rows per reason."""
        return rejections(self.screened)


def items_of(landed: DataFrame, vertical: str, sources: Sequence[Source] | None = None) -> DataFrame:
    """Items of a landed table that may mix the layouts of a vertical.

    ``sources`` lists what is read, in order; the default is the registry.
    """
    kind = "papers" if vertical == "research_papers" else vertical
    layouts = {name: spec for name, spec in LAYOUTS.items() if spec.vertical == kind}
    return parse_items(landed, layouts, sources_of(vertical) if sources is None else sources)


def limited(judged: DataFrame, limit: int | None) -> DataFrame:
    """The first accepted rows in arrival order, if a limit is asked for.

    Rejected rows that arrived before the last of them stay; all do if there
    are fewer accepted rows than the limit.
    """
    if limit is None:
        return judged
    arrival = F.struct(*ARRIVAL)
    first = judged.where("reason is null").orderBy(*ARRIVAL).limit(limit)
    cut = first.agg(F.when(F.count(F.lit(1)) == limit, F.max(arrival)).alias("cut")).scalar()
    return judged.where(cut.isNull() | (arrival <= cut))


def _judge(items: DataFrame, reason: Column, **made: Column) -> DataFrame:
    """Add the rejection reason, and other columns that later steps read."""
    return computed_once(items, reason=F.coalesce("fault", reason), **made).drop("fault")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared scratch folder and read it back.

    Used where several later steps read one costly result: it is computed once,
    and losing an executor afterwards costs a read instead of a recomputation.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _accepted(c: Column) -> Column:
    return F.when(F.col("reason").isNull(), c)


def _common(kind: str, source_name: Column, url: Column, collected_at: Column) -> dict[str, Column]:
    return {
        "schema_version": F.lit(fixed.SCHEMA_VERSION),
        "record_type": F.lit(kind),
        "source_name": source_name,
        "source_url": url,
        "collected_at": collected_at,
    }


def _resolved(judged: DataFrame, name: str, known: Dictionary, mode: str, vertical: str) -> DataFrame:
    # Resolution reads its input twice, for the distinct names and for the records.
    named = staged(judged.withColumn("raw_name", _accepted(F.col(name))), f"items-{vertical}")
    return resolve_entities(named, "raw_name", ARRIVAL, known, mode)


def _ingested(
    vertical: str, judged: DataFrame, complete: Callable[[], tuple[DataFrame, dict[str, Column]]], columns: list[str]
) -> Ingested:
    """An ingest of judged rows; ``complete`` adds what the output columns need."""
    told = [*ARRIVAL, "reason", F.lit(vertical).alias("vertical")]

    def finish() -> DataFrame:
        done, added = complete()
        # What the mapping log needs travels with the judged rows; rejected rows keep only their reason.
        logged = ["raw_name", "canonical_name", "method", "confidence"] if "method" in done.columns else []
        made = [_accepted(added.get(c, F.col(c))).alias(c) for c in [*columns, *logged]]
        return done.select(*told, *made)

    return Ingested(vertical, columns, judged.select(*told), finish)


def ingest_startups(landed: DataFrame, known: Dictionary, collected_at: Column, mode: str = "folded",
                    limit: int | None = None, sources: Sequence[Source] | None = None) -> Ingested:
    """Organisation search pages."""
    items = items_of(landed, "startups", sources)
    judged = _judge(items, required(login=F.col("login"), url=F.col("url")))
    judged = limited(judged, limit)

    def complete() -> tuple[DataFrame, dict[str, Column]]:
        resolved = _resolved(judged, "login", known, mode, "startups")
        added = _common("STARTUP", F.lit(fixed.STARTUP_SOURCE), F.col("url"), collected_at) | {
            "entity_name": F.col("canonical_name"),
            "employee_count": F.lit(None).cast("int"),
            "hash_key": record_key("startup", F.col("canonical_name"), F.col("url")),
        }
        return resolved, added

    columns = ["hash_key", "schema_version", "record_type", "source_name", "source_url", "entity_name",
               "employee_count", "collected_at"]
    return _ingested("startups", judged, complete, columns)


def split_model_id(model_id: Column) -> tuple[Column, Column]:
    """Owner and product of a listing id, cut at the first slash."""
    has_owner = model_id.contains("/")
    owner = F.when(has_owner, F.substring_index(model_id, "/", 1)).otherwise(F.lit(fixed.INDEPENDENT_OWNER))
    product = F.when(has_owner, F.substring(model_id, F.instr(model_id, "/") + 1, F.length(model_id)))
    return owner, F.coalesce(product, model_id)


def ingest_products(landed: DataFrame, known: Dictionary, collected_at: Column, mode: str = "folded",
                    limit: int | None = None, sources: Sequence[Source] | None = None) -> Ingested:
    """Model listings."""
    items = items_of(landed, "products", sources)
    missing = F.when(F.col("model_id").isNull(), F.lit("MISSING_ID"))
    owner, product = split_model_id(F.col("model_id"))
    url = F.concat(F.lit(fixed.MODEL_SITE_PREFIX), F.col("model_id"))
    judged = _judge(items, missing, owner=owner, product=product, url=url)
    judged = limited(judged, limit)

    def complete() -> tuple[DataFrame, dict[str, Column]]:
        resolved = _resolved(judged, "owner", known, mode, "products")
        added = _common("PRODUCT", F.lit(fixed.PRODUCT_SOURCE), F.col("url"), collected_at) | {
            "startup_name": F.col("canonical_name"),
            "pricing_model": F.lit(fixed.PRICING_MODELS[0]),
            "hash_key": record_key("product", F.col("canonical_name"), F.col("url")),
        }
        return resolved, added

    columns = ["hash_key", "schema_version", "record_type", "source_name", "source_url", "startup_name",
               "pricing_model", "collected_at"]
    return _ingested("products", judged, complete, columns)


def ingest_papers(landed: DataFrame, repo_stats: DataFrame, collected_at: Column, limit: int | None = None,
                  sources: Sequence[Source] | None = None) -> Ingested:
    """Daily papers with the stars of their repositories."""
    items = items_of(landed, "research_papers", sources)
    # A date text that cannot be read is kept as it is.
    published = F.coalesce(iso_utc(parse_absolute(F.col("published_text"))), F.col("published_text"))
    empty = F.when(F.col("is_empty"), F.lit(EMPTY_RECORD))
    judged = _judge(items, empty, published_date=published)
    judged = limited(judged, limit)

    def complete() -> tuple[DataFrame, dict[str, Column]]:
        linked = staged(judged.withColumn("github_url", _accepted(repo_url(F.col("repo")))), "items-papers")
        starred = with_stars(linked, "github_url", "own_stars", repo_stats, ARRIVAL)
        paper_url = F.when(F.coalesce("paper_id", F.lit("")) == "", F.lit("")).otherwise(
            F.concat(F.lit(fixed.ABSTRACT_PREFIX), F.col("paper_id"))
        )
        added = {
            "schema_version": F.lit(fixed.SCHEMA_VERSION),
            "record_type": F.lit("RESEARCH_PAPER"),
            "paper_url": paper_url,
            "github_stars": F.col("stars"),
            "collected_at": collected_at,
            "hash_key": record_key("paper", F.col("title"), paper_url),
        }
        return starred, added

    columns = ["hash_key", "schema_version", "record_type", "title", "authors", "paper_url", "github_url",
               "github_stars", "published_date", "collected_at"]
    return _ingested("research_papers", judged, complete, columns)


def _dated(items: DataFrame, needed: Column, ts: Column, ref: Column) -> DataFrame:
    # The freshness verdict counts only for rows that passed everything before it; the others' dates are not read.
    timed = computed_once(items, published_ts=F.when(F.coalesce("fault", needed).isNull(), ts))
    late = reason_code(F.col("published_ts"), ref, missing=fixed.REASON_UNPARSEABLE)
    return _judge(timed, F.coalesce(needed, late))


def ingest_news(landed: DataFrame, ref: Column, collected_at: Column, limit: int | None = None,
                sources: Sequence[Source] | None = None) -> Ingested:
    """Feed items no older than the freshness limit."""
    items = items_of(landed, "news", sources)
    needed = required(title=F.col("title"), url=F.col("url"), date=F.col("published_text"))
    ts = publication_time(ref, feed=F.col("published_text"))["ts"]
    judged = _dated(items, needed, ts, ref)
    judged = limited(judged, limit)

    def complete() -> tuple[DataFrame, dict[str, Column]]:
        # Only accepted pages are handed to the parser.
        summary = clean_html(_accepted(F.col("body")), fixed.MAX_SUMMARY_CHARS)
        added = _common("NEWS", F.col("recorded"), F.col("url"), collected_at) | {
            "published_date": iso_utc(F.col("published_ts")),
            "summary": summary,
            "hash_key": record_key("news", F.col("title"), F.col("url")),
        }
        return judged, added

    columns = ["hash_key", "schema_version", "record_type", "source_name", "source_url", "title",
               "published_date", "summary", "collected_at"]
    return _ingested("news", judged, complete, columns)


def ingest_jobs(landed: DataFrame, known: Dictionary, ref: Column, collected_at: Column, mode: str = "folded",
                limit: int | None = None, sources: Sequence[Source] | None = None) -> Ingested:
    """Postings of five board layouts in one canonical form."""
    items = items_of(landed, "jobs", sources)
    off_topic = F.when(~F.col("is_topical"), F.lit(NOT_TOPICAL))
    no_company = F.when(~F.col("company_optional"), required(company=F.col("company")))
    needed = F.coalesce(no_company, required(date=F.col("published_text")))
    ts = epoch_or_text(F.col("published_text"), ref)
    judged = _dated(items, F.coalesce(off_topic, needed), ts, ref)
    judged = limited(judged, limit)

    def complete() -> tuple[DataFrame, dict[str, Column]]:
        resolved = _resolved(judged, "company", known, mode, "jobs")
        url = F.coalesce("url", F.lit(""))
        added = _common("JOB", F.col("recorded"), url, collected_at) | {
            "company": F.col("canonical_name"),
            "published_date": iso_utc(F.col("published_ts")),
            "role_family": F.lit(fixed.ROLE_FAMILY),
            "hash_key": record_key("job", F.col("canonical_name"), url),
        }
        return resolved, added

    columns = ["hash_key", "schema_version", "record_type", "source_name", "source_url", "company",
               "published_date", "is_remote", "role_family", "collected_at"]
    return _ingested("jobs", judged, complete, columns)


def extract_pages(df: DataFrame, page: str, ref: Column) -> DataFrame:
    """Title, text and publication date of pages whose parts have been read."""
    best = publication_time(
        ref,
        json_ld=json_ld_date(F.col(f"{page}.json_ld")),
        open_graph=F.col(f"{page}.og_published_time"),
        time_tag=F.col(f"{page}.time_tag"),
    )
    return df.withColumns(
        {
            "title": F.coalesce(first_filled(F.col(f"{page}.og_title"), F.col(f"{page}.title")), F.lit("")),
            "text": F.col(f"{page}.text"),
            "published_date": iso_utc(best["ts"]),
        }
    )


# Flat column of each output table: where it sits in the nested record.
FLAT_COLUMNS = {
    "STARTUP": {
        "source_name": "source.name", "source_url": "source.url", "entity_name": "content.entityName",
        "employee_count": "content.data.employeeCount",
    },
    "PRODUCT": {
        "source_name": "source.name", "source_url": "source.url", "startup_name": "content.startupName",
        "pricing_model": "content.pricingModel",
    },
    "RESEARCH_PAPER": {
        "title": "content.title", "authors": "content.authors", "paper_url": "content.paper_url",
        "github_url": "content.github_url", "github_stars": "content.github_stars",
        "published_date": "content.published_date",
    },
    "JOB": {
        "source_name": "source_name", "source_url": "source_url", "company": "content.company",
        "published_date": "content.date", "is_remote": "content.is_remote", "role_family": "content.role_family",
    },
    "NEWS": {
        "source_name": "source.name", "source_url": "source.url", "title": "content.title",
        "published_date": "content.published_date", "summary": "content.summary",
    },
}


def flattened(records: DataFrame, kind: str) -> DataFrame:
    """Nested records of a kind in the flat layout of its output table."""
    return records.select(*[F.col(path).alias(name) for name, path in FLAT_COLUMNS[kind].items()])


def run_vertical(ingested: Ingested, root: str) -> dict[str, int]:
    """Run an ingest once and append to the tables below ``root``.

    The judged rows are staged first, so that the data sink, the quarantine, the
    mapping log and the counts all read one result.  Returns inserted, duplicate
    and rejected counts.
    """
    judged = staged(ingested.judged, f"judged-{ingested.vertical}")
    done = Ingested(ingested.vertical, ingested.columns, judged, lambda: judged)
    counts = upsert(judged.where("reason is null").select(*ARRIVAL, *done.columns), f"{root}/{done.vertical}", "hash_key", ARRIVAL)
    rejected = done.quarantine.select(*ARRIVAL, "vertical", "reason")
    rejected.write.mode("append").partitionBy("vertical", "reason").parquet(f"{root}/quarantine")
    if done.mapping_log is not None:
        done.mapping_log.write.mode("append").parquet(f"{root}/entity_mappings")
    return counts | {"rejected": rejected.count()}
