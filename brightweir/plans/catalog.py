"""The registered queries: one per operator, each over whole given tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from brightweir import fixed_values as fixed
from brightweir.functions import dates, html, keys, names, text, urls
from brightweir.operators import chunking, dedup, enrich, extraction, freshness, lookup, relations, report, resolve, semantic, validate
from brightweir.plans import verticals, workload as w
from brightweir.session import configure, scratch_path
from brightweir.sinks import export
from brightweir.sources import registry
from brightweir.streaming import monitor

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    """Register a query under its function name."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(configure(spark), sf_dir.rstrip("/"))

    QUERIES[function.__name__] = run
    return function


def _ref() -> Column:
    return dates.reference(w.NEWS_REF)


def _collected() -> Column:
    return F.lit("2024-01-15T12:30:00Z")


def _spread(df: DataFrame) -> DataFrame:
    """Use all cores for per-row Python work on inputs of few partitions.

    A large table already has more partitions than cores and is not shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


# --- URLs --------------------------------------------------------------------


def _addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return w.derived(spark, sf_dir, w.addresses)


@query
def url_canonicalize(spark, sf_dir):
    return _addresses(spark, sf_dir).withColumn("canonical", urls.canonical_url(F.col("url")))


@query
def url_hash(spark, sf_dir):
    return _addresses(spark, sf_dir).select("page_id", urls.url_key(F.col("url")).alias("url_hash"))


@query
def url_dedup_first_seen(spark, sf_dir):
    # Addresses of one page under different parameters count as the same.
    bare = F.substring_index(urls.canonical_url(F.col("url")), "?", 1)
    keyed = _addresses(spark, sf_dir).select("page_id", F.sha2(bare, 256).alias("url_hash"))
    return dedup.mark_repeats(keyed, "url_hash", ["page_id"])


@query
def url_frontier_antijoin(spark, sf_dir):
    pages = _addresses(spark, sf_dir)
    documents = w.table(spark, sf_dir, "documents").where("lang <> 'en'")
    done = pages.join(documents, F.col("page_id") == F.col("doc_id"), "left_semi")
    ledger = done.select(urls.url_key(F.col("url")).alias("url_hash"))
    return dedup.unseen_urls(pages, "url", ledger).select("page_id", "url", "url_hash")


@query
def processed_url_ledger(spark, sf_dir):
    return dedup.url_ledger(_addresses(spark, sf_dir), "url", F.lit("crawl"), _collected(), ["page_id"])


@query
def composite_fingerprint(spark, sf_dir):
    time = F.timestamp_seconds(F.lit(w.REF_EPOCH) - F.col("page_id") * 600)
    mark = keys.fingerprint(urls.canonical_url(F.col("url")), dates.iso_utc(time))
    return _addresses(spark, sf_dir).select("page_id", mark.alias("fingerprint"))


@query
def repo_key_extract(spark, sf_dir):
    return w.derived(spark, sf_dir, w.repo_addresses).select("k", urls.repo_key(F.col("repo")).alias("repo_key"))


# --- Keys and deduplication ------------------------------------------------------


@query
def entity_hash_key(spark, sf_dir):
    organisations = w.derived(spark, sf_dir, w.organisations)
    return organisations.select("id", keys.entity_key("organisation", F.col("raw_name")).alias("hash_key"))


def _keyed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = w.table(spark, sf_dir, "documents")
    return documents.select("doc_id", "source", keys.entity_key("document", F.col("text")).alias("hash_key"))


@query
def scoped_dedup(spark, sf_dir):
    documents = w.table(spark, sf_dir, "documents")
    keyed = documents.select("doc_id", keys.entity_key(F.col("lang"), F.col("text")).alias("hash_key"))
    return dedup.mark_repeats(keyed, "hash_key", ["doc_id"])


@query
def dedup_accounting(spark, sf_dir):
    return dedup.accounting(_keyed_documents(spark, sf_dir), "hash_key", ["doc_id"], "source")


@query
def idempotent_upsert(spark, sf_dir):
    """The table after the same batch has been inserted twice."""
    batch = _keyed_documents(spark, sf_dir).withColumn("seq", F.col("doc_id"))
    path = scratch_path(spark, "documents")
    dedup.upsert(batch, path, "hash_key", ["seq"])
    dedup.upsert(batch, path, "hash_key", ["seq"])
    return spark.read.parquet(path)


# --- Dates and freshness -----------------------------------------------------------


@query
def date_parse_absolute(spark, sf_dir):
    parsed = dates.iso_utc(dates.parse_absolute(F.col("date_text")))
    return w.derived(spark, sf_dir, w.date_texts).select("k", "date_text", parsed.alias("parsed"))


@query
def date_parse_general(spark, sf_dir):
    """Dates in orders and spellings beyond the usual shapes."""
    parsed = dates.iso_utc(dates.parse_absolute(F.col("date_text")))
    return _spread(w.derived(spark, sf_dir, w.general_date_texts)).select("k", "date_text", parsed.alias("parsed"))


@query
def date_parse_relative(spark, sf_dir):
    parsed = dates.iso_utc(dates.parse_relative(F.col("date_text"), _ref()))
    return w.derived(spark, sf_dir, w.date_texts).select("k", "date_text", parsed.alias("parsed"))


@query
def publication_date_priority(spark, sf_dir):
    columns = ["feed", "json_ld", "open_graph", "time_tag", "raw", "relative"]
    best = dates.publication_time(_ref(), **{c: F.col(c) for c in columns})
    resolved = w.derived(spark, sf_dir, w.date_candidates).withColumn("best", best)
    return resolved.select("k", dates.iso_utc(F.col("best.ts")).alias("published"), F.col("best.date_source").alias("date_source"))


@query
def date_format_iso(spark, sf_dir):
    return w.table(spark, sf_dir, "events").select("event_id", dates.iso_utc(F.col("ts").cast("timestamp")).alias("iso"))


@query
def freshness_verdict(spark, sf_dir):
    judged = freshness.with_freshness(w.table(spark, sf_dir, "events"), "ts", _ref())
    return judged.select("event_id", "is_fresh", "reason_code", F.round("age_seconds", 6).alias("age_seconds"))


@query
def freshness_filter(spark, sf_dir):
    fresh = freshness.fresh_only(w.table(spark, sf_dir, "events"), "ts", _ref())
    return fresh.select("event_id", "user_id", "event_type")


# --- Names -----------------------------------------------------------------------


def _organisations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return w.derived(spark, sf_dir, w.organisations)


def _names(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Distinct non-blank names in their stripped form.
    organisations = _organisations(spark, sf_dir)
    stripped = organisations.select(text.strip(F.col("raw_name")).alias("raw_name")).where("raw_name <> ''")
    return resolve.normalized_names(stripped, "raw_name")


@query
def entity_normalize(spark, sf_dir):
    return _names(spark, sf_dir)


@query
def entity_exact_alias(spark, sf_dir):
    return resolve.exact_matches(_names(spark, sf_dir), resolve.dictionary(spark)).select("normal", "n_rows", "alias_name")


def _fuzzy(spark: SparkSession, sf_dir: str, mode: str) -> DataFrame:
    known = resolve.dictionary(spark)
    unknown = resolve.exact_matches(_names(spark, sf_dir), known).where("alias_name is null")
    best = resolve.fuzzy_matches(unknown, known, mode).where("best_name is not null")
    return best.select(
        "normal", "best_name", F.round("best_score", 6).alias("best_score"),
        (F.col("best_score") >= fixed.FUZZY_ACCEPT).alias("accepted"),
    )


@query
def entity_fuzzy_match(spark, sf_dir):
    return _fuzzy(spark, sf_dir, "folded")


@query
def entity_fuzzy_match_compat(spark, sf_dir):
    return _fuzzy(spark, sf_dir, "compat")


def _resolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve.resolve_entities(_organisations(spark, sf_dir), "raw_name", ["id"], resolve.dictionary(spark))


@query
def entity_resolve(spark, sf_dir):
    return _resolved(spark, sf_dir).select("id", "canonical_name", "method", "confidence")


def _mapping_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve.mapping_log(_resolved(spark, sf_dir), "raw_name", "source_url", _collected())


@query
def entity_mapping_log(spark, sf_dir):
    path = scratch_path(spark, "entity_mappings")
    _mapping_log(spark, sf_dir).write.mode("append").parquet(path)
    return spark.read.parquet(path)


@query
def entity_method_stats(spark, sf_dir):
    stats = resolve.method_stats(_mapping_log(spark, sf_dir))
    return stats.withColumn("avg_confidence", F.round("avg_confidence", 6))


@query
def entity_review_band(spark, sf_dir):
    resolved = resolve.resolve_names(_names(spark, sf_dir), resolve.dictionary(spark))
    return resolved.where("review").select("raw_name", "normal", "best_name", F.round("best_score", 6).alias("best_score"))


@query
def token_sort_similarity(spark, sf_dir):
    parts = w.table(spark, sf_dir, "part")
    pairs = parts.select(
        F.lower(F.concat_ws(" ", "p_type", "p_name")).alias("a"), F.lower(F.concat_ws(" ", "p_name", "p_brand")).alias("b")
    )
    # Repartitioning on the pair serves the distinct and gives every core a share of the scoring.
    pairs = pairs.repartition(lookup.shuffle_partitions(pairs), "a", "b").distinct()
    return pairs.withColumn("score", F.round(names.token_similarity(F.col("a"), F.col("b")), 6))


# --- Pages and text ----------------------------------------------------------------


@query
def html_clean_text(spark, sf_dir):
    pages = _spread(w.table(spark, sf_dir, "pages").select("page_id", "html"))
    return pages.select("page_id", html.clean_html(F.col("html")).alias("text"))


@query
def html_strip_tags(spark, sf_dir):
    return w.table(spark, sf_dir, "pages").select("page_id", html.strip_tags(F.col("html")).alias("text"))


def _page_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _spread(w.derived(spark, sf_dir, w.marked_pages).select("page_id", "html"))
    return pages.select("page_id", html.page_parts(F.col("html")).alias("page"))


@query
def html_metadata(spark, sf_dir):
    return _page_parts(spark, sf_dir).select(
        "page_id", "page.title", "page.description", "page.og_title", "page.og_published_time", "page.time_tag",
        F.size("page.json_ld").alias("n_json_ld"), html.json_ld_date(F.col("page.json_ld")).alias("json_ld_date"),
    )


@query
def page_extract(spark, sf_dir):
    pages = verticals.extract_pages(_page_parts(spark, sf_dir), "page", _ref())
    return pages.select("page_id", "title", "text", "published_date")


@query
def evidence_snippet(spark, sf_dir):
    k = F.col("doc_id") % 3
    term = F.when(k == 0, F.lit("THE")).when(k == 1, F.lit("que")).otherwise(F.lit("zzzz"))
    return w.table(spark, sf_dir, "documents").select("doc_id", text.snippet(F.col("text"), term).alias("snippet"))


@query
def token_budget(spark, sf_dir):
    return chunking.token_budget(w.table(spark, sf_dir, "documents"), "text", ["lang", "source"])


def _paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = w.table(spark, sf_dir, "documents")
    return _spread(documents.select("doc_id", "lang", "source", F.replace("text", F.lit("\n"), F.lit("\n\n")).alias("text")))


@query
def chunk_corpus(spark, sf_dir):
    return chunking.chunk_table(_paragraphs(spark, sf_dir), "text").select("doc_id", "chunk_no", "chunk", "n_chars", "over_limit")


@query
def chunk_stats(spark, sf_dir):
    return chunking.chunk_stats(chunking.chunk_table(_paragraphs(spark, sf_dir), "text"), ["lang", "source"])


@query
def chunk_stats_strict(spark, sf_dir):
    chunks = chunking.chunk_table(_paragraphs(spark, sf_dir), "text", strict=True)
    return chunking.chunk_stats(chunks, ["lang", "source"])


@query
def payload_reduce(spark, sf_dir):
    return w.table(spark, sf_dir, "documents").select("doc_id", text.reduced(F.col("text")).alias("reduced"))


@query
def payload_fit_budget(spark, sf_dir):
    fit = w.table(spark, sf_dir, "documents").select("doc_id", chunking.fitted(F.col("text"), 1000).alias("fit"))
    length = F.length("fit.text")
    return fit.select("doc_id", length.cast("bigint").alias("final_chars"), F.col("fit.steps").alias("steps"), (length <= 1000).alias("fits"))


@query
def rule_extract(spark, sf_dir):
    documents = w.table(spark, sf_dir, "documents").select("doc_id", "text")
    return extraction.rule_extract(documents, "text", "STARTUP").drop("employee_count")


# --- Extraction tables ----------------------------------------------------------------

@query
def extraction_requests(spark, sf_dir):
    requests = extraction.requests(_paragraphs(spark, sf_dir), "text", "STARTUP", w.TASK)
    return requests.select("doc_id", "chunk_no", "prompt", "est_tokens")


@query
def extraction_responses(spark, sf_dir):
    events = w.table(spark, sf_dir, "events")
    body = F.to_json(
        F.struct(
            F.when(F.col("event_type") == "error", F.lit("OTHER")).otherwise(F.lit("STARTUP")).alias("recordType"),
            F.struct(
                F.lit("feed").alias("name"),
                F.when(F.col("event_id") % 5 != 0, F.concat(F.lit("https://x.example/"), "event_id")).alias("url"),
            ).alias("source"),
            F.struct(
                F.concat(F.lit("Org "), "user_id").alias("entityName"),
                F.struct(F.when(F.col("event_type") == "view", F.lit("many")).otherwise(F.lit("12")).alias("employeeCount")).alias("data"),
            ).alias("content"),
            F.col("props").alias("ignored"),
        )
    )
    # Every seventh answer is cut off in the middle.
    cut = F.when(F.col("event_id") % 7 == 0, F.substring(body, F.lit(1), F.length(body) - 5)).otherwise(body)
    parsed = extraction.parse_responses(events.select("event_id", cut.alias("body")), "body", "STARTUP")
    return parsed.select("event_id", F.array_join("failed", ",").alias("failed"), F.col("content.entityName").alias("entity_name"))


@query
def fallback_resolution(spark, sf_dir):
    attempts = w.derived(spark, sf_dir, w.attempts)
    return extraction.fallback_resolution(attempts, "call_id", "provider_rank", ["attempt"], "status", "body")


@query
def fallback_telemetry(spark, sf_dir):
    attempts = w.derived(spark, sf_dir, w.attempts)
    resolution = extraction.fallback_resolution(attempts, "call_id", "provider_rank", ["attempt"], "status", "body")
    return extraction.fallback_telemetry(attempts, resolution, "status", 3)


# --- Ingests -------------------------------------------------------------------------


def _startups(spark: SparkSession, sf_dir: str) -> verticals.Ingested:
    return verticals.ingest_startups(w.landed_startups(spark, sf_dir), resolve.dictionary(spark), _collected())


def _products(spark: SparkSession, sf_dir: str) -> verticals.Ingested:
    return verticals.ingest_products(w.landed_products(spark, sf_dir), resolve.dictionary(spark), _collected())


def _papers(spark: SparkSession, sf_dir: str) -> verticals.Ingested:
    stars = w.derived(spark, sf_dir, w.repo_stats)
    return verticals.ingest_papers(w.landed_papers(spark, sf_dir), stars, _collected())


def _news(spark: SparkSession, sf_dir: str) -> verticals.Ingested:
    return verticals.ingest_news(w.landed_news(spark, sf_dir), _ref(), _collected())


def _jobs(spark: SparkSession, sf_dir: str) -> verticals.Ingested:
    return verticals.ingest_jobs(w.landed_jobs(spark, sf_dir), resolve.dictionary(spark), _ref(), _collected())


VERTICALS = {"startups": _startups, "products": _products, "research_papers": _papers, "news": _news, "jobs": _jobs}


def _judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [build(spark, sf_dir).judged.select("vertical", "reason", "hash_key") for build in VERTICALS.values()]
    judged = parts[0]
    for part in parts[1:]:
        judged = judged.unionByName(part)
    return judged


@query
def ingest_startups(spark, sf_dir):
    return _startups(spark, sf_dir).rows


@query
def ingest_products(spark, sf_dir):
    return _products(spark, sf_dir).rows


@query
def ingest_papers(spark, sf_dir):
    rows = _papers(spark, sf_dir).rows
    return rows.withColumn("authors", F.to_json("authors"))


@query
def ingest_news(spark, sf_dir):
    return _news(spark, sf_dir).rows


@query
def ingest_jobs(spark, sf_dir):
    return _jobs(spark, sf_dir).rows


@query
def required_fields(spark, sf_dir):
    """Rows each ingest rejects for a missing field."""
    screened = [build(spark, sf_dir).screened.select("vertical", "reason") for build in VERTICALS.values()]
    return report.rejections(reduce(DataFrame.unionByName, screened)).where(F.col("reason").startswith("MISSING"))


@query
def relevance_filter(spark, sf_dir):
    orders, customers = w.table(spark, sf_dir, "orders"), w.table(spark, sf_dir, "customer")
    posts = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
    title = F.when(F.col("o_orderkey") % 2 == 0, F.lit("Maintenance lead")).otherwise(F.lit("Clerk"))
    tagged = posts.select("o_orderkey", title.alias("title"), F.array("c_mktsegment", "o_orderpriority").alias("tags"))
    return tagged.where(validate.topical(F.col("tags"), F.col("title"))).drop("tags")


@query
def limit_first_n(spark, sf_dir):
    """The first fifty acceptable organisations in arrival order, and what was rejected on the way."""
    landed = w.landed_startups(spark, sf_dir)
    limited = verticals.ingest_startups(landed, resolve.dictionary(spark), _collected(), limit=50)
    columns = ["reason", F.col("raw_name").alias("login"), F.col("source_url").alias("url"), F.lit(1).cast("bigint").alias("n_rows")]
    kept = limited.judged.where("reason is null").select(*columns)
    return kept.unionByName(limited.rejections.drop("vertical"), allowMissingColumns=True)


@query
def flatten_entities(spark, sf_dir):
    orders, customers = w.table(spark, sf_dir, "orders"), w.table(spark, sf_dir, "customer")
    joined = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
    nested = joined.select(
        F.concat(F.lit("job"), "o_orderkey").alias("source_url"),
        F.lit("orders").alias("source_name"),
        F.struct(
            F.col("c_name").alias("company"),
            dates.iso_utc(F.col("o_orderdate").cast("timestamp")).alias("date"),
            (F.col("o_orderkey") % 2 == 1).alias("is_remote"),
            F.lit(fixed.ROLE_FAMILY).alias("role_family"),
        ).alias("content"),
    )
    flat = verticals.flattened(nested, "JOB")
    return flat.withColumn("is_remote", F.col("is_remote").cast("int"))


@query
def schema_validate(spark, sf_dir):
    k = F.col("p_partkey")
    pricing = F.element_at(F.array(*[F.lit(p) for p in [*fixed.PRICING_MODELS, "CHEAP"]]), (k % 5 + 1).cast("int"))
    nested = w.table(spark, sf_dir, "part").select(
        "p_partkey",
        F.when(k % 11 == 0, F.lit("INVALID_TYPE")).otherwise(F.lit("PRODUCT")).alias("recordType"),
        F.struct(F.lit("list").alias("name"), F.when(k % 13 != 0, F.concat(F.lit("u"), k)).alias("url")).alias("source"),
        F.struct(F.when(k % 7 != 0, F.col("p_name")).alias("startupName"), pricing.alias("pricingModel")).alias("content"),
    )
    failed = validate.failed_rules(validate.record_rules("PRODUCT"))
    return nested.select("p_partkey", F.array_join(failed, ",").alias("failed"))


def _records(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    """Nested records of a kind over ``part``, with faults planted by its key."""
    k, name = F.col("p_partkey"), F.when(F.col("p_partkey") % 7 != 0, F.col("p_name"))
    source, url = F.when(k % 17 != 0, F.lit("list")), F.when(k % 13 != 0, F.concat(F.lit("u"), k))
    day = F.when(k % 5 != 0, F.lit("2024-01-02"))
    number = F.when(k % 6 == 0, F.lit("many")).when(k % 6 > 1, k.cast("string"))
    content = {
        "STARTUP": {"entityName": name, "data": F.struct(number.alias("employeeCount"))},
        "PRODUCT": {"startupName": name, "pricingModel": F.when(k % 5 == 0, F.lit("CHEAP")).otherwise(F.lit("FREE"))},
        "RESEARCH_PAPER": {
            "title": name, "authors": F.array("p_brand", "p_type"), "paper_url": F.concat(F.lit("p"), k),
            "github_url": url, "github_stars": number, "published_date": day,
        },
        "JOB": {
            "company": name, "date": day, "is_remote": F.when(k % 4 == 0, F.lit("maybe")).otherwise(F.lit("true")),
            "role_family": F.lit(fixed.ROLE_FAMILY),
        },
        "NEWS": {"title": name, "published_date": day, "summary": F.col("p_type")},
    }[kind]
    return w.table(spark, sf_dir, "part").select(
        "p_partkey",
        F.when(k % 11 == 0, F.lit("INVALID_TYPE")).otherwise(F.lit(kind)).alias("recordType"),
        F.struct(source.alias("name"), url.alias("url")).alias("source"),
        source.alias("source_name"),
        url.alias("source_url"),
        F.struct(*[c.alias(field) for field, c in content.items()]).alias("content"),
    )


@query
def schema_validate_kinds(spark, sf_dir):
    """The contract of every record kind."""
    parts = [
        _records(spark, sf_dir, kind).select(
            "p_partkey",
            F.lit(kind).alias("kind"),
            F.array_join(validate.failed_rules(validate.record_rules(kind)), ",").alias("failed"),
        )
        for kind in verticals.FLAT_COLUMNS
    ]
    return reduce(DataFrame.unionByName, parts)


@query
def flatten_kinds(spark, sf_dir):
    """The flat columns of every record kind, in order, as one text."""

    def flat(kind: str) -> DataFrame:
        columns = [
            F.coalesce(F.array_join(path, ",") if name == "authors" else F.col(path).cast("string"), F.lit(""))
            for name, path in verticals.FLAT_COLUMNS[kind].items()
        ]
        return _records(spark, sf_dir, kind).select("p_partkey", F.lit(kind).alias("kind"), F.concat_ws("|", *columns).alias("flat"))

    return reduce(DataFrame.unionByName, map(flat, verticals.FLAT_COLUMNS))


@query
def star_enrichment(spark, sf_dir):
    repos = w.derived(spark, sf_dir, w.repo_addresses).withColumn("full_repo", urls.repo_url(F.col("repo")))
    starred = enrich.with_stars(repos, "full_repo", "own_stars", w.derived(spark, sf_dir, w.repo_stats), ["k"])
    return starred.select("k", "stars")


# --- Reports and exports ---------------------------------------------------------------


@query
def ingest_report(spark, sf_dir):
    return report.ingest_metrics(_judged(spark, sf_dir))


@query
def ingest_report_total(spark, sf_dir):
    totals = report.with_totals(report.ingest_metrics(_judged(spark, sf_dir)), F.lit(60.0))
    return totals.withColumn("throughput", F.round("throughput", 6))


@query
def table_counts(spark, sf_dir):
    """Row counts of the output tables after one run of every ingest."""
    root = scratch_path(spark, "tables")
    for build in VERTICALS.values():
        verticals.run_vertical(build(spark, sf_dir), root)
    tables = {name: export.read_output_table(spark, root, name) for name in fixed.OUTPUT_TABLES}
    return report.table_counts({name: df for name, df in tables.items() if df is not None})


@query
def source_coverage(spark, sf_dir):
    """Items per registered source when one of them is switched off."""
    rows = [(*r[:5], r[5] and r[1] != "Engadget AI") for r in fixed.REGISTRY]
    landed = {"startups": w.landed_startups, "products": w.landed_products, "research_papers": w.landed_papers,
              "news": w.landed_news, "jobs": w.landed_jobs}
    items = [
        verticals.items_of(read(spark, sf_dir), vertical, registry.sources_of(vertical, rows)).select("source", "fault")
        for vertical, read in landed.items()
    ]
    return registry.coverage(reduce(DataFrame.unionByName, items), registry.registry(spark, rows))


@query
def export_matrix(spark, sf_dir):
    return export.text_matrix(_jobs(spark, sf_dir).rows)


@query
def export_roundtrip(spark, sf_dir):
    """A table written as CSV and read back."""
    rows = _papers(spark, sf_dir).rows
    written = export.export_csv({"research_papers": rows}, scratch_path(spark, "export"))
    back = export.read_csv_mirror(spark, written["Research Papers"], rows.columns)
    return back.select(*[F.coalesce(c, F.lit("")).alias(c) for c in back.columns])


def _vendor_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Relations are read from the written tables of the three ingests.
    startups, products, jobs = (
        verticals.staged(build(spark, sf_dir).rows, name)
        for name, build in (("startups", _startups), ("products", _products), ("jobs", _jobs))
    )
    return relations.vendor_edges(startups, products, jobs)


@query
def vendor_graph_edges(spark, sf_dir):
    return _vendor_edges(spark, sf_dir)


@query
def vendor_reach(spark, sf_dir):
    """What a vendor reaches in three steps: its products and role families, who else hires for these, and what they make."""
    edges = verticals.staged(_vendor_edges(spark, sf_dir), "vendor-edges")
    starts = edges.select(F.concat(F.lit("vendor:"), "vendor").alias("node")).distinct()
    return relations.reach(relations.both_ways(edges, ["HIRES"]), starts, 3)


@query
def region_reach(spark, sf_dir):
    """Multi-hop relation over the trade tables: from each region to its nations, suppliers and their orders' customers' nations."""
    nation, supplier, customer = (w.table(spark, sf_dir, name) for name in ("nation", "supplier", "customer"))
    orders, lineitem = (w.table(spark, sf_dir, name) for name in ("orders", "lineitem"))

    def named(kind: str, column: str) -> Column:
        return F.concat(F.lit(kind), F.col(column).cast("string"))

    steps = (
        nation.select(named("region:", "n_regionkey").alias("src"), named("nation:", "n_nationkey").alias("dst"))
        .union(supplier.select(named("nation:", "s_nationkey"), named("supplier:", "s_suppkey")))
        .union(lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(named("supplier:", "l_suppkey"), named("customer:", "o_custkey")))
        .union(customer.select(named("customer:", "c_custkey"), named("nation:", "c_nationkey")))
    )
    starts = nation.select(named("region:", "n_regionkey").alias("node"))
    return relations.reach(steps, starts, 4)


# --- Vectors -------------------------------------------------------------------------------


@query
def semantic_dedup(spark, sf_dir):
    """Groups of embeddings at the threshold of near-duplicates."""
    return semantic.semantic_groups(w.table(spark, sf_dir, "embeddings"))


@query
def semantic_topics(spark, sf_dir):
    """Groups of embeddings at a threshold that unrelated rows of the given tables meet now and then."""
    return semantic.semantic_groups(w.table(spark, sf_dir, "embeddings"), 0.42)


# --- Streams -------------------------------------------------------------------------------


def _event_stream(spark: SparkSession, sf_dir: str, replays: int) -> DataFrame:
    schema = w.table(spark, sf_dir, "events").schema
    stream = monitor.file_stream(spark, sf_dir, schema, "events.parquet")
    # A source that delivers at least once: every event arrives ``replays`` times.
    repeated = stream.withColumn("delivery", F.explode(F.sequence(F.lit(1), F.lit(replays))))
    text_key = F.concat_ws(":", "event_type", "event_id")
    return repeated.withColumn("ts", F.col("ts").cast("timestamp")).withColumn("hash_key", keys.entity_key("event", text_key))


@query
def stream_fresh_ingest(spark, sf_dir):
    fresh = monitor.fresh_stream(_event_stream(spark, sf_dir, 2), "ts", _ref(), "hash_key", ["event_id", "delivery"])
    rows = fresh.select("event_id", "hash_key", dates.iso_utc(F.col("ts")).alias("published_date"))
    target = scratch_path(spark, "fresh")
    monitor.append_new(rows, target, scratch_path(spark, "fresh-log"), "hash_key", ["event_id"]).awaitTermination()
    return spark.read.parquet(target)


@query
def stream_news_ingest(spark, sf_dir):
    """News ingest over a landed table read as a stream, several files per batch."""
    landed = scratch_path(spark, "landed-news")
    w.landed_news(spark, sf_dir).repartition(4, "source", "page").write.parquet(landed)
    stream = monitor.landed_stream(spark, landed, files_per_trigger=2)
    judged = verticals.ingest_news(stream, _ref(), _collected())
    target = scratch_path(spark, "news")
    rows = judged.judged.where("reason is null").select(*verticals.ARRIVAL, *judged.columns)
    monitor.append_new(rows, target, scratch_path(spark, "news-log"), "hash_key", verticals.ARRIVAL).awaitTermination()
    return spark.read.parquet(target).select(*judged.columns)


@query
def stream_news_quarantine(spark, sf_dir):
    """What the news stream rejects, by source and reason."""
    landed = scratch_path(spark, "landed-news")
    w.landed_news(spark, sf_dir).repartition(4, "source", "page").write.parquet(landed)
    judged = verticals.ingest_news(monitor.landed_stream(spark, landed, files_per_trigger=2), _ref(), _collected())
    target = scratch_path(spark, "news-rejected")
    rejected = judged.quarantine.select(*verticals.ARRIVAL, "reason")
    monitor.append_all(rejected, target, scratch_path(spark, "news-rejected-log")).awaitTermination()
    return spark.read.parquet(target).groupBy("source", "reason").agg(F.count(F.lit(1)).alias("n_rows"))


@query
def stream_quarantine(spark, sf_dir):
    stale = monitor.stale_stream(_event_stream(spark, sf_dir, 2), "ts", _ref()).select("event_id", "reason_code")
    target = scratch_path(spark, "stale")
    monitor.append_all(stale, target, scratch_path(spark, "stale-log")).awaitTermination()
    return spark.read.parquet(target)


@query
def stream_source_counts(spark, sf_dir):
    counts = monitor.window_counts(_event_stream(spark, sf_dir, 1), "ts", "event_type", delay="1 hour")
    target = scratch_path(spark, "counts")
    monitor.append_updates(counts, target, scratch_path(spark, "counts-log")).awaitTermination()
    latest = monitor.latest_counts(spark.read.parquet(target), "event_type")
    return latest.withColumn("window_start", dates.iso_utc(F.col("window_start")))
