"""Tables around an external extraction service: requests, responses, fallback.

The service itself is not called here.  A user supplies it as a vectorised
function from request text to response text; these operators build its input
and judge its output.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from brightweir import fixed_values as fixed
from brightweir.functions.text import first_line_name, token_estimate
from brightweir.operators.chunking import chunk_table
from brightweir.operators.lookup import computed_once
from brightweir.operators.validate import failed_rules, record_rules

# Nested form of a record as the service returns it; unknown fields are ignored.
RESPONSE_SCHEMAS = {
    "STARTUP": "schemaVersion string, recordType string, source struct<name:string,url:string>, "
    "content struct<entityName:string,data:struct<employeeCount:string>>, collectedAt string",
    "PRODUCT": "schemaVersion string, recordType string, source struct<name:string,url:string>, "
    "content struct<startupName:string,pricingModel:string>, collectedAt string",
    "RESEARCH_PAPER": "schemaVersion string, recordType string, content struct<title:string,"
    "authors:array<string>,paper_url:string,github_url:string,github_stars:string,published_date:string>, "
    "collectedAt string",
    "JOB": "schemaVersion string, recordType string, source_url string, source_name string, "
    "content struct<company:string,date:string,is_remote:string,role_family:string>, collectedAt string",
    "NEWS": "schemaVersion string, recordType string, source struct<name:string,url:string>, "
    "content struct<title:string,published_date:string,summary:string>, collectedAt string",
}


def request_head(kind: str, task: str) -> str:
    """What stands before the text of a request: the task and the schema of the answer."""
    return (
        f"{task} Answer with one JSON object of the schema below and nothing else; "
        f"leave a field out if the text does not state it.\nSchema of {kind}: {RESPONSE_SCHEMAS[kind]}\nText:\n"
    )


def requests(
    df: DataFrame, text: str, kind: str, task: str, max_chunk_chars: int = fixed.MAX_CHUNK_CHARS
) -> DataFrame:
    """One request for a record kind per chunk of each whole document, with its estimated tokens."""
    chunks = chunk_table(df, text, max_chunk_chars)
    prompt = F.concat(F.lit(request_head(kind, task)), F.col("chunk"))
    return chunks.withColumn("prompt", prompt).withColumn("est_tokens", token_estimate(F.col("prompt")))


def parse_responses(df: DataFrame, body: str, kind: str) -> DataFrame:
    """Typed record of each response text plus the ``failed`` rules; none means accepted.

    Text that is no JSON object fails as ``unreadable``.  Missing fields take
    their defaults.
    """
    record = F.from_json(F.col(body), RESPONSE_SCHEMAS[kind], {"mode": "PERMISSIVE"})
    readable = F.coalesce(F.rlike(F.col(body), F.lit(r"(?s)^\s*\{.*\}\s*$")), F.lit(False)) & (
        F.get_json_object(F.col(body), "$").isNotNull()
    )
    parsed = computed_once(df, _record=F.when(readable, record))
    typed = parsed.select(*df.columns, F.col("_record").isNotNull().alias("_readable"), "_record.*")
    typed = typed.withColumns(
        {
            "schemaVersion": F.coalesce("schemaVersion", F.lit(fixed.SCHEMA_VERSION)),
            "recordType": F.coalesce("recordType", F.lit(kind)),
        }
    )
    if kind == "PRODUCT":
        default = F.coalesce("content.pricingModel", F.lit(fixed.PRICING_MODELS[0]))
        typed = typed.withColumn("content", F.col("content").withField("pricingModel", default))
    if kind == "JOB":
        typed = typed.withColumn(
            "content",
            F.col("content")
            .withField("is_remote", F.coalesce("content.is_remote", F.lit("false")))
            .withField("role_family", F.coalesce("content.role_family", F.lit(fixed.ROLE_FAMILY))),
        )
    rules = failed_rules(record_rules(kind))
    failed = F.when(F.col("_readable"), rules).otherwise(F.array(F.lit("unreadable")))
    return typed.withColumn("failed", failed).drop("_readable")


def rule_extract(df: DataFrame, text: str, kind: str) -> DataFrame:
    """Record built by rule alone, for content no service could handle."""
    name = first_line_name(F.col(text))
    added = {
        "record_type": F.lit(kind),
        "source_name": F.lit(fixed.RULE_SOURCE_NAME),
        "source_url": F.lit(fixed.RULE_SOURCE_URL),
    }
    if kind == "STARTUP":
        added |= {"entity_name": name, "employee_count": F.lit(None).cast("bigint")}
    elif kind == "PRODUCT":
        added |= {"startup_name": name, "pricing_model": F.lit(fixed.PRICING_MODELS[0])}
    else:
        raise ValueError(f"no rule can build a record of kind {kind}")
    return df.withColumns(added).drop(text)


def fallback_resolution(
    attempts: DataFrame, call: str, rank: str, order: Sequence[str], status: str, result: str
) -> DataFrame:
    """Per call the result of its first successful attempt, in provider and attempt order.

    Calls without any success come out with ``offline`` true and no result.
    """
    succeeded = F.col(status) == "ok"
    place = F.when(succeeded, F.struct(rank, *order))
    return attempts.groupBy(call).agg(
        F.min_by(F.struct(rank, result), place).alias("winner"),
        F.count(F.lit(1)).alias("n_attempts"),
    ).select(
        call,
        "n_attempts",
        F.col(f"winner.{rank}").alias("provider_rank"),
        F.col(f"winner.{result}").alias("result"),
        F.col("winner").isNull().alias("offline"),
    )


def fallback_telemetry(attempts: DataFrame, resolution: DataFrame, status: str, providers: int) -> DataFrame:
    """One row of counters over all calls and attempts."""
    wins = [
        F.sum((F.coalesce("provider_rank", F.lit(-1)) == i).cast("bigint")).alias(f"provider_{i}_wins")
        for i in range(providers)
    ]
    calls = resolution.agg(
        F.count(F.lit(1)).alias("total_calls"), *wins, F.sum(F.col("offline").cast("bigint")).alias("offline_fallbacks")
    )
    states = attempts.agg(
        F.sum((F.col(status) == "rate_limited").cast("bigint")).alias("rate_limit_count"),
        F.sum((F.col(status) == "too_large").cast("bigint")).alias("payload_too_large_count"),
    )
    # Both sides are a single row of totals.
    return calls.select(
        "*",
        states.select("rate_limit_count").scalar().alias("rate_limit_count"),
        states.select("payload_too_large_count").scalar().alias("payload_too_large_count"),
    )
