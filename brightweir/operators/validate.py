"""Record rules: required fields, schema contracts, quarantine with reasons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from brightweir import fixed_values as fixed
from brightweir.functions.text import is_blank


def failed_rules(rules: dict[str, Column]) -> Column:
    """Names of the rules a row breaks; a rule that is null counts as broken."""
    broken = [F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items()]
    return F.array_compact(F.array(*broken))


def validate(df: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Split rows into valid ones and quarantined ones with a ``failed`` list."""
    judged = df.withColumn("failed", failed_rules(rules))
    return judged.where(F.size("failed") == 0).drop("failed"), judged.where(F.size("failed") > 0)


def required(**columns: Column) -> Column:
    """Reason code of the first required field that is missing or blank, else null."""
    missing = [F.when(is_blank(c), F.lit(f"MISSING_{name.upper()}")) for name, c in columns.items()]
    return F.coalesce(*missing) if len(missing) > 1 else missing[0]


def topical(tags: Column, title: Column) -> Column:
    """Whether a posting is on topic: plain substrings of its tags or title."""
    by_tag = F.exists(tags, lambda t: F.rlike(F.lower(t), F.lit("ai|machine learning|data")))
    return F.coalesce(by_tag, F.lit(False)) | F.coalesce(F.lower(title).contains("ai"), F.lit(False))


def _text(path: str) -> Column:
    return F.col(path).isNotNull()


# Contract of each record kind over its nested form.
def record_rules(kind: str) -> dict[str, Column]:
    """Rules of a record kind (``STARTUP``, ``PRODUCT``, ``RESEARCH_PAPER``, ``JOB``, ``NEWS``)."""
    rules = {"recordType": F.col("recordType") == kind}
    if kind in ("STARTUP", "PRODUCT", "NEWS"):
        rules |= {"source.name": _text("source.name"), "source.url": _text("source.url")}
    if kind == "STARTUP":
        rules["content.entityName"] = _text("content.entityName")
        count = F.col("content.data.employeeCount")
        rules["content.data.employeeCount"] = count.isNull() | count.try_cast("int").isNotNull()
    elif kind == "PRODUCT":
        rules["content.startupName"] = _text("content.startupName")
        rules["content.pricingModel"] = F.col("content.pricingModel").isin(fixed.PRICING_MODELS)
    elif kind == "RESEARCH_PAPER":
        for field in ("title", "paper_url", "published_date"):
            rules[f"content.{field}"] = _text(f"content.{field}")
        stars = F.col("content.github_stars")
        rules["content.github_stars"] = stars.isNull() | stars.try_cast("int").isNotNull()
    elif kind == "JOB":
        for field in ("source_url", "source_name", "content.company", "content.date"):
            rules[field] = _text(field)
        rules["content.is_remote"] = F.col("content.is_remote").try_cast("boolean").isNotNull()
    elif kind == "NEWS":
        for field in ("title", "published_date"):
            rules[f"content.{field}"] = _text(f"content.{field}")
    else:
        raise ValueError(f"unknown record kind {kind}")
    return rules
