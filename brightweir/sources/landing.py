"""Reading landed payloads: one row per fetched page, then one row per item.

A landed table has ``source`` (registry name of the feed or board), ``page``
(number of the fetch within its source) and ``payload`` (the JSON or XML text).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from brightweir.sources.registry import DISABLED_SOURCE, Source

UNREADABLE = "UNREADABLE_PAYLOAD"
UNKNOWN_SOURCE = "UNKNOWN_SOURCE"
BAD_TYPE = "BAD_TYPE_"

# Raw columns of each vertical, the same for all layouts that feed it.
RAW_COLUMNS = {
    "startups": "login:string,url:string",
    "products": "model_id:string",
    "papers": "is_empty:boolean,paper_id:string,title:string,authors:array<string>,published_text:string,"
    "repo:string,own_stars:int",
    "news": "title:string,url:string,published_text:string,body:string",
    "jobs": "company:string,url:string,published_text:string,is_remote:boolean,is_topical:boolean,"
    "company_optional:boolean",
}


@dataclass(frozen=True)
class SourceSpec:
    """How the items of one payload layout become raw columns of a vertical.

    Adding a board or feed layout means adding one spec.  Typed fields are read
    as text and cast in ``fields``; ``bad_type`` names one that does not fit.
    """

    vertical: str
    format: str  # "json" or "xml"
    schema: str  # schema of one payload
    items: str  # path of the item array inside the payload; "" if it is the payload
    fields: Callable[[Column], dict[str, Column]]  # item -> raw columns of the vertical
    skip: int = 0  # leading items that are no records
    prepare: Callable[[Column], Column] | None = None  # item -> item that ``fields`` gets, read once per item


def read_landed(spark: SparkSession, path: str, source: str) -> DataFrame:
    """Landed files of one source, one page per file.

    The page is the last number in the file name, 0 without one; the files of a
    source must differ in it.
    """
    files = spark.read.option("wholetext", True).option("recursiveFileLookup", True).text(path)
    number = F.regexp_extract(F.col("_metadata.file_name"), r"([0-9]+)[^0-9]*$", 1)
    return files.select(
        F.lit(source).alias("source"),
        F.coalesce(number.try_cast("bigint"), F.lit(0).cast("bigint")).alias("page"),
        F.col("value").alias("payload"),
    )


def _raw_items(spec: SourceSpec) -> Column:
    read = F.from_json if spec.format == "json" else F.from_xml
    parsed = read("payload", spec.schema, {"mode": "PERMISSIVE"})
    items = reduce(lambda c, field: c[field], spec.items.split("."), parsed) if spec.items else parsed
    if spec.skip:
        items = F.filter(items, lambda _, i: i >= spec.skip)

    if spec.prepare:
        items = F.transform(items, spec.prepare)

    def raw(item: Column) -> Column:
        fields = spec.fields(item)
        bad_type = fields.pop("bad_type", F.lit(None))
        return F.struct(*[c.alias(name) for name, c in fields.items()], bad_type.alias("bad_type"))

    return F.transform(items, raw).cast(_raw_type(spec.vertical))


def _raw_type(vertical: str) -> str:
    return f"array<struct<{RAW_COLUMNS[vertical]},bad_type:string>>"


def parse_items(landed: DataFrame, layouts: dict[str, SourceSpec], sources: Sequence[Source]) -> DataFrame:
    """One row per item: ``source_rank, source, page, pos, recorded, fault`` and the raw columns of the vertical.

    ``layouts`` has the specs of one vertical, ``sources`` what may be read, in
    the order of arrival.  All layouts are read in one pass over the landed
    table.  Nothing vanishes: a page that cannot be read, and one of a source
    that is not listed, yields one row with its ``fault``; the items of a source
    that is switched off have theirs.
    """
    items = ranks = recorded = None
    for layout in dict.fromkeys(source.layout for source in sources):
        mine = F.col("source").isin([source.name for source in sources if source.layout == layout])
        raw = _raw_items(layouts[layout])
        items = F.when(mine, raw) if items is None else items.when(mine, raw)
    for rank, source in enumerate(sources):
        mine = F.col("source") == source.name
        ranks = (F if ranks is None else ranks).when(mine, F.lit(rank))
        recorded = (F if recorded is None else recorded).when(mine, F.lit(source.recorded))
    exploded = landed.select(
        F.coalesce(ranks, F.lit(len(sources))).alias("source_rank"),
        "source",
        "page",
        recorded.alias("recorded"),
        F.posexplode_outer(F.coalesce(items, _nothing(layouts))).alias("pos", "item"),
    )
    off = [source.name for source in sources if not source.enabled]
    fault = F.coalesce(
        F.when(F.col("recorded").isNull(), F.lit(UNKNOWN_SOURCE)),
        F.when(F.col("source").isin(off), F.lit(DISABLED_SOURCE)) if off else F.lit(None),
        F.when(F.col("item").isNull(), F.lit(UNREADABLE)),
        F.concat(F.lit(BAD_TYPE), F.upper("item.bad_type")),
    )
    return exploded.where("pos is not null").select(
        "source_rank", "source", "page", "pos", "recorded", fault.alias("fault"), "item.*"
    ).drop("bad_type")


def _nothing(layouts: dict[str, SourceSpec]) -> Column:
    # A list of one null item: stands for a page that cannot be read.
    vertical = next(iter(layouts.values())).vertical
    return F.array(F.lit(None)).cast(_raw_type(vertical))
