"""Secret scans over an incremental ledger of blobs.

Every version of every path is content-addressed: its blob is the SHA-256 of the
whole text.  The ledger in the shared folder knows which blob was scanned with
which version of the rules, so a scan reads only the unseen pairs, one text per
blob; the findings are kept per blob and joined back to all paths that hold it.
Everything is DataFrame functions.

Matches are leftmost and do not overlap within a rule.  Positions are code
points, the end exclusive.  A rule may ask for a longer match after matching;
shorter ones are dropped, yet still take their characters.

Defined results: a null or empty text is the empty blob without findings;
repeated rows each get their blob's findings; a null id is a path like any
other; an empty table gives an empty result.  Only ``doc_id`` and ``text`` are
read, so other columns may have any name.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from brightweir.llm.common import empty, row_numbered, staged, whole_text
from brightweir.operators.dedup import read_table
from brightweir.operators.lookup import computed_once, spread_lookup
from brightweir.session import scratch_path


@dataclass(frozen=True)
class Rule:
    """A kind of secret.  ``least`` is the least length of the group named."""

    kind: str
    version: str
    pattern: str
    group: int = 0
    least: int = 0
    base: bool = False


# Fixed values.  A run of hex digits or of capitals and digits is matched only
# where it is long enough, which leaves the same matches as dropping short ones:
# they end where the run ends.
RULES = (
    Rule(
        "assign",
        "base-1",
        r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=2,
        least=12,
        base=True,
    ),
    Rule("access", "base-1", r"AKIA[A-Z0-9]{14,}", base=True),
    Rule("hex", "base-1", r"[0-9a-f]{16,}", base=True),
    Rule("github", "extra-1", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", "extra-1", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", "extra-1", r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    Rule("pem", "extra-1", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)

FINDING = "blob string, version string, kind string, rank int, start int, end int"
SCANNED = "blob string, version string"


def blob_of(text: Column) -> Column:
    """The address of a text: SHA-256 of its bytes."""
    return F.sha2(text.cast("binary"), 256)


def _scan(texts: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """Findings in the texts of blobs: blob, todo (versions to scan), text."""
    per_rule = []
    for rank, rule in enumerate(rules):
        pattern = F.lit(rule.pattern)
        wanted = F.array_contains("todo", rule.version) & F.col("text").rlike(rule.pattern)
        # The text between matches gives their places; where there is none, nothing is built.
        per_rule.append(
            F.when(
                wanted,
                F.struct(
                    F.lit(rule.kind).alias("kind"),
                    F.lit(rule.version).alias("version"),
                    F.lit(rank).alias("rank"),
                    F.split("text", rule.pattern, -1).alias("gaps"),
                    F.regexp_extract_all("text", pattern, F.lit(0)).alias("whole"),
                    F.regexp_extract_all("text", pattern, F.lit(rule.group)).alias("part"),
                    F.lit(rule.least).alias("least"),
                ),
            )
        )
    hits = texts.select("blob", F.explode(F.array_compact(F.array(*per_rule))).alias("hit"))
    # A row that occurs twice is scanned twice; each time is counted by itself.
    hits = hits.withColumn("time", F.monotonically_increasing_id())
    lengths = F.arrays_zip(
        F.transform("hit.gaps", lambda x: F.length(x)).alias("gap"),
        F.transform("hit.whole", lambda x: F.length(x)).alias("size"),
        F.transform("hit.part", lambda x: F.length(x)).alias("part"),
    )
    each = hits.select("blob", "time", "hit.kind", "hit.version", "hit.rank", "hit.least", F.posexplode(lengths).alias("n", "at"))
    each = each.where("at.size is not null")
    so_far = Window.partitionBy("blob", "rank", "time").orderBy("n")
    end = F.sum(F.col("at.gap") + F.col("at.size")).over(so_far)
    placed = each.select("blob", "version", "kind", "rank", (end - F.col("at.size")).cast("int").alias("start"), end.cast("int").alias("end"), "at.part", "least")
    return placed.where("part >= least").drop("part", "least")


class BlobLedger:
    """Scanned pairs and findings, as two tables below a folder."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    def _table(self, name: str, schema: str) -> DataFrame:
        held = read_table(self.spark, f"{self.path}/{name}")
        return held if held is not None else empty(self.spark, schema)

    def findings(self) -> DataFrame:
        return self._table("findings", FINDING)

    def scan(self, versions: DataFrame, blobs: DataFrame, rules: tuple[Rule, ...] = RULES) -> None:
        """Scan the unseen pairs of blob and rule version.

        ``versions`` has the key (path and blob) and text; ``blobs`` the keys.
        The findings are written before the pairs are marked, and readers take
        distinct findings, so a scan that is cut short is repeated without harm.
        """
        names = sorted({rule.version for rule in rules})
        one_each = blobs.groupBy("key.blob").agg(F.min("key").alias("key"))
        pairs = one_each.select("key", "blob", F.explode(F.array(*map(F.lit, names))).alias("version"))
        unseen = pairs.join(self._table("scanned", SCANNED), ["blob", "version"], "left_anti")
        todo = staged(unseen.groupBy("key", "blob").agg(F.collect_set("version").alias("todo")), "unseen")
        texts = versions.join(todo, "key").select("blob", "todo", "text")
        _scan(texts, rules).write.mode("append").parquet(f"{self.path}/findings")
        todo.select("blob", F.explode("todo").alias("version")).write.mode("append").parquet(f"{self.path}/scanned")


def _keyed(docs: DataFrame) -> DataFrame:
    """Rows with their key, the path and the blob of a version."""
    path, text = F.col("doc_id").cast("bigint").alias("path"), whole_text()
    return docs.select(F.struct(path, blob_of(text).alias("blob")).alias("key"), text.alias("text"))


def _found(docs: DataFrame, paths: DataFrame, ledger: str | None, rules: tuple[Rule, ...]) -> DataFrame:
    """Scan, and give the blobs with findings, sorted by start and rule, with the number of their rows."""
    held = BlobLedger(docs.sparkSession, ledger or scratch_path(docs.sparkSession, "ledger"))
    held.scan(_keyed(docs), paths, rules)
    spans = F.sort_array(F.collect_set(F.struct("start", "rank", "kind", "end")))
    per_blob = held.findings().groupBy("blob").agg(spans.alias("spans"))
    counted = paths.groupBy("key.blob").agg(F.count(F.lit(1)).alias("n_rows"))
    return staged(per_blob.join(counted, "blob"), "found")


def findings_by_path(docs: DataFrame, ledger: str | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Every row with its blob and the findings in it.

    ``ledger`` names the folder of a ledger to go on with; without it a new one
    is begun in the shared folder.
    """
    paths = staged(row_numbered(_keyed(docs).select("key")), "paths")
    rows = paths.select("row_id", F.col("key.path").alias("doc_id"), "key.blob")
    return spread_lookup(rows, _found(docs, paths, ledger, rules), "blob", ["row_id"])


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def secrets(docs: DataFrame, ledger: str | None = None) -> DataFrame:
    """Per document the number of base findings, their digest, and all spans."""
    base = [rule.kind for rule in RULES if rule.base]
    found = findings_by_path(docs, ledger)

    def of(*kinds: str) -> Column:
        return F.filter("spans", lambda s: s["kind"].isin(*kinds))

    counts = [F.coalesce(F.size(of(kind)), F.lit(0)).cast("bigint").alias(f"n_{kind}") for kind in base]
    listed = [F.when(F.col("spans").isNull(), F.lit("")).otherwise(_listed(spans)) for spans in (of(*base), F.col("spans"))]
    return found.select("doc_id", *counts, F.sha2(listed[0].cast("binary"), 256).alias("base_sha256"), listed[1].alias("spans"))


MASK = "<secret>"


def _masked(text: Column, spans: Column) -> Column:
    """The text with every stretch covered by spans replaced by the mask."""
    first = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<a:int,b:int>>").alias("kept"))

    def step(done: Column, span: Column) -> Column:
        # The stretch between what is covered so far and this span is kept.
        gap = F.array(F.struct(done["at"].alias("a"), span["start"].alias("b")))
        new = (span["start"] > done["at"]) | ((span["start"] == 0) & (F.size(done["kept"]) == 0))
        return F.struct(
            F.greatest(done["at"], span["end"]).alias("at"),
            F.when(new, F.concat(done["kept"], gap)).otherwise(done["kept"]).alias("kept"),
        )

    walked = F.aggregate(spans, first, step)
    pieces = F.transform(walked["kept"], lambda s: F.substring(text, s["a"] + 1, s["b"] - s["a"]))
    rest = F.substring(text, walked["at"] + 1, F.length(text))
    return F.array_join(F.concat(pieces, F.array(rest)), MASK)


def redacted(docs: DataFrame) -> DataFrame:
    """Pipeline stage: the documents in their own columns, secrets masked in the text.

    ``n_chars``, if there is such a column, follows a text that changes.
    """
    paths = staged(_keyed(docs).select("key"), "paths")
    with_findings = paths.join(_found(docs, paths, None, RULES), F.col("key.blob") == F.col("blob")).select("key", "spans")
    marks = staged(with_findings.groupBy("key").agg(F.first("spans").alias("spans")), "marks")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    key = F.struct(F.col("doc_id").cast("bigint").alias("path"), blob_of(whole_text()).alias("blob")).alias("key")
    joined = docs.select(row, key).join(marks, "key", "left")
    joined = computed_once(joined, masked=F.when(F.col("spans").isNotNull(), _masked(F.col("row.text"), F.col("spans"))))
    changed = {"text": F.col("masked"), "n_chars": F.length("masked")}

    def kept(column: str) -> Column:
        own = F.col(f"row.`{column}`")
        if column not in changed:
            return own.alias(column)
        new = changed[column].cast(docs.schema[column].dataType)
        return F.when(F.col("spans").isNull(), own).otherwise(new).alias(column)

    return joined.select(*map(kept, docs.columns))
