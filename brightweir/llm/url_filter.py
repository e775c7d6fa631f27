"""URL filter: rules first, then a ratio of two character language models.

The rules allow or block a host with its subdomains and the paths below theirs;
the longest rule that fits decides.  Where none fits, two variable-order Markov
models judge, one of accepted and one of rejected URLs: every character is
predicted from up to ``ORDER`` characters before it, each order smoothed by the
next lower one.  The difference of the log-likelihoods per character is held
against the threshold that gives even odds on URLs the models were not trained on.

The models see the whole URL.  They learn from all URLs that a rule decides, each
counted once, less a fifth that sets the threshold.  Counts are exact: a character
and the ``ORDER`` before it fit into one number, and the counts of these numbers
are a Spark table that grows with the URLs.  Shorter contexts are sums over it.
At most 256 rows of a table share a context or the next shorter gram, so each
order is joined to the one below without hot keys; then the distinct URLs are
joined with the chances of their grams, frequent grams spread.  Scores are summed
as whole numbers, so they do not depend on the order of the rows.

Defined results: a null URL, or one without ``://``, has an empty host and path
and fits no rule; the models see an empty text for null, which is judged by the
threshold alone.  Repeated rows get the same result, null ids pass through.  If no
rule accepts or none rejects, the models allow.  An empty table gives an empty
result.  Only ``page_id`` and ``url`` are read; other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from brightweir.llm.common import in_slices, row_numbered, staged
from brightweir.operators.lookup import spread_lookup

ALLOW, BLOCK = "allow", "block"

# Host and path, and the verdict.
RULES = {
    "org/": ALLOW,
    "example.org/es/": BLOCK,
    "example.org/en/1": BLOCK,
    "com/fr/": ALLOW,
    "com/de/": BLOCK,
}

# Characters before the predicted one, weight of the lower order, share of the
# URLs kept for calibration, bins and range of the scores.
ORDER = 5
PRIOR = 4.0
KEPT_BACK = 5
BINS, LOW, HIGH = 400, -4.0, 4.0
# Parts of one in which scores are summed.
UNIT = float(1 << 40)
# Characters handled at once.
PIECE = 100_000
# Slots of the tables in memory (``Model``), which the query does not use.
SLOT_BITS = 15
SLOTS = 1 << SLOT_BITS
# What stands before a text; no byte of UTF-8.
START = b"\xff"

_ODD = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xC2B2AE3D27D4EB4F)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host in lower case and path of a URL; empty where there are none."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^([^/?#]*)", 1), _UPPER, _LOWER)
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def rule_for(host: Column, path: Column, rules: dict[str, str] = RULES) -> Column:
    """The longest rule that fits, else null."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r), r)):
        of_host, slash, of_path = rule.partition("/")
        fits = ((host == of_host) | host.endswith("." + of_host)) & path.startswith(slash + of_path)
        found = F.when(fits, F.lit(rule)).otherwise(found)
    return found


def ruled(pages: DataFrame, rules: dict[str, str] = RULES) -> DataFrame:
    """Host, path, text for the models, rule and the verdict of the rule."""
    host, path = host_and_path(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"), F.coalesce("url", F.lit("")).alias("text"))
    verdicts = F.create_map(*[F.lit(x) for item in rules.items() for x in item])
    return rows.withColumn("rule", rule_for(F.col("host"), F.col("path"), rules)).withColumn("by_rule", verdicts[F.col("rule")])


@dataclass
class Contexts:
    """Where the characters of some texts, and the contexts before them, are counted."""

    owner: np.ndarray
    contexts: list[np.ndarray]
    grams: list[np.ndarray]

    @classmethod
    def of(cls, texts: list[str]) -> Contexts:
        start = b"\x00" * ORDER
        data = [start + text.encode() for text in texts]
        lengths = np.array([len(d) for d in data], np.int64)
        codes = np.frombuffer(b"".join(data), np.uint8).astype(np.uint64) + np.uint64(1)
        begins = np.cumsum(lengths) - lengths
        inside = np.arange(len(codes)) - np.repeat(begins, lengths)
        places = np.flatnonzero(inside >= ORDER)
        contexts, grams = [], []
        context = np.zeros(len(places), np.uint64)
        for order in range(ORDER + 1):
            if order:
                context = context + codes[places - order] * np.uint64(int(_STEP) ** order % (1 << 64))
            contexts.append(_slot(context))
            grams.append(_slot(context * _STEP + codes[places]))
        return cls(np.repeat(np.arange(len(texts)), lengths)[places], contexts, grams)


def _slot(mixed: np.ndarray) -> np.ndarray:
    return ((mixed ^ mixed >> np.uint64(29)) * _ODD >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


@dataclass
class Model:
    """Per class and order, how often each slot of contexts and of grams was seen.

    The chances of ``chances`` for a few texts in memory, true where no slots clash.
    """

    contexts: np.ndarray
    grams: np.ndarray

    def scores(self, texts: list[str]) -> np.ndarray:
        """Log-likelihood of accepted less that of rejected, per character."""
        total, lengths = np.zeros(len(texts)), np.zeros(len(texts))
        # A text of over PIECE characters is scored in pieces.
        owners, pieces = zip(*((i, t[a : a + PIECE]) for i, t in enumerate(texts) for a in range(0, len(t) or 1, PIECE))) if texts else ((), ())
        for start, stop in in_slices(pieces, [len(p) for p in pieces], PIECE):
            found, counted = self._sums(list(pieces[start:stop]))
            np.add.at(total, list(owners[start:stop]), found)
            np.add.at(lengths, list(owners[start:stop]), counted)
        return total / np.maximum(lengths, 1)

    def _sums(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Per text the difference of the log-likelihoods, and its bytes."""
        at = Contexts.of(texts)
        total = np.zeros(len(at.owner))
        for kind, sign in ((1, 1.0), (0, -1.0)):
            chance = np.full(len(at.owner), 1.0 / 256)
            for order in range(ORDER + 1):
                seen, with_next = self.contexts[kind, order][at.contexts[order]], self.grams[kind, order][at.grams[order]]
                chance = (with_next + PRIOR * chance) / (seen + PRIOR)
            total += sign * np.log(chance)
        return np.bincount(at.owner, weights=total, minlength=len(texts)), np.bincount(at.owner, minlength=len(texts))


def grams_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Per byte of the texts: which text has it, and it with the ``ORDER`` bytes before it as one number."""
    data = [START * ORDER + text.encode() for text in texts]
    lengths = np.array([len(d) for d in data], np.int64)
    codes = np.frombuffer(b"".join(data), np.uint8).astype(np.int64)
    inside = np.arange(len(codes)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    places = np.flatnonzero(inside >= ORDER)
    grams = np.zeros(len(places), np.int64)
    for before in range(ORDER + 1):
        grams |= codes[places - before] << 8 * before
    return np.repeat(np.arange(len(texts)), lengths)[places], grams


def _grams(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text").to_pylist()
        for start, stop in in_slices(texts, [len(t) for t in texts], PIECE):
            owner, grams = grams_of(texts[start:stop])
            for at in range(0, len(grams), PIECE):
                taken = pa.array(owner[at : at + PIECE] + start)
                columns = [batch.column("row_id").take(taken), batch.column("learned").take(taken), pa.array(grams[at : at + PIECE])]
                yield pa.RecordBatch.from_arrays(columns, ["row_id", "learned", "gram"])


def _shorter(gram: Column, order: int) -> Column:
    """The end of a gram: a character and ``order`` before it."""
    return gram.bitwiseAND(F.lit((1 << 8 * (order + 1)) - 1))


def chances(counts: DataFrame) -> DataFrame:
    """Per gram ``gram`` its chance among accepted and rejected URLs, ``good`` and ``bad``.

    ``counts`` has how often each gram was learned, ``n_good`` and ``n_bad``.
    """
    tables = [counts.select("gram", "n_good", "n_bad")]
    for order in reversed(range(ORDER)):
        shorter = tables[-1].groupBy(_shorter(F.col("gram"), order).alias("gram"))
        tables.append(staged(shorter.agg(F.sum("n_good").alias("n_good"), F.sum("n_bad").alias("n_bad")), "shorter"))
    found = None
    for order, table in enumerate(reversed(tables)):
        # A context has at most 256 rows, one per next byte.
        context = Window.partitionBy(F.shiftright("gram", 8))
        seen = table.withColumns({"seen_good": F.sum("n_good").over(context), "seen_bad": F.sum("n_bad").over(context)})
        if found is None:
            lower = seen.withColumns({"low_good": F.lit(1.0 / 256), "low_bad": F.lit(1.0 / 256)})
        else:
            below = found.select(F.col("gram").alias("end"), F.col("good").alias("low_good"), F.col("bad").alias("low_bad"))
            lower = seen.withColumn("end", _shorter(F.col("gram"), order - 1)).join(below, "end")
        made = [((F.col(f"n_{c}") + PRIOR * F.col(f"low_{c}")) / (F.col(f"seen_{c}") + PRIOR)).alias(c) for c in ("good", "bad")]
        found = staged(lower.select("gram", *made), "chances")
    return found


def scored(rows: DataFrame) -> tuple[DataFrame, float] | None:
    """Per distinct text its score and ``n_rows``, and the threshold; nothing if a class is missing.

    The score is the log-likelihood of accepted less that of rejected, per byte.
    """
    back = F.crc32(F.col("text").cast("binary")) % KEPT_BACK == 0
    texts = rows.groupBy("text").agg(F.count(F.lit(1)).alias("n_rows"), (F.min("by_rule") == ALLOW).alias("good"))
    texts = texts.withColumn("back", back & F.col("good").isNotNull())
    texts = staged(row_numbered(texts.withColumn("learned", F.when(~F.col("back"), F.col("good")))), "urls")
    grams = texts.select("row_id", "learned", "text").mapInArrow(_grams, "row_id bigint, learned boolean, gram bigint")
    counts = grams.groupBy("gram").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if("learned").alias("n_good"), F.count_if(~F.col("learned")).alias("n_bad")
    )
    counts = staged(counts, "grams")
    held = counts.agg(F.sum("n_good").alias("good"), F.sum("n_bad").alias("bad")).first()
    if not (held.good and held.bad):
        return None
    gain = F.round((F.log("good") - F.log("bad")) * UNIT).cast("bigint")
    gains = staged(chances(counts).select("gram", gain.alias("gain")).join(counts.select("gram", "n_rows"), "gram"), "gains")
    sums = spread_lookup(grams.select("row_id", "gram"), gains, "gram", ["row_id"]).groupBy("row_id")
    sums = sums.agg((F.sum("gain") / UNIT / F.count(F.lit(1))).alias("sum"))
    made = texts.join(sums, "row_id", "left").withColumn("score", F.coalesce("sum", F.lit(0.0)))
    made = staged(made.select("text", "n_rows", "good", "back", "score"), "scores")
    return made.select("text", "n_rows", "score"), _threshold(made.where("back"))


def _threshold(kept_back: DataFrame) -> float:
    width = (HIGH - LOW) / BINS
    bin_of = F.greatest(F.lit(0), F.least(F.lit(BINS - 1), F.floor((F.col("score") - LOW) / width))).cast("int")
    found = kept_back.groupBy("good", bin_of.alias("bin")).agg(F.count(F.lit(1)).alias("n")).collect()
    held = np.zeros((2, BINS))
    for row in found:
        held[int(row.good), row.bin] = row.n
    return _even_odds(held, width) if held.sum(axis=1).all() else 0.0


def _even_odds(held: np.ndarray, width: float) -> float:
    """The score at which a logistic curve through both classes, weighed alike, is one half.

    The labels are softened by one row, which keeps the curve finite where the
    classes do not overlap.
    """
    middles = LOW + width * (np.arange(BINS) + 0.5)
    rows = held.sum(axis=1, keepdims=True)
    share, soft = held / rows, 1.0 / (rows + 2.0)
    design = np.stack([middles, np.ones(BINS)], axis=1)
    weight, wanted = share.sum(axis=0), share[1] * (1.0 - soft[1]) + share[0] * soft[0]
    line = np.array([1.0, 0.0])
    for _ in range(100):
        chance = 1.0 / (1.0 + np.exp(-np.clip(design @ line, -30, 30)))
        slope = design.T @ (weight * chance - wanted)
        curve = (design * (weight * chance * (1.0 - chance))[:, None]).T @ design + 1e-6 * np.eye(2)
        step = np.clip(np.linalg.solve(curve, slope), -1.0, 1.0)
        line -= step
        if np.abs(step).max() < 1e-9:
            break
    return float(-line[1] / line[0]) if line[0] > 0 else 0.0


def filtered(pages: DataFrame, rules: dict[str, str] = RULES) -> DataFrame:
    """Per page its host and path, the rule that fits, and the verdict."""
    rows = ruled(pages, rules)
    found = scored(rows)
    if found is None:
        judged = rows.withColumn("score", F.lit(None).cast("double"))
        by_model = F.lit(ALLOW)
    else:
        scores, threshold = found
        judged = spread_lookup(rows, scores, "text", ["page_id"])
        by_model = F.when(F.col("score") >= threshold, ALLOW).otherwise(BLOCK)
    return judged.select("page_id", "host", "path", "rule", F.coalesce("by_rule", by_model).alias("verdict"), "score")
