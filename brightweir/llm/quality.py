"""Quality rules: exact base counts and a calibrated n-gram classifier.

The classifier is a logistic regression over hashed words, word pairs and byte
trigrams, each family as shares of the text.  It is trained on a bounded sample
of the labelled rows, its scores are turned into probabilities on the part of
the sample kept back, and texts below a fixed probability go.

Defined results: a null or empty text has no words, so it fails the base rules.
Rows are independent; repeated rows get the same result and null ids pass
through.  Without labelled rows of both kinds the classifier keeps everything.
Of several labels for one document the smallest counts.  An empty table gives
an empty result.  Only ``doc_id`` and ``text`` are read; other columns may have
any name.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from brightweir.llm.common import WHITE, staged
from brightweir.operators.lookup import small_or_shuffled

# Base rules.
SYMBOLS = "#*$%&|<>"
LEAST_WORDS = 20
WINDOW = 8
MOST_REPEATED_PERCENT = 30
# The classifier: slots per family of n-grams, labelled rows per class in the
# sample, share of them kept back, rounds of training, weight of the penalty,
# and the probability of good quality below which a text goes.
SLOT_BITS = 16
SLOTS = 1 << SLOT_BITS
FAMILIES = 3
ROWS_PER_CLASS = 1_500
KEPT_BACK = 5
ROUNDS = 60
PENALTY = 1e-6
KEEP_FROM = 0.1
# Bytes of a text that are split into words at once.
PIECE = 1 << 20

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
VERDICT = ", ".join(f"{name}:bigint" for name in COUNTS)

_WHITE = re.compile(rb"[\x20\x09-\x0D]")
_ODD = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def pieces(data: bytes) -> Iterator[bytes]:
    """A text cut at white space after every ``PIECE`` bytes."""
    position = 0
    while position < len(data):
        white = _WHITE.search(data, position + PIECE)
        stop = white.start() if white else len(data)
        yield data[position:stop]
        position = stop


def repeated_words(hashes: np.ndarray) -> int:
    """Words inside windows of ``WINDOW`` words that the text holds twice or more.

    ``hashes`` has a 64-bit hash per word.  Windows are compared by two
    polynomials of them, 128 bits together.
    """
    n = len(hashes) - WINDOW + 1
    if n < 2:
        return 0
    sums = []
    for odd in _ODD:
        total = np.zeros(n, np.uint64)
        for k in range(WINDOW):
            total = total * np.uint64(odd) + hashes[k : k + n]
        sums.append(total)
    order = np.argsort(sums[0], kind="stable")
    same = sums[0][order][1:] == sums[0][order][:-1]
    if not same.any():
        return 0
    order = np.lexsort(sums)
    same = (sums[0][order][1:] == sums[0][order][:-1]) & (sums[1][order][1:] == sums[1][order][:-1])
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    steps = np.zeros(len(hashes) + 1, np.int64)
    starts = np.flatnonzero(twice)
    np.add.at(steps, starts, 1)
    np.add.at(steps, starts + WINDOW, -1)
    return int((np.cumsum(steps) > 0).sum())


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    """The counts of ``COUNTS`` over a whole text."""
    data = text.encode()
    hashes = np.concatenate(
        [np.zeros(0, np.int64), *(np.fromiter(map(hash, words), np.int64, len(words)) for words in map(bytes.split, pieces(data)))]
    )
    lines = [line for line in text.split("\n") if line.strip(WHITE)]
    return (
        len(hashes),
        len(text) - sum(map(text.count, WHITE)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(hashes.view(np.uint64)),
    )


def _slots(mixed: np.ndarray, family: int) -> np.ndarray:
    return ((mixed * np.uint64(_ODD[0])) >> np.uint64(64 - SLOT_BITS)).astype(np.int64) + family * SLOTS


def features(text: str) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Slots of the words, word pairs and byte trigrams of a text, piece by piece."""
    for piece in pieces(text.encode()):
        words = np.fromiter(map(zlib.crc32, piece.split()), np.uint64)
        pairs = words[:-1] * np.uint64(_ODD[1]) + words[1:]
        codes = np.frombuffer(piece, np.uint8).astype(np.uint64)
        grams = codes[:-2] << np.uint64(16) | codes[1:-1] << np.uint64(8) | codes[2:]
        yield _slots(words, 0), _slots(pairs, 1), _slots(grams, 2)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Classifier:
    """Weights per slot, and the line that turns a score into log odds."""

    weights: np.ndarray
    bias: float
    slope: float
    shift: float

    def score(self, text: str) -> float:
        sums, counts = np.zeros(FAMILIES), np.zeros(FAMILIES)
        for slots in features(text):
            for family, found in enumerate(slots):
                sums[family] += self.weights[found].sum()
                counts[family] += len(found)
        return self.bias + float((sums / np.maximum(counts, 1)).sum())

    def probability(self, text: str) -> float:
        return float(_sigmoid(np.float64(self.slope * self.score(text) + self.shift)))


def _shares(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct slots of a text and their shares of their family."""
    counts: dict[int, int] = {}
    totals = [0] * FAMILIES
    for slots in features(text):
        for family, found in enumerate(slots):
            totals[family] += len(found)
            for slot, n in zip(*(x.tolist() for x in np.unique(found, return_counts=True))):
                counts[slot] = counts.get(slot, 0) + n
    slots = np.fromiter(counts, np.int32, len(counts))
    values = np.fromiter(counts.values(), np.float32, len(counts))
    return slots, values / np.asarray(totals, np.float32)[slots // SLOTS]


def fit(texts: list[str], good: np.ndarray, back: np.ndarray) -> Classifier | None:
    """Train on the rows not kept ``back`` and calibrate on the others."""
    train = ~back
    if not (train.any() and 0 < good[train].sum() < train.sum()):
        return None
    rows = [_shares(texts[i]) for i in np.flatnonzero(train)]
    owner = np.repeat(np.arange(len(rows)), [len(s) for s, _ in rows])
    slots, values = (np.concatenate(parts) for parts in zip(*rows))
    wanted = good[train].astype(np.float64)
    # Both classes weigh the same.
    weight = np.where(wanted > 0, 0.5 / wanted.sum(), 0.5 / (1 - wanted).sum())
    weights, bias = np.zeros(FAMILIES * SLOTS), 0.0
    seen = np.full(FAMILIES * SLOTS, 1e-12)
    seen_bias = 1e-12
    for _ in range(ROUNDS):
        score = bias + np.bincount(owner, weights=values * weights[slots], minlength=len(rows))
        error = (_sigmoid(score) - wanted) * weight
        slope = np.bincount(slots, weights=values * error[owner], minlength=len(weights)) + PENALTY * weights
        seen += slope * slope
        seen_bias += error.sum() ** 2
        weights -= slope / np.sqrt(seen)
        bias -= 0.1 * error.sum() / np.sqrt(seen_bias)
    made = Classifier(weights.astype(np.float32), float(bias), 1.0, 0.0)
    held = np.flatnonzero(back)
    if len(held) and 0 < good[held].sum() < len(held):
        made.slope, made.shift = _line(np.array([made.score(texts[i]) for i in held]), good[held].astype(np.float64))
    return made


def _line(scores: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the log odds by Newton's method, towards slightly softened labels."""
    n_good, n_bad = good.sum(), len(good) - good.sum()
    target = np.where(good > 0, (n_good + 1) / (n_good + 2), 1 / (n_bad + 2))
    design = np.stack([scores, np.ones_like(scores)], axis=1)
    line = np.array([1.0, 0.0])
    for _ in range(50):
        p = _sigmoid(design @ line)
        slope = design.T @ (p - target)
        curve = (design * (p * (1 - p))[:, None]).T @ design + 1e-6 * np.eye(2)
        step = np.linalg.solve(curve, slope)
        line -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return float(line[0]), float(line[1])


def train(docs: DataFrame, labels: DataFrame) -> Classifier | None:
    """A classifier from at most about ``2 * ROWS_PER_CLASS`` labelled documents.

    Which documents are drawn is decided by a hash of their id, so the sample
    spreads over the whole table; one task trains on it.
    """
    labelled = (
        labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").cast("bigint").alias("doc_id"))
        .agg((F.min("quality") > 0).alias("good"))
    )
    sizes = {row.good: row.n for row in labelled.groupBy("good").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(sizes) < 2:
        return None
    share = F.when(F.col("good"), F.lit(ROWS_PER_CLASS / sizes[True])).otherwise(F.lit(ROWS_PER_CLASS / sizes[False]))
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40))
    drawn = small_or_shuffled(staged(labelled.where(draw < share * float(1 << 40)), "drawn"))
    # One text per document, should the table repeat an id.
    sample = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").where(F.col("text").isNotNull()).join(drawn, "doc_id")
    sample = sample.groupBy("doc_id", "good").agg(F.min("text").alias("text"))

    def learn(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("doc_id")
        back = np.array([zlib.crc32(str(d).encode()) % KEPT_BACK == 0 for d in rows["doc_id"]])
        made = fit(rows["text"].tolist(), rows["good"].to_numpy(bool), back)
        if made is None:
            return pd.DataFrame({"weights": [], "bias": [], "slope": [], "shift": []})
        return pd.DataFrame({"weights": [made.weights.tobytes()], "bias": [made.bias], "slope": [made.slope], "shift": [made.shift]})

    one = sample.withColumn("whole", F.lit(True)).groupBy("whole").applyInPandas(learn, "weights binary, bias double, slope double, shift double").collect()
    return Classifier(np.frombuffer(bytes(one[0].weights), np.float32), *one[0][1:]) if one else None


def judged(docs: DataFrame, classifier: Classifier | None) -> Column:
    """Counts and probability of good quality of the ``text`` column."""
    shared = docs.sparkSession.sparkContext.broadcast(classifier)

    @F.arrow_udf(f"struct<{VERDICT}, probability:double>")
    def judge(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = shared.value
        for batch in batches:
            texts = [text or "" for text in batch.to_pylist()]
            counts = [pa.array(column, pa.int64()) for column in zip(*map(base_counts, texts))] or [pa.array([], pa.int64())] * len(COUNTS)
            chances = pa.array([1.0 if model is None else model.probability(t) for t in texts], pa.float64())
            yield pa.StructArray.from_arrays([*counts, chances], [*COUNTS, "probability"])

    return judge.asNondeterministic()(F.col("text"))


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document the base counts, whether they fail, and whether the text is kept."""
    made = docs.select("doc_id", "text").withColumn("made", judged(docs, train(docs, labels))).select("doc_id", "made.*")
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))
    return made.select(
        "doc_id", *COUNTS, failed.alias("base_failed"), (~failed & (F.col("probability") >= KEEP_FROM)).alias("kept"), "probability"
    )
