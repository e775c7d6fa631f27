"""Language identification by cross-parsing.

Labelled text of each language is held in a suffix automaton.  A text is parsed
greedily into phrases, each the longest match in the language's text; the
language that needs the fewest phrases per symbol wins.

Parsing is run for many blocks of text at once: the automaton becomes a table
of moves, where a symbol that ends a phrase moves to the state of a new phrase.
A text is parsed whole, in blocks of ``BLOCK`` symbols.  Every letter of the
learned text is a symbol of its own.  A letter that a language does not have is a
phrase there, so each table has columns for its own letters only; wide tables,
and those beyond ``DENSE_BYTES`` in all, hold the existing moves alone.

Defined results: a null text, or one without a letter, is ``und`` with score 0;
so is every text when there is nothing to learn from.  Rows whose id or label
is null are never learned from; repeated rows get the same result; an empty
table gives an empty result; ties go to the first language in alphabetical
order.  Only ``doc_id``, ``text`` and ``lang`` are read, the last two of them
for learning alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from brightweir.llm.common import in_slices, staged
from brightweir.operators.lookup import small_or_shuffled

UNDETERMINED = "und"
# The sample of labelled text: symbols per language, those of a passage, and the
# distinct texts that passages are drawn from.
SYMBOLS = 32_768
PASSAGE = 128
SAMPLE_DOCS = 256
# End of a text, what is between letters, and letters that were not learned.
PAD, GAP, OTHER = 0, 1, 2
# Columns of a table that holds all moves, and bytes of all such tables of a worker.
DENSE = 128
DENSE_BYTES = 256 << 20
# Symbols of a block, and characters handled at once.
BLOCK = 256
SLICE = 1_500_000

PREDICTION = "struct<lang_pred:string,score:double>"


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from learning; one without an id is."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def letters_of(text: str) -> np.ndarray:
    """Code points in lower case; whatever is not a letter is one 0 between letters."""
    lowered = "".join([c if c.isalpha() else " " for c in text.lower()]) if not text.isascii() else text.lower()
    points = np.frombuffer(lowered.encode("utf-32-le", "replace"), "<u4")
    if text.isascii():
        points = np.where((points >= 97) & (points <= 122), points, 0)
    else:
        points = np.where(points == 32, 0, points)
    gap = points == 0
    return points[~(gap & np.concatenate(([True], gap[:-1])))]


class SuffixAutomaton:
    """The smallest automaton of all substrings of a sequence."""

    def __init__(self, symbols: list[int]) -> None:
        self.moves: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        last = 0
        for symbol in symbols:
            last = self._extend(last, symbol)

    def _state(self, moves: dict[int, int], length: int, link: int) -> int:
        self.moves.append(moves)
        self.length.append(length)
        self.link.append(link)
        return len(self.moves) - 1

    def _extend(self, last: int, symbol: int) -> int:
        new = self._state({}, self.length[last] + 1, 0)
        state = last
        while state >= 0 and symbol not in self.moves[state]:
            self.moves[state][symbol] = new
            state = self.link[state]
        if state < 0:
            return new
        target = self.moves[state][symbol]
        if self.length[target] != self.length[state] + 1:
            copy = self._state(dict(self.moves[target]), self.length[state] + 1, self.link[target])
            self.link[target] = copy
            while state >= 0 and self.moves[state].get(symbol) == target:
                self.moves[state][symbol] = copy
                state = self.link[state]
            target = copy
        self.link[new] = target
        return new

    def parsing_table(self, width: int, dense: bool) -> Dense | Sparse:
        """Moves between row starts; a negative one begins a phrase.

        Row 0 is the state before a phrase.  A symbol that cannot go on with the
        phrase begins the next; one the language does not have is a phrase.
        """
        begin = np.full(width, -1, np.int64)  # to row 0
        for symbol, target in self.moves[0].items():
            begin[symbol] = -1 - target * width
        begin[PAD] = 0
        rows = np.repeat(np.arange(1, len(self.moves)), [len(moves) for moves in self.moves[1:]]) * width
        places = rows + np.array([symbol for moves in self.moves[1:] for symbol in moves], np.int64)
        targets = np.array([target for moves in self.moves[1:] for target in moves.values()], np.int64) * width
        if not dense:
            order = np.argsort(places)
            return Sparse(begin, places[order], targets[order])
        table = np.tile(begin.astype(np.int32), len(self.moves))
        table[places] = targets
        return Dense(table)


@dataclass
class Dense:
    """All moves, row after row."""

    table: np.ndarray

    def move(self, state: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        return self.table[state + symbols]


@dataclass
class Sparse:
    """The moves that go on with a phrase, by place, and those that begin one, by symbol."""

    begin: np.ndarray
    places: np.ndarray
    targets: np.ndarray

    def move(self, state: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        moved = self.begin[symbols]
        if len(self.places):
            wanted = state + symbols
            at = np.minimum(np.searchsorted(self.places, wanted), len(self.places) - 1)
            moved = np.where(self.places[at] == wanted, self.targets[at], moved)
        return moved


@dataclass
class Model:
    """The labelled text of each language; tables are built where they are used."""

    texts: dict[str, np.ndarray]
    _built: dict = field(default_factory=dict, repr=False)

    def __getstate__(self) -> dict:
        return {"texts": self.texts, "_built": {}}

    @property
    def languages(self) -> list[str]:
        return sorted(self.texts)

    def _build(self) -> None:
        points = np.unique(np.concatenate([np.zeros(0, np.uint32), *self.texts.values()]))
        points = points[points > 0]
        size = OTHER + 1 + len(points)
        classes = np.full(0x110000, OTHER, np.min_scalar_type(size))
        classes[points] = np.arange(OTHER + 1, size)
        classes[0] = GAP
        tables, held = [], 0
        for lang in self.languages:
            text = classes[self.texts[lang]]
            letters = np.unique(text[text > OTHER])
            width = OTHER + 1 + len(letters)
            own = np.full(size, OTHER, np.min_scalar_type(width))
            own[[PAD, GAP]] = PAD, GAP
            own[letters] = np.arange(OTHER + 1, width)
            automaton = SuffixAutomaton(own[text].tolist())
            bytes_of = 4 * width * len(automaton.moves)
            dense = width <= DENSE and held + bytes_of <= DENSE_BYTES
            held += bytes_of if dense else 0
            tables.append((own, automaton.parsing_table(width, dense)))
        self._built.update(classes=classes, tables=tables)

    def phrases(self, points: list[np.ndarray]) -> np.ndarray:
        """Phrases that each text needs in each language."""
        if not self._built:
            self._build()
        blocks = np.array([-(-len(p) // BLOCK) for p in points], np.int64)
        matrix = np.zeros((int(blocks.sum()), BLOCK), self._built["classes"].dtype)
        row = 0
        for p, n in zip(points, blocks.tolist()):
            matrix[row : row + n].reshape(-1)[: len(p)] = self._built["classes"][p]
            row += n
        columns = np.ascontiguousarray(matrix.T)
        owner = np.repeat(np.arange(len(points)), blocks)
        out = np.empty((len(points), len(self.texts)), np.int64)
        for i, (own, table) in enumerate(self._built["tables"]):
            state, begun = np.zeros(len(matrix), np.int32), np.zeros(len(matrix), np.int32)
            for column in own[columns]:
                state = table.move(state, column)
                begins = state < 0
                begun += begins
                state = np.where(begins, ~state, state)
            out[:, i] = np.bincount(owner, weights=begun, minlength=len(points))
        return out

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """Language and score: how many fewer phrases it needs than the next, as a share."""
        names, scores = [UNDETERMINED] * len(texts), [0.0] * len(texts)
        languages = self.languages
        if not languages:
            return names, scores
        for start, stop in in_slices(texts, [len(t or "") for t in texts], SLICE):
            points = [letters_of(t or "") for t in texts[start:stop]]
            needed = self.phrases(points)
            for i, (p, row) in enumerate(zip(points, needed), start):
                if len(p):
                    best = int(row.argmin())
                    rest = np.delete(row, best).min() if len(row) > 1 else len(p)
                    names[i], scores[i] = languages[best], max(0.0, 1.0 - row[best] / rest)
        return names, scores


def passages_of(text: str, digest: int) -> list[np.ndarray]:
    """Passages from all over a text, in the order of a hash, up to ``SYMBOLS`` symbols."""
    symbols = letters_of(text)
    starts = range(0, len(symbols), PASSAGE)
    order = sorted(starts, key=lambda start: xxhash.xxh64_intdigest(start.to_bytes(8, "little"), digest % (1 << 64)))
    return [symbols[start : start + PASSAGE] for start in order[: -(-SYMBOLS // PASSAGE)]]


def learn(docs: DataFrame) -> Model:
    """Learn from a bounded sample of the labelled documents that are not held out.

    Per language about ``SAMPLE_DOCS`` distinct texts are drawn by their digests;
    copies of a text count once.  Each gives passages from all over it, in turns,
    until ``SYMBOLS`` are gathered.  Every language gets as many, however many
    languages there are; the driver receives these symbols.
    """
    labelled = docs.select("lang", "text", F.xxhash64("text").alias("digest")).where(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id"))
    )
    distinct = labelled.select("lang", "digest").distinct().groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    counts = small_or_shuffled(staged(distinct, "languages"))
    # A share of the hash range that holds about SAMPLE_DOCS texts, whatever the size.
    share = F.lit(float(1 << 40)) * F.least(F.lit(1.0), F.lit(float(SAMPLE_DOCS)) / F.col("n"))
    drawn = labelled.join(counts, "lang").where(F.pmod("digest", F.lit(1 << 40)) < share)
    drawn = drawn.groupBy("lang", "digest").agg(F.min("text").alias("text"))

    def gather(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("digest")
        drawn = [passages_of(text, digest) for text, digest in zip(rows["text"], rows["digest"].tolist())]
        taken: list[np.ndarray] = []
        held = 0
        for turn in range(max(map(len, drawn))):
            for passages in drawn:
                if turn < len(passages) and held < SYMBOLS:
                    # What stands apart is not read as one.
                    taken += [passages[turn], np.zeros(1, passages[turn].dtype)]
                    held += len(passages[turn]) + 1
            if held >= SYMBOLS:
                break
        joined = np.concatenate([np.zeros(0, np.uint32), *taken])[:SYMBOLS].astype("<u4")
        return pd.DataFrame({"lang": [rows["lang"].iloc[0]], "symbols": [joined.tobytes()]})

    gathered = drawn.groupBy("lang").applyInPandas(gather, "lang string, symbols binary")
    texts = {row.lang: np.frombuffer(bytes(row.symbols), "<u4") for row in gathered.toLocalIterator()}
    return Model({lang: symbols for lang, symbols in texts.items() if len(symbols)})


def predicted(docs: DataFrame, model: Model) -> Column:
    """The prediction for the ``text`` column, which is all it looks at."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf(PREDICTION)
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            names, scores = shared.value.predict(batch.to_pylist())
            yield pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["lang_pred", "score"])

    return predict.asNondeterministic()(F.col("text"))


def identified(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """Per document: whether it was held out, its language, and the score."""
    made = docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out")).withColumn(
        "made", predicted(docs, model or learn(docs))
    )
    return made.select("doc_id", "held_out", "made.lang_pred", "made.score")


def known_language(docs: DataFrame) -> DataFrame:
    """Pipeline stage: documents with a language, in their own columns.

    Where there is nothing to learn from, all documents with a letter stay.
    """
    model = learn(docs)
    if not model.languages:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    made = docs.select(row.alias("row"), F.col("text")).withColumn("made", predicted(docs, model))
    return made.where(F.col("made.lang_pred") != UNDETERMINED).select("row.*")
