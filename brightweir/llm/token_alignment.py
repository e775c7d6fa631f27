"""Alignment of the tokens of two tokenizers over the same text.

Both tokenizers cut the same bytes.  Every token points to the token of the
other side that covers its last byte, which is the farthest-right one it
overlaps; a token that ends where one of the other side ends is the terminal
of its component.  Doubling the successors (each token takes over the successor
of its successor) until nothing changes gives every token its terminal, which
labels its group.

A text is cut before single spaces and newlines between other characters and
before marks after a letter, where both tokenizers cut as well (checked on the
second vocabulary), so it has the groups of its units one after the other, and
each distinct unit is aligned once.  Documents are taken in slices; a slice keeps its distinct pairs of ids
once, with the number of its documents that hold them.  These are summed over
the corpus, and the sums come back to the slices, not to every link.

Defined results: a text that is null or empty, or that one of the tokenizers
does not give back byte for byte, has no tokens: zeros and an empty digest.
Repeated rows count as documents of their own; null ids pass through; an empty
table gives no rows.  A text is aligned whole, whatever its length.  Only
``doc_id`` and ``text`` are read, so other columns may have any name.
"""

from __future__ import annotations

import functools
import hashlib
import os
import re
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from brightweir.llm.byte_bpe import byte_table
from brightweir.llm.common import staged

FIRST = "byte_bpe_50k.json"
SECOND = "piece_bpe_32k.model"
SPACE = "▁"
# Characters of the documents that are looked at together.
SLICE = 2_000_000
# Units and links a worker remembers before it starts afresh.
REMEMBERED = 200_000
LINKS = 2_000_000
# Marks before which a word is cut, if no piece of the second vocabulary holds a letter before them.
MARKS = ".,;:!?"
LETTER = r"[^\W\d_\u00b2\u00b3\u00b9]"
# Ids of the second tokenizer are below this; a pair is one number.
PAIR = 1 << 24

SLICES = (
    "slice bigint, doc_id array<bigint>, n_a array<bigint>, n_b array<bigint>, n_groups array<bigint>, n_links array<bigint>, "
    "groups_sha256 array<string>, bounds array<int>, pair array<int>, times array<int>, key array<bigint>, n_docs array<bigint>"
)
RESULT = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers of several ranges, one after the other."""
    before = np.cumsum(lengths) - lengths
    return np.arange(int(lengths.sum())) + np.repeat(starts - before, lengths)


def successors(a_ends: np.ndarray, b_ends: np.ndarray) -> np.ndarray:
    """Per token, those of the first side before those of the second, the farthest-right token it overlaps.

    A token of the second side that ends with one of the first points to itself.
    """
    to_b = np.searchsorted(b_ends, a_ends, "left") + len(a_ends)
    to_a = np.searchsorted(a_ends, b_ends, "left")
    terminal = a_ends[to_a] == b_ends
    return np.concatenate([to_b, np.where(terminal, np.arange(len(b_ends)) + len(a_ends), to_a)])


def jumped(successor: np.ndarray) -> np.ndarray:
    """The terminal of every token, by doubling."""
    while True:
        further = successor[successor]
        if (further == successor).all():
            return successor
        successor = further


def overlaps(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of places whose byte ranges overlap, in order."""
    starts = np.concatenate([[0], a_ends[:-1]])
    low, high = np.searchsorted(b_ends, starts, "right"), np.searchsorted(b_ends, a_ends, "left")
    return np.repeat(np.arange(len(a_ends)), high - low + 1), ranges(low, high - low + 1)


class Aligner:
    """Both tokenizers, with a memory of the units met.

    Units are numbered; what they hold lies in arrays by that number, links of
    a unit one after the other.
    """

    def __init__(self, first: str, second: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.a = Tokenizer.from_file(first)
        self.a.encode_special_tokens = True
        value = {c: b for b, c in enumerate(byte_table())}
        spelled = self.a.get_vocab(with_added_tokens=False)
        self.a_bytes = {i: bytes(value[c] for c in token) for token, i in spelled.items()}
        self.b = sentencepiece.SentencePieceProcessor(model_file=second)
        size = self.b.get_piece_size()
        pieces = [self.b.id_to_piece(i) for i in range(size)]
        self.b_bytes = [
            bytes([int(p[3:-1], 16)]) if self.b.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(pieces)
        ]
        # What the second tokenizer puts before a text that begins with a newline.
        self.newline = self.b.encode("\n")
        self.cut = self._cut([p for i, p in enumerate(pieces) if not self.b.is_byte(i)])
        self._forget()

    def _cut(self, pieces: list[str]) -> re.Pattern:
        """Where texts are cut: no piece of the second vocabulary may span such a place."""
        if len(self.newline) != 2 or any("\n" in p or SPACE in p.lstrip(SPACE) for p in pieces):
            return re.compile(r"(?!)")
        marks = [m for m in MARKS if not any(re.search(LETTER + re.escape(m), p) for p in pieces)]
        after_letter = rf"|(?<={LETTER})(?=[{re.escape(''.join(marks))}])" if marks else ""
        return re.compile(rf"(?<=\S)(?=[ \n]\S){after_letter}")

    def _forget(self) -> None:
        self.place: dict[str, int] = {}
        self.groups: list[str] = []
        # Per unit: tokens of both sides, groups, links; none of them where its bytes do not come back.
        self.counts = np.empty((4, 0), np.int64)
        self.pairs = np.empty(0, np.int64)

    def units(self, text: str) -> list[str]:
        """The text, a space before it, in units that both tokenizers cut."""
        return self.cut.split(" " + text)

    def numbered(self, units: list[str]) -> np.ndarray:
        """The numbers of units; those not met before are aligned together.

        Numbers hold until the next call.
        """
        if len(self.place) > REMEMBERED or len(self.pairs) > LINKS:
            self._forget()
        place = self.place
        fresh = [u for u in dict.fromkeys(units) if u not in place]
        place.update(zip(fresh, range(len(place), len(place) + len(fresh))))
        if fresh:
            self._align(fresh)
        return np.fromiter(map(place.__getitem__, units), np.int64, len(units))

    def _tokens(self, units: list[str]) -> list[tuple[list[int], list[int]]]:
        """Ids of both tokenizers; empty where the bytes do not come back."""
        firsts = [e.ids for e in self.a.encode_batch_fast(units, add_special_tokens=False)]
        # The second puts a space before what it is given: the one units begin with, or one
        # that goes again, with the newline that keeps it apart.
        seconds = self.b.encode([u[1:] if u[0] == " " else u if u[0] == "\n" else "\n" + u for u in units], num_threads=1)
        a_bytes, b_bytes = self.a_bytes.__getitem__, self.b_bytes.__getitem__
        out = []
        for unit, a, b in zip(units, firsts, seconds):
            if unit[0] != " ":
                b = b[1 if unit[0] == "\n" else 2 :] if b[: len(self.newline)] == self.newline else []
            whole = b"".join(map(a_bytes, a)) == unit.encode() == b"".join(map(b_bytes, b))
            out.append((a, b) if whole else ([], []))
        return out

    def _align(self, units: list[str]) -> None:
        tokens = self._tokens(units)
        bounds, ids, ends = [], [], []
        for side, spelled in ((0, self.a_bytes), (1, self.b_bytes)):
            flat = [i for t in tokens for i in t[side]]
            bounds.append(np.cumsum([0, *(len(t[side]) for t in tokens)]))
            ids.append(np.array(flat, np.int64))
            ends.append(np.cumsum([len(spelled[i]) for i in flat], dtype=np.int64))
        links = groups = np.zeros(len(units) + 1, np.int64)
        texts: list[str] = []
        if len(ids[0]):
            n = len(ids[0])
            terminal = jumped(successors(*ends))
            x, y = overlaps(*ends)
            self.pairs = np.concatenate([self.pairs, ids[0][x] * PAIR + ids[1][y]])
            # Tokens, links and groups of a unit lie one after the other.
            links = np.searchsorted(x, bounds[0])
            labels = np.unique(terminal[n:])
            groups = np.searchsorted(labels, bounds[1] + n)
            texts = _spelled(labels, terminal[:n], ids[0], terminal[n:], ids[1])
        self.groups += [";".join(texts[i:j]) for i, j in zip(groups.tolist(), groups[1:].tolist())]
        self.counts = np.concatenate([self.counts, np.stack([np.diff(b) for b in (*bounds, groups, links)])], axis=1)


def _spelled(labels: np.ndarray, a_group: np.ndarray, a_ids: np.ndarray, b_group: np.ndarray, b_ids: np.ndarray) -> list[str]:
    """The ids of each group, first side and second side."""
    sides = []
    for group, ids in ((a_group, a_ids), (b_group, b_ids)):
        names = list(map(str, ids.tolist()))
        bounds = [*np.searchsorted(group, labels).tolist(), len(group)]
        sides.append([",".join(names[i:j]) for i, j in zip(bounds, bounds[1:])])
    return [f"{a}|{b}" for a, b in zip(*sides)]


@functools.lru_cache(maxsize=2)
def loaded(first: str, second: str) -> Aligner:
    """One pair of tokenizers per worker process."""
    return Aligner(first, second)


def aligned_slice(aligner: Aligner, texts: list[str]) -> dict[str, list | np.ndarray]:
    """The columns of a slice but its number and ids."""
    units, bounds = [], [0]
    for text in texts:
        if text:
            units += aligner.units(text)
        bounds.append(len(units))
    which = aligner.numbered(units)
    doc = np.repeat(np.arange(len(texts)), np.diff(bounds))
    counts = aligner.counts
    # A document with a unit that does not come back has no tokens at all.
    good = (np.diff(bounds) > 0) & (np.bincount(doc, counts[0][which] == 0, len(texts)) == 0)
    sums = [np.where(good, np.bincount(doc, of_unit[which], len(texts)), 0).astype(np.int64) for of_unit in counts]
    groups = list(map(aligner.groups.__getitem__, which.tolist()))
    digests = [
        hashlib.sha256(";".join(groups[a:b]).encode()).hexdigest() if ok else "" for a, b, ok in zip(bounds, bounds[1:], good.tolist())
    ]

    # Units of each document, then their pairs, with how often they occur.
    names, local = np.unique(which, return_inverse=True)
    of_doc, often = np.unique((doc * len(names) + local)[good[doc]], return_counts=True)
    owner, unit = np.divmod(of_doc, max(1, len(names)))
    begins, sizes = (np.cumsum(counts[3]) - counts[3])[names], counts[3][names]
    keys, place = np.unique(aligner.pairs[ranges(begins, sizes)], return_inverse=True)
    at = ranges((np.cumsum(sizes) - sizes)[unit], sizes[unit])
    held, inverse = np.unique(np.repeat(owner, sizes[unit]) * len(keys) + place[at], return_inverse=True)
    pair = held % max(1, len(keys))
    return {
        **dict(zip(("n_a", "n_b", "n_groups", "n_links"), sums)),
        "groups_sha256": digests,
        "bounds": np.searchsorted(held, np.arange(len(texts) + 1) * len(keys)),
        "pair": pair,
        "times": np.bincount(inverse, np.repeat(often, sizes[unit]), len(held)).astype(np.int64),
        "key": keys,
        "n_docs": np.bincount(pair, minlength=len(keys)),
    }


def slices(docs: DataFrame, first: str, second: str) -> DataFrame:
    """One row per slice: what its documents have, and its distinct pairs."""

    def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = loaded(first, second)
        number = TaskContext.get().partitionId() << 33
        ids: list = []
        texts: list[str] = []
        held = 0

        def row() -> pa.RecordBatch:
            made = {"slice": [number], "doc_id": [ids]} | {k: [v] for k, v in aligned_slice(aligner, texts).items()}
            kinds = {"bounds": pa.int32(), "pair": pa.int32(), "times": pa.int32(), "groups_sha256": pa.string()}
            return pa.RecordBatch.from_pydict(
                {k: pa.array(v, pa.int64() if k == "slice" else pa.list_(kinds.get(k, pa.int64()))) for k, v in made.items()}
            )

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                ids.append(doc_id)
                texts.append(text or "")
                held += len(texts[-1])
                if held >= SLICE:
                    yield row()
                    ids, texts, held, number = [], [], 0, number + 1
        if ids:
            yield row()

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(sliced, SLICES)


def pair_counts(parts: DataFrame) -> DataFrame:
    """Per pair of ids how many documents hold it linked, and whether no pair of its first id has more."""
    counts = (
        parts.select(F.explode(F.arrays_zip("key", "n_docs")).alias("e"))
        .groupBy(F.col("e.key").alias("key"))
        .agg(F.sum("e.n_docs").alias("n"))
        .withColumn("a", F.expr(f"key div {PAIR}"))
    )
    counts = staged(counts, "pair-counts")
    # At most as many pairs share a first id as the second tokenizer has ids.
    most = counts.groupBy("a").agg(F.max("n").alias("most"))
    return counts.join(most, "a").select("key", "n", (F.col("n") == F.col("most")).alias("best"))


def _scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per document from the slices with the counts of their pairs."""
    for batch in batches:
        for i in range(len(batch)):
            held = {name: batch.column(name)[i].values for name in batch.schema.names if name != "slice"}
            found = held["found"].flatten() if held["found"] is not None else []
            n, best = np.zeros(0, np.int64), np.zeros(0, bool)
            if len(found):
                place, n, best = (c.to_numpy(zero_copy_only=False) for c in found)
                order = np.argsort(place)
                n, best = n[order], best[order]
            pair, times, bounds = (held[name].to_numpy() for name in ("pair", "times", "bounds"))

            def sums(values: np.ndarray) -> np.ndarray:
                return np.diff(np.concatenate([[0], np.cumsum(values, dtype=np.int64)])[bounds])

            yield pa.RecordBatch.from_pydict(
                {name: held[name] for name in ("doc_id", "n_a", "n_b", "n_groups", "n_links")}
                | {"n_best": sums(times * best[pair]), "count_sum": sums(times * n[pair]), "groups_sha256": held["groups_sha256"]}
            )


def aligned_documents(docs: DataFrame, first: str | None = None, second: str | None = None) -> DataFrame:
    """Per document: its tokens, groups and links, how usual the links are, and the digest of its groups."""
    parts = slices(docs, first or public_tokenizers.path(FIRST), second or public_tokenizers.path(SECOND))
    parts = staged(parts, "token-slices")
    places = parts.select("slice", F.posexplode("key").alias("place", "key"))
    # A slice holds a pair once, so no pair has more rows than there are slices.
    found = places.join(pair_counts(parts), "key").groupBy("slice").agg(F.collect_list(F.struct("place", "n", "best")).alias("found"))
    return parts.drop("key", "n_docs").join(found, "slice", "left").mapInArrow(_scored, RESULT)
