"""Packing along a space-filling curve.

Each document becomes a hashed vector of its token ids, projected to a few
dimensions.  The cells of a Hilbert curve through that space order the
documents, so neighbours on the curve resemble each other.  Documents are
range-sorted by the key and laid end to end; a sequence is the next
``capacity`` ids.  What is left at the end of a range goes to sequences whose
lengths are powers of two, which need no padding.

Defined results: a null text counts as empty and still has its closing id;
repeated rows are packed as often as they occur; an empty table gives no
pieces; ties on the key are ordered by document id, nulls first, then by row.
Only ``doc_id`` and the text are read, so other columns may have any name.
"""

from __future__ import annotations

import functools
import unicodedata
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from brightweir.llm.common import in_slices, pieces_of, row_numbered, staged, whole_text

VOCABULARY = "word_bpe_49k.json"
CLOSING_ID = 2
CAPACITY = 4096
# The vector: hashed token counts; its projection; bits per projected dimension.
FEATURES = 256
DIMENSIONS = 3
BITS = 10
SEED = 20240607
# Bytes that are split into words at once, characters of a piece of a longer
# text, characters one call of the library sees, and parts of words a worker remembers.
SLICE = 4_000_000
PIECE = 1_000_000
CALL = 400_000
REMEMBERED = 800_000
# Ids that one task of the sorted layout is meant to hold.
IDS_PER_TASK = 8_000_000

# Ids in files and shuffles; the vocabulary has fewer than 65,536.
STORED = "<u2"
STORED_BYTES = 2

# ASCII punctuation; after letters it is a match of the tokenizer's pattern of its own.
_MARKS = "".join(map(chr, [*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]))


def _steady(letters: str) -> bool:
    """Whether normalising keeps the letters, and lower case looks at each by itself."""
    return letters.isascii() or (
        len(letters.lower()) == len(letters) and "\u03a3" not in letters and unicodedata.is_normalized("NFC", letters)
    )


def _one_match(part: str) -> bool:
    return part.isalpha() and (part.isascii() or unicodedata.is_normalized("NFC", part))


class WordBpe:
    """The library's tokenizer with a memory of the parts of words it has met.

    White space separates words and is dropped, so a text has the ids of its
    words.  Texts are split at ASCII white space; what other white space a word
    may hold is left to the library, and so are the vocabulary's special tokens,
    whose strings get their ids wherever they stand.  A word of letters with punctuation after
    it has the ids of both.
    """

    def __init__(self, path: str) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.parts: dict[str, bytes] = {"": b""}

    def encode(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """Ids of each text, as unsigned 16-bit integers."""
        sizes = pc.binary_length(texts).to_pylist()
        for start, stop in in_slices(sizes, sizes, SLICE):
            if sizes[start] <= SLICE:
                yield from self._encode_slice(texts.slice(start, stop - start))
            else:
                pieces = pa.array(pieces_of(texts[start].as_py(), PIECE), pa.string())
                yield np.concatenate([ids for i in range(len(pieces)) for ids in self._encode_slice(pieces.slice(i, 1))])

    def _encode_slice(self, texts: pa.Array) -> list[np.ndarray]:
        words = pc.ascii_split_whitespace(texts)
        # Each distinct word is looked up once; its ids are then laid where it stands.
        flat = words.flatten().dictionary_encode()
        spelled = self._spelled(flat.dictionary.to_pylist())
        lengths = np.fromiter(map(len, spelled), np.int64, len(spelled)) // STORED_BYTES
        begins = np.cumsum(lengths) - lengths
        index = flat.indices.to_numpy()
        sizes = lengths[index]
        ends = np.concatenate(([0], np.cumsum(sizes)))
        places = np.arange(ends[-1]) + np.repeat(begins[index] - ends[:-1], sizes)
        ids = np.frombuffer(b"".join(spelled), STORED)[places]
        offsets = words.offsets.to_numpy()
        bounds = ends[offsets - offsets[0]].tolist()
        return [ids[a:b] for a, b in zip(bounds, bounds[1:])]

    def _spelled(self, words: list[str]) -> list[bytes]:
        """Ids of distinct words."""
        cores, tails = [], []
        for word in words:
            core = word.rstrip(_MARKS)
            if core.isalpha() and _steady(core):
                cores.append(core.lower())
                tails.append(word[len(core) :])
            else:
                cores.append(word)
                tails.append("")
        self._learn_parts({*cores, *tails})
        parts = self.parts
        return [parts[core] + parts[tail] if tail else parts[core] for core, tail in zip(cores, tails)]

    def _learn_parts(self, parts: set[str]) -> None:
        fresh = parts.difference(self.parts)
        if len(self.parts) + len(fresh) > REMEMBERED:
            self.parts, fresh = {"": b""}, parts
        joined, alone = [], []
        for part in fresh:
            (joined if _one_match(part) else alone).append(part)
        for start, stop in in_slices(joined, [len(part) + 1 for part in joined], CALL):
            encoded = self.tokenizer.encode(" ".join(joined[start:stop]), add_special_tokens=False)
            numbers = np.asarray(encoded.word_ids, np.int64)
            if numbers[-1] + 1 != stop - start:  # a letter that lower case takes apart
                alone += joined[start:stop]
                continue
            ids = np.asarray(encoded.ids, STORED).tobytes()
            cuts = (np.searchsorted(numbers, np.arange(stop - start + 1)) * STORED_BYTES).tolist()
            for part, a, b in zip(joined[start:stop], cuts, cuts[1:]):
                self.parts[part] = ids[a:b]
        for part in alone:
            self.parts[part] = np.asarray(self.tokenizer.encode(part, add_special_tokens=False).ids, STORED).tobytes()


@functools.lru_cache(maxsize=2)
def loaded(path: str) -> WordBpe:
    """One tokenizer per worker process."""
    return WordBpe(path)


@functools.lru_cache(maxsize=1)
def _projection() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature and sign of each id, and the map from features to dimensions."""
    random = np.random.default_rng(SEED)
    size = 1 << 16
    return random.integers(0, FEATURES, size), random.choice([-1.0, 1.0], size), random.standard_normal((FEATURES, DIMENSIONS))


def projected(ids: np.ndarray) -> np.ndarray:
    """A document's hashed vector of unit length, in few dimensions."""
    feature, sign, to_dimensions = _projection()
    vector = np.bincount(feature[ids], weights=sign[ids], minlength=FEATURES)
    return vector @ to_dimensions / max(1.0, float(np.sqrt(vector @ vector)))


def hilbert_keys(points: np.ndarray) -> np.ndarray:
    """Place of each point on a Hilbert curve through the cells of [-4, 4) per dimension.

    The bits of the cell numbers are taken from the highest down; each step
    undoes the turn and the reflection of the sub-cube it is in, and the Gray
    code of the sub-cubes gives the next bits of the key.
    """
    cells = np.clip((points + 4.0) * (1 << BITS) / 8.0, 0, (1 << BITS) - 1).astype(np.int64).T.copy()
    for bit in (1 << b for b in range(BITS - 1, 0, -1)):
        for d in range(DIMENSIONS):
            below = bit - 1
            here = (cells[d] & bit) != 0
            swap = np.where(here, 0, (cells[0] ^ cells[d]) & below)
            cells[0] ^= np.where(here, below, swap)
            if d:
                cells[d] ^= swap
    for d in range(1, DIMENSIONS):
        cells[d] ^= cells[d - 1]
    turned = np.zeros_like(cells[0])
    for bit in (1 << b for b in range(BITS - 1, 0, -1)):
        turned ^= np.where(cells[-1] & bit, bit - 1, 0)
    cells ^= turned
    key = np.zeros_like(cells[0])
    for b in range(BITS - 1, -1, -1):
        for d in range(DIMENSIONS):
            key = (key << 1) | ((cells[d] >> b) & 1)
    return key


TOKENIZED = "row_id bigint, doc_id bigint, curve bigint, n_tokens bigint, ids binary"


def tokenized(docs: DataFrame, path: str) -> DataFrame:
    """Per document: its ids with the closing id, and its place on the curve."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = loaded(path)
        closing = np.asarray([CLOSING_ID], STORED)
        for batch in batches:
            ids = [np.append(row, closing) for row in codec.encode(batch.column("text"))]
            points = np.array([projected(row) for row in ids]).reshape(-1, DIMENSIONS)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row_id"),
                    batch.column("doc_id"),
                    pa.array(hilbert_keys(points), pa.int64()),
                    pa.array([len(row) for row in ids], pa.int64()),
                    pa.array([row.tobytes() for row in ids], pa.binary()),
                ],
                ["row_id", "doc_id", "curve", "n_tokens", "ids"],
            )

    return row_numbered(docs.select(F.col("doc_id").cast("bigint"), whole_text().alias("text"))).mapInArrow(run, TOKENIZED)


def powers_of_two(length: int) -> list[int]:
    """Powers of two that add up to a length, the largest first."""
    return [1 << b for b in range(length.bit_length() - 1, -1, -1) if length >> b & 1]


class _Sequences:
    """Lays documents end to end; yields pieces once their sequence is full."""

    def __init__(self, capacity: int, first: int) -> None:
        self.capacity, self.sequence = capacity, first
        self.open: list[tuple] = []
        self.used = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> Iterator[tuple]:
        start = 0
        while start < len(ids):
            length = min(len(ids) - start, self.capacity - self.used)
            self.open.append((doc_id, start, ids[start : start + length], len(ids)))
            self.used += length
            start += length
            if self.used == self.capacity:
                yield from self._close([self.capacity])

    def rest(self) -> Iterator[tuple]:
        """The ids left over, as sequences whose lengths are powers of two."""
        yield from self._close(powers_of_two(self.used))

    def _close(self, lengths: list[int]) -> Iterator[tuple]:
        waiting = self.open[::-1]
        for length in lengths:
            offset = 0
            while offset < length:
                doc_id, start, ids, whole = waiting.pop()
                taken = ids[: length - offset]
                if len(taken) < len(ids):
                    waiting.append((doc_id, start + len(taken), ids[len(taken) :], whole))
                yield doc_id, start, taken, whole, self.sequence, offset
                offset += len(taken)
            self.sequence += 1
        self.open, self.used = [], 0


PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"


def packed(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Pieces of documents and where they lie; ``with_ids`` adds the ids themselves.

    Each task packs a range of the curve.  What is left over at its end goes to
    sequences whose lengths are powers of two, so nothing is padded.  Sequence
    numbers are unique and rise along the curve; tasks start theirs 2^32 apart.
    """
    rows = staged(tokenized(docs, path or public_tokenizers.path(VOCABULARY)), "tokenized")
    total = rows.agg(F.sum("n_tokens")).first()[0] or 0
    order = ["curve", "doc_id", "row_id"]
    # Copies share a place on the curve; the row number keeps any range divisible.
    ranged = rows.repartitionByRange(max(1, -(-total // IDS_PER_TASK)), *order).sortWithinPartitions(*order)
    names = [column.split()[0] for column in PIECES.split(", ")]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sequences = _Sequences(capacity, TaskContext.get().partitionId() << 32)

        def batch_of(pieces: list[tuple]) -> pa.RecordBatch:
            made = [
                (d, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), whole, sequence, offset)
                for d, start, ids, whole, sequence, offset in pieces
            ]
            columns = [pa.array(values, pa.int64()) for values in zip(*made)]
            if with_ids:
                columns.append(pa.array([p[2].astype(np.int32) for p in pieces], pa.list_(pa.int32())))
            return pa.RecordBatch.from_arrays(columns, names + ["ids"] * with_ids)

        for batch in batches:
            doc_ids, stored = batch.column("doc_id").to_pylist(), batch.column("ids")
            pieces = [p for d, i in zip(doc_ids, stored) for p in sequences.add(d, np.frombuffer(i.as_py(), STORED))]
            if pieces:
                yield batch_of(pieces)
        pieces = list(sequences.rest())
        if pieces:
            yield batch_of(pieces)

    return ranged.select("doc_id", "ids").mapInArrow(run, PIECES + ", ids array<int>" * with_ids)


def sequences(pieces: DataFrame) -> DataFrame:
    """Sequences with their ids, from pieces with ids; a sequence is at most ``capacity`` ids long."""
    laid = pieces.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("laid"))
    return laid.select("sequence_id", F.flatten("laid.ids").alias("ids"))
