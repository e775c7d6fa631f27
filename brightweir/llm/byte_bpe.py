"""Byte-level BPE: encoding, offsets and decoding with the tokenizers library.

The tokenizer is put together from a rank file: bytes become characters by the
byte table, and every pair of tokens whose bytes join to a token may merge, in
the order of the ranks.  Decoding takes the characters of each id from the
tokenizer and reverses the byte table; a character may be split over tokens, so
only whole runs of ids are turned back into text.  The offsets of a token are the
characters from that of its first byte to that of its last, both included.

Defined results: a null text counts as empty, an empty text has no ids.  Rows
are independent, so repeated rows and null ids pass through.  Texts of any
length are cut where the pattern always starts a new match, which changes no
id.  Only the named columns are read; others may have any name.
"""

from __future__ import annotations

import base64
import functools
import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from tokenizers import Regex, Tokenizer, models, pre_tokenizers

from brightweir.llm.common import in_slices, pieces_of

RANKS = "byte_bpe_multi_50k.tiktoken"
IDS = "<u4"
ID_BYTES = 4
# Characters that one call of the library sees, which bounds its memory.
SLICE = 400_000
PIECE = 200_000
# Distinct units a worker remembers before it starts afresh.
REMEMBERED = 300_000

DIGESTS = "struct<n_tokens:bigint,ids_sha256:string,decoded_sha256:string,offsets_sha256:string>"


def byte_table() -> list[str]:
    """The character of each byte: itself if printable, else the next free one from U+0100."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and their ids."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def build_tokenizer(ranks: dict[bytes, int], pattern: str) -> Tokenizer:
    """The library's tokenizer that gives the ids of the ranks."""
    table = byte_table()
    spelled = {token: "".join(table[b] for b in token) for token in ranks}
    merges = [
        (spelled[token[:cut]], spelled[token[cut:]])
        for token in sorted(ranks, key=ranks.__getitem__)
        for cut in range(1, len(token))
        if token[:cut] in spelled and token[cut:] in spelled
    ]
    vocabulary = {spelled[token]: rank for token, rank in ranks.items()}
    tokenizer = Tokenizer(models.BPE(vocabulary, merges, ignore_merges=True))
    tokenizer.pre_tokenizer = pre_tokenizers.Sequence(
        [
            pre_tokenizers.Split(Regex(pattern), "isolated"),
            pre_tokenizers.ByteLevel(add_prefix_space=False, trim_offsets=False, use_regex=False),
        ]
    )
    return tokenizer


class ByteBpe:
    """Encodes and decodes; remembers the ids of words it has met."""

    def __init__(self, path: str, pattern: str = public_tokenizers.PATTERN) -> None:
        ranks = read_ranks(path)
        self.tokenizer = build_tokenizer(ranks, pattern)
        byte_of = {character: b for b, character in enumerate(byte_table())}
        # Every id of the tokenizer, its characters turned back to bytes.
        self.bytes_of = {i: bytes(map(byte_of.__getitem__, spelled)) for spelled, i in self.tokenizer.get_vocab().items()}
        self.lengths = np.zeros(max(self.bytes_of, default=0) + 1, np.int64)
        self.lengths[list(self.bytes_of)] = [len(token) for token in self.bytes_of.values()]
        # Ids of " word" under "word" and of "\nword" under "\nword"; None
        # where the unit holds other white space and cannot stand alone.
        self.known: dict[str, bytes | None] = {}

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """Ids of each text, as little-endian unsigned 32-bit integers."""
        for start, stop in in_slices(texts, [len(t) for t in texts], SLICE):
            if stop - start == 1 and len(texts[start]) > PIECE:
                pieces = pieces_of(texts[start], PIECE)
                yield b"".join(ids for piece in pieces for ids in self._encode_slice([piece]))
            else:
                yield from self._encode_slice(texts[start:stop])

    def _encode_slice(self, texts: list[str]) -> list[bytes]:
        # Each unit is a word after one space, or a newline and the word after it.
        units = [("\n" + text).replace("\n", " \n").split(" ")[1:] for text in texts]
        self._learn({unit for row in units for unit in row})
        known = self.known
        out = []
        for text, row in zip(texts, units):
            try:
                out.append(b"".join(map(known.__getitem__, row))[ID_BYTES:])  # without the newline put first
            except TypeError:  # a unit that cannot stand alone
                out.append(np.asarray(self.tokenizer.encode(text).ids, IDS).tobytes())
        return out

    def _learn(self, units: set[str]) -> None:
        fresh = units.difference(self.known)
        if len(self.known) + len(fresh) > REMEMBERED:
            self.known = {}
            fresh = units
        alone = []
        for unit in fresh:
            word = unit[1:] if unit[:1] == "\n" else unit
            if word.split() == [word]:
                alone.append(unit)
            else:
                self.known[unit] = None
        spelled = [unit if unit[0] == "\n" else " " + unit for unit in alone]
        for start, stop in in_slices(spelled, [len(s) for s in spelled], SLICE):
            encoded = self.tokenizer.encode("".join(spelled[start:stop]))
            begins = np.cumsum([0, *map(len, spelled[start:stop])])
            first = np.fromiter((a for a, _ in encoded.offsets), np.int64, len(encoded))
            ids = np.asarray(encoded.ids, IDS).tobytes()
            cuts = (np.searchsorted(first, begins) * ID_BYTES).tolist()
            for unit, a, b in zip(alone[start:stop], cuts, cuts[1:]):
                self.known[unit] = ids[a:b]

    def encode_with_offsets(self, text: str) -> list[tuple[int, int, int]]:
        """Id, start and end of each token, in characters of the text.

        A character that is split over tokens lies in the span of each of them.
        """
        encoded = self.tokenizer.encode(text)
        return [(i, a, b) for i, (a, b) in zip(encoded.ids, encoded.offsets)]

    def decode_bytes(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def offsets(self, ids: np.ndarray, decoded: bytes) -> np.ndarray:
        """Start and end of each of a run of ids, in characters of the text that they decode to."""
        # A character begins at every byte that does not continue one.
        character = np.cumsum(np.frombuffer(decoded, np.uint8) & 0xC0 != 0x80, dtype=np.int32)
        ends = np.cumsum(self.lengths[ids])
        return np.stack([character[ends - self.lengths[ids]] - 1, character[ends - 1]], axis=1)

    def decode(self, ids: Iterable[int]) -> str:
        """The text of a run of ids; bytes that form no character become U+FFFD."""
        return self.decode_bytes(ids).decode("utf-8", "replace")


@functools.lru_cache(maxsize=2)
def loaded(path: str) -> ByteBpe:
    """One codec per worker process."""
    return ByteBpe(path)


def texts_of(values: pa.Array) -> list[str]:
    return [text or "" for text in values.to_pylist()]


def token_ids(text: Column, path: str) -> Column:
    """The ids of a text."""

    @F.arrow_udf("array<int>")
    def encode(values: pa.Array) -> pa.Array:
        codec = loaded(path)
        return pa.array((np.frombuffer(ids, IDS).astype(np.int32) for ids in codec.encode(texts_of(values))), pa.list_(pa.int32()))

    return encode(text)


def token_offsets(text: Column, path: str) -> Column:
    """The ids of a text with the characters each of them covers."""
    kind = pa.list_(pa.struct([("id", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]))

    @F.arrow_udf("array<struct<id:int,start:int,end:int>>")
    def encode(values: pa.Array) -> pa.Array:
        codec = loaded(path)
        rows = ([{"id": i, "start": a, "end": b} for i, a, b in codec.encode_with_offsets(t)] for t in texts_of(values))
        return pa.array(rows, kind)

    return encode(text)


def decoded_text(ids: Column, path: str) -> Column:
    """The text of an array of ids, null as empty."""

    @F.arrow_udf("string")
    def decode(values: pa.Array) -> pa.Array:
        codec = loaded(path)
        return pa.array((codec.decode(row or ()) for row in values.to_pylist()), pa.string())

    return decode(ids)


def round_trip_digests(text: Column, path: str) -> Column:
    """Count and digest of the ids of a text, and digests of what they decode to and of their offsets.

    The last is over the start and end of each token, as little-endian unsigned 32-bit integers.
    """

    @F.arrow_udf(DIGESTS)
    def round_trip(values: pa.Array) -> pa.Array:
        codec = loaded(path)
        counts, digests = [], ([], [], [])
        for ids in codec.encode(texts_of(values)):
            counts.append(len(ids) // ID_BYTES)
            numbers = np.frombuffer(ids, IDS)
            decoded = codec.decode_bytes(numbers.tolist())
            for column, data in zip(digests, (ids, decoded, codec.offsets(numbers, decoded).astype(IDS).tobytes())):
                column.append(hashlib.sha256(data).hexdigest())
        columns = [pa.array(counts, pa.int64()), *(pa.array(column, pa.string()) for column in digests)]
        return pa.StructArray.from_arrays(columns, ["n_tokens", "ids_sha256", "decoded_sha256", "offsets_sha256"])

    return round_trip(text)


def encoded_documents(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Per document: number of ids, digests of the ids, of the decoded bytes and of the offsets."""
    made = docs.select("doc_id", round_trip_digests(F.col("text"), path or public_tokenizers.path(RANKS)).alias("made"))
    return made.select("doc_id", "made.*")
