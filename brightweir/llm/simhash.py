"""Near-duplicates by SimHash and a Gray-order hierarchical index.

A fingerprint has 64 bits, one per majority vote of the hashes of a text's word
shingles.  Fingerprints that differ in at most ``DISTANCE`` bits are linked.

The index has two parts.  Its upper levels are Spark's: the bits are cut into
``DISTANCE + 1`` blocks, and a node is a masked pattern, the value of one block.
Two linked fingerprints agree in at least one block, so they meet in a node.
A node with more than ``CAPACITY`` members is cut again by the bits it has left;
the same reasoning holds there, so no link is lost.  Below, each task sorts the
members of a node by Gray rank and builds a tree over them.  A tree node keeps
the bits its members share and those in which they vary.  Two tree nodes are
passed over when the shared bits alone differ too often, linked as a whole when
all their bits together differ no more than allowed, and opened otherwise.

A task gives a spanning forest, not pairs, and equal fingerprints are one
member, so a large group of copies costs its distinct fingerprints.  A node at
the last level shares at least 30 bits, and its members are distinct.

Defined results: a null or empty text, or one without a word, has fingerprint
0, which is linked like any other.  A text of fewer than four words is one
shingle.  Repeated rows have equal fingerprints.  A null id counts as larger
than any other: it names a component only if all its ids are null.  An empty
table gives an empty result.  Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import LongType

from brightweir.llm.common import row_numbered, staged
from brightweir.llm.components import members
from brightweir.operators.lookup import spread_lookup

WORDS = 4
SEED = 42
BITS = 64
DISTANCE = 4
# Members of a node before it is cut again, and how often that is done.
CAPACITY = 8_192
LEVELS = 3
# Children of a tree node, pairs looked at at once, and rows searched at once.
FAN = 16
PAIRS = 1_000_000
ROWS = 200_000
# Bytes of a text that are split into words at once.
PIECE = 1 << 20

_WHITE = re.compile(rb"[\x20\x09-\x0D]")


def shingle_hashes(text: bytes) -> Iterator[np.ndarray]:
    """XXH64 of each shingle of a text, piece by piece."""
    data, position, held, any_shingle = text.lower(), 0, [], False
    while position < len(data):
        white = _WHITE.search(data, position + PIECE)
        stop = white.start() if white else len(data)
        words = held + data[position:stop].split()
        position = stop
        held = words
        if len(words) >= WORDS:
            joined = b" ".join(words)
            lengths = np.fromiter(map(len, words), np.int64, len(words))
            ends = np.cumsum(lengths + 1) - 1
            begins = (ends - lengths)[: 1 - WORDS].tolist()
            hashes = [xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in zip(begins, ends[WORDS - 1 :].tolist())]
            yield np.array(hashes, np.uint64)
            any_shingle, held = True, words[1 - WORDS :]
    if held and not any_shingle:
        yield np.array([xxhash.xxh64_intdigest(b" ".join(held), SEED)], np.uint64)


def fingerprint(text: bytes | None) -> int:
    """The fingerprint of a text in UTF-8, as an unsigned number."""
    votes, total = np.zeros(BITS, np.int64), 0
    for hashes in shingle_hashes(text or b""):
        for start in range(0, len(hashes), 1 << 15):
            part = hashes[start : start + (1 << 15)]
            bits = np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            votes += bits.sum(axis=0, dtype=np.int64)
            total += len(part)
    return int(np.packbits(votes * 2 > total, bitorder="little").view("<u8")[0]) if total else 0


@F.arrow_udf(LongType())
def _fingerprints(values: pa.Array) -> pa.Array:
    found = np.array([fingerprint(text) for text in values.to_pylist()], np.uint64)
    return pa.array(found.view(np.int64), pa.int64())


def fingerprint_of(text: Column) -> Column:
    """The fingerprint of a text column, as a signed long."""
    return _fingerprints.asNondeterministic()(text.cast("binary"))


def _signed(bits: int) -> int:
    return bits - (1 << 64) if bits >> 63 else bits


def _blocks(mask: int) -> list[int]:
    """The bits outside a mask in ``DISTANCE + 1`` blocks of nearly equal size, each joined to the mask."""
    free = [b for b in range(BITS) if not mask >> b & 1]
    return [mask | sum(1 << b for b in part.tolist()) for part in np.array_split(np.array(free), DISTANCE + 1)]


def _placed(members: DataFrame, masks: list[int]) -> DataFrame:
    """The nodes below those of the given masks, for fingerprints ``fp`` that lie in them."""
    def long(bits: int) -> Column:
        return F.lit(_signed(bits)).cast("bigint")

    below = F.create_map(*[c for m in masks for c in (long(m), F.array(*map(long, _blocks(m))))])
    opened = members.select("fp", F.explode(below[F.col("mask")]).alias("mask"))
    return opened.select("mask", F.col("fp").bitwiseAND(F.col("mask")).alias("value"), "fp")


def nodes(fingerprints: DataFrame) -> DataFrame:
    """Distinct fingerprints ``fp`` in the nodes where those to be linked meet."""
    masks = [0]
    rest = fingerprints.withColumn("mask", F.lit(0).cast("bigint"))
    done: list[DataFrame] = []
    for level in range(LEVELS):
        placed = staged(_placed(rest, masks), "nodes")
        masks = [b for m in masks for b in _blocks(m)]
        large = placed.groupBy("mask", "value").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > CAPACITY).select("mask", "value")
        if level == LEVELS - 1 or large.isEmpty():
            done.append(placed)
            break
        large = staged(large, "large")
        done.append(placed.join(large, ["mask", "value"], "left_anti"))
        rest = placed.join(large, ["mask", "value"], "left_semi").select("fp", "mask")
    whole = done[0]
    for part in done[1:]:
        whole = whole.unionByName(part)
    return whole


def gray_rank(fp: Column) -> Column:
    """Place of a fingerprint in the Gray code, ordered as a signed long."""
    for shift in (1, 2, 4, 8, 16, 32):
        fp = fp.bitwiseXOR(F.shiftrightunsigned(fp, shift))
    return fp.bitwiseXOR(F.lit(-(1 << 63)))


class Forest:
    """Disjoint sets over the numbers below ``size``."""

    def __init__(self, size: int) -> None:
        self.parent = np.arange(size)

    def roots(self, items: np.ndarray) -> np.ndarray:
        found = self.parent[items]
        while True:
            above = self.parent[found]
            if (above == found).all():
                self.parent[items] = found
                return found
            found = above

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            a, b = self.roots(a), self.roots(b)
            apart = a != b
            a, b = a[apart], b[apart]
            np.minimum.at(self.parent, np.maximum(a, b), np.minimum(a, b))


class GrayTree:
    """Trees over groups of fingerprints, each group sorted by Gray rank.

    ``levels[0]`` are the fingerprints; a node above covers up to ``FAN``
    neighbours of its group.  Per node: the bits that all members have, those
    in which they vary, and the range of members and of nodes below.
    """

    def __init__(self, fps: np.ndarray, groups: np.ndarray) -> None:
        every = np.arange(len(fps))
        self.levels = [{"common": fps, "varying": np.zeros_like(fps), "first": every, "stop": every + 1}]
        heads = np.flatnonzero(np.concatenate(([True], groups[1:] != groups[:-1])))
        while len(groups) > len(heads):
            below = self.levels[-1]
            inside = np.arange(len(groups)) - np.repeat(heads, np.diff(np.append(heads, len(groups))))
            starts = np.flatnonzero(inside % FAN == 0)
            stops = np.append(starts[1:], len(groups))
            all_have = np.bitwise_and.reduceat(below["common"], starts)
            any_has = np.bitwise_or.reduceat(below["common"] | below["varying"], starts)
            level = {"common": all_have, "varying": all_have ^ any_has, "from": starts, "to": stops}
            self.levels.append(level | {"first": below["first"][starts], "stop": below["stop"][stops - 1]})
            groups = groups[starts]
            heads = np.flatnonzero(np.concatenate(([True], groups[1:] != groups[:-1])))

    def linked(self) -> np.ndarray:
        """Per fingerprint, the first one of its group that it is connected to within the group."""
        forest = Forest(len(self.levels[0]["first"]))
        roots = np.arange(len(self.levels[-1]["first"]))
        waiting = [(len(self.levels) - 1, roots, roots)]
        while waiting:
            depth, a, b = waiting.pop()
            level = self.levels[depth]
            apart = level["common"][a] ^ level["common"][b]
            varying = level["varying"][a] | level["varying"][b]
            a, b, apart, varying = (x[np.bitwise_count(apart & ~varying) <= DISTANCE] for x in (a, b, apart, varying))
            near = np.bitwise_count(apart | varying) <= DISTANCE
            forest.join(level["first"][a[near]], level["first"][b[near]])
            if not depth:
                continue
            same = a[near & (a == b)]
            inner = level["stop"][same] - level["first"][same]
            forest.join(np.repeat(level["first"][same], inner), _ranges(level["first"][same], inner))
            waiting += [(depth - 1, x, y) for x, y in _opened(level, a[~near], b[~near])]
        return forest.roots(np.arange(len(forest.parent)))


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers of several ranges, one after the other."""
    before = np.cumsum(lengths) - lengths
    return np.arange(int(lengths.sum())) + np.repeat(starts - before, lengths)


def _opened(level: dict, a: np.ndarray, b: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of the nodes below pairs of nodes, each once, about ``PAIRS`` at a time."""
    step = max(1, PAIRS // (FAN * FAN))
    for start in range(0, len(a), step):
        x, y = a[start : start + step], b[start : start + step]
        wide_x, wide_y = level["to"][x] - level["from"][x], level["to"][y] - level["from"][y]
        inside = _ranges(np.zeros(len(x), np.int64), wide_x * wide_y)
        pair = np.repeat(np.arange(len(x)), wide_x * wide_y)
        left, right = level["from"][x][pair] + inside // wide_y[pair], level["from"][y][pair] + inside % wide_y[pair]
        once = (x != y)[pair] | (left <= right)
        yield left[once], right[once]


def links(placed: DataFrame) -> DataFrame:
    """Links ``a``, ``b`` that connect the fingerprints of each node as far as they are near."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        count, wanted = 0, ROWS
        for batch in batches:
            held.append(np.stack([batch.column(c).to_numpy() for c in ("mask", "value", "fp")]))
            count += batch.num_rows
            if count < wanted:
                continue
            rows = np.concatenate(held, axis=1)
            # The last node may go on in the next batch.
            changes = np.flatnonzero((rows[:2, 1:] != rows[:2, :-1]).any(axis=0))
            cut = int(changes[-1]) + 1 if len(changes) else 0
            held, count = [rows[:, cut:]], rows.shape[1] - cut
            wanted = max(ROWS, 2 * count)
            yield from _found(rows[:, :cut])
        if held:
            yield from _found(np.concatenate(held, axis=1))

    sorted_nodes = placed.repartition("mask", "value").sortWithinPartitions("mask", "value", gray_rank(F.col("fp")))
    return sorted_nodes.select("mask", "value", "fp").mapInArrow(run, "a bigint, b bigint")


def _found(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
    if not rows.shape[1]:
        return
    changes = (rows[:2, 1:] != rows[:2, :-1]).any(axis=0)
    root = GrayTree(rows[2].view(np.uint64), np.concatenate(([0], np.cumsum(changes)))).linked()
    moved = root != np.arange(len(root))
    yield pa.RecordBatch.from_arrays([pa.array(rows[2][moved]), pa.array(rows[2][root[moved]])], ["a", "b"])


def _grouped(rows: DataFrame) -> DataFrame:
    """Fingerprints that several rows or near ones share, with the first row of their component.

    ``rows`` has row_id, doc_id and fp, and is written down.
    """
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row_id")).alias("first")
    groups = staged(rows.groupBy("fp").agg(F.count(F.lit(1)).alias("n_rows"), first), "fingerprints")
    found = staged(members(links(nodes(groups.select("fp")))), "members").withColumnRenamed("member", "fp")
    named = found.join(groups.select("fp", "first"), "fp").groupBy("root").agg(F.min("first").alias("best"))
    named = found.join(named, "root").select("fp", "best")
    joined = groups.join(named, "fp", "left").where("n_rows > 1 or best is not null")
    return staged(joined.select("fp", "n_rows", F.coalesce("best", "first").alias("best")), "near")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Per document its fingerprint and the smallest id among the documents it is connected to."""
    rows = staged(row_numbered(docs.select(F.col("doc_id").cast("bigint"), fingerprint_of(F.col("text")).alias("fp"))), "hashed")
    found = spread_lookup(rows, _grouped(rows), "fp", ["row_id"])
    component = F.when(F.col("best").isNull(), F.col("doc_id")).otherwise(F.col("best.doc_id"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), component.alias("component_id"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """Pipeline stage: the first row of each component, in its own columns."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    keyed = docs.select(row, F.col("doc_id").cast("bigint").alias("doc_id"), fingerprint_of(F.col("text")).alias("fp"))
    keyed = staged(row_numbered(keyed), "hashed")
    rows = keyed.select("row_id", "doc_id", "fp")
    found = spread_lookup(rows, _grouped(rows), "fp", ["row_id"])
    dropped = found.where("best is not null and best.row_id <> row_id").select("row_id")
    return keyed.join(dropped, "row_id", "left_anti").select("row.*")
