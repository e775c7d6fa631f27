"""Near-duplicates among embeddings by cross-polytope hashing.

A vector is turned by random signs and fast Hadamard transforms, three times;
its code is the axis it lies closest to, with the sign.  A bucket is a label
and a few such codes.  Each vector is put in its own bucket and in the next
likely ones (multiprobe), by how little closer it is to the axes it has than to
those it would need.  Vectors of a shared bucket are candidates, and every
candidate pair is verified by its cosine in double precision.

Three numbers follow from the data.  The codes per bucket grow with the logarithm of the
rows of the largest label, so that buckets stay small; probes double with each
code; and tables are as many as pairs right at the threshold need, drawn at
random and hashed beforehand, to miss under ``MISSED`` of them.

Equal vectors of a label are one class from the start.  A bucket of more than
``PART`` classes is dealt to parts, and each two parts meet in a group of their
own, so no task holds a bucket.  A pair counts in the smallest bucket that it
shares and nowhere else, so links are counted where they are found and never
listed; what leaves a group is a count per class and a forest of its links.

Defined results: vectors that are null, empty, zero or hold null or non-finite
entries, and those without a label, link with nothing; so do vectors of
different lengths.  Repeated rows count as vectors of their own; rows without
an id are linked and counted, but never name a component unless none of its
rows has an id.  An empty table gives no rows.  Only the named columns are
read; others may have any name.
"""

from __future__ import annotations

import functools
import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from brightweir.llm.common import staged
from brightweir.llm.components import members
from brightweir.operators.lookup import BROADCAST_ROWS, shuffle_partitions, spread_lookup

COSINE = 0.93
# Classes that a bucket may hold on average before it gets one more code.
BUCKET = 256
# Classes of a bucket that stay together, and rows a task looks at together.
PART = 512
ROWS = 8192
# Share of pairs at the threshold that may be missed, and the pairs it is measured on.
MISSED = 0.001
TRIALS = 4000
# Axes besides the closest that a code may be replaced by, and rotations.
RANKED = 8
TURNS = 3
SEED = 20240611
# Cosines this close to the threshold are summed again in one fixed order.
CLOSE = 1e-9


@dataclass(frozen=True)
class Plan:
    """How vectors of a padded length are hashed."""

    size: int
    codes: int
    probes: int
    tables: int

    @functools.cached_property
    def signs(self) -> np.ndarray:
        draws = np.random.default_rng([SEED, self.size, self.codes])
        return draws.choice([-1.0, 1.0], (self.tables, self.codes, TURNS, self.size))


def padded(size: int) -> int:
    """The next power of two."""
    return 1 << max(0, size - 1).bit_length()


def hadamard(rows: np.ndarray) -> np.ndarray:
    """The fast transform of each row, not scaled; the length is a power of two."""
    n, size = rows.shape
    half = 1
    while half < size:
        pairs = rows.reshape(n, size // (2 * half), 2, half)
        rows = np.concatenate([pairs[:, :, :1] + pairs[:, :, 1:], pairs[:, :, :1] - pairs[:, :, 1:]], axis=2).reshape(n, size)
        half *= 2
    return rows


def ranked_axes(rows: np.ndarray, signs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The closest axes of each turned row with their signs, and how far each lies behind the first."""
    for sign in signs:
        rows = hadamard(rows * sign) / math.sqrt(rows.shape[1])
    most = min(RANKED, rows.shape[1])
    sizes = np.abs(rows)
    axes = np.argsort(-sizes, axis=1, kind="stable")[:, :most]
    reach = np.take_along_axis(sizes, axes, axis=1)
    return 2 * axes + (np.take_along_axis(rows, axes, axis=1) < 0), reach[:, :1] - reach


def probed(rows: np.ndarray, plan: Plan) -> np.ndarray:
    """Codes of the likeliest buckets: row, table, probe, code."""
    if rows.shape[1] < plan.size:
        rows = np.pad(rows, ((0, 0), (0, plan.size - rows.shape[1])))
    out = []
    for table in plan.signs:
        codes, behind = np.empty((len(rows), 1, 0), np.int64), np.zeros((len(rows), 1))
        for signs in table:
            axes, gaps = ranked_axes(rows, signs)
            # Every bucket so far with every replacement of the next code; the best are kept.
            sums = (behind[:, :, None] + gaps[:, None, :]).reshape(len(rows), -1)
            best = np.argsort(sums, axis=1, kind="stable")[:, : plan.probes]
            behind = np.take_along_axis(sums, best, axis=1)
            before = np.take_along_axis(codes, (best // axes.shape[1])[:, :, None], axis=1)
            codes = np.concatenate([before, np.take_along_axis(axes, best % axes.shape[1], axis=1)[:, :, None]], axis=2)
        out.append(codes)
    return np.stack(out, axis=1)


@functools.lru_cache(maxsize=64)
def plan_for(size: int, rows: int, cosine: float) -> Plan:
    """Codes from the rows of a label, tables from pairs at the threshold."""
    if size == 1:
        return Plan(size, 1, 1, 1)
    codes = 1
    while rows * 2 ** (codes + 1) > BUCKET * (2 * size) ** codes:
        codes += 1
    probes = min(2 ** (codes + 1), min(RANKED, size) ** codes)
    draws = np.random.default_rng(SEED)
    first, second = draws.normal(size=(2, TRIALS, size))
    first /= np.linalg.norm(first, axis=1, keepdims=True)
    second -= (first * second).sum(axis=1, keepdims=True) * first
    second *= math.sqrt(1 - cosine**2) / np.linalg.norm(second, axis=1, keepdims=True)
    one = Plan(size, codes, probes, 1)
    a, b = (probed(rows, one)[:, 0] for rows in (first, cosine * first + second))
    met = (a[:, :, None] == b[:, None, :]).all(axis=3).any(axis=(1, 2)).mean()
    missed = max(1 - met, 1 / TRIALS)
    return Plan(size, codes, probes, max(1, math.ceil(math.log(MISSED) / math.log(missed))))


def _matrix(values: pa.Array) -> np.ndarray:
    """A binary column of doubles, all of one length, as a matrix of unit rows."""
    held = values.to_pylist()
    rows = np.frombuffer(b"".join(held), "<f8").reshape(len(held), -1)
    return unit(rows)


def unit(rows: np.ndarray) -> np.ndarray:
    # The largest entry comes off first, so that no square leaves the doubles.
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def _addressed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors as bytes with the digest of label and vector; both null where nothing can link."""
    for batch in batches:
        digests, stored = [], []
        for label, vector in zip(batch.column("label").to_pylist(), batch.column("embedding").to_pylist()):
            digest = packed = None
            if label is not None and vector and None not in vector:
                values = np.asarray(vector, "<f8") + 0.0
                if np.isfinite(values).all() and values.any():
                    packed = values.tobytes()
                    digest = hashlib.blake2b(packed, digest_size=16, person=hashlib.md5(repr(label).encode()).digest()).digest()
            digests.append(digest)
            stored.append(packed)
        yield pa.RecordBatch.from_arrays(
            [batch.column("vec_id"), batch.column("label"), pa.array(digests, pa.binary()), pa.array(stored, pa.binary())],
            ["vec_id", "label", "digest", "vector"],
        )


def classes_of(rows: DataFrame) -> DataFrame:
    """One row per distinct label and vector: ``node``, its smallest id and how many rows it has."""
    some = rows.where("digest is not null").groupBy("digest").agg(
        F.min("vec_id").alias("low"), F.count(F.lit(1)).alias("n_rows"), F.first("label").alias("label"), F.first("vector").alias("vector")
    )
    return staged(some.withColumn("node", F.monotonically_increasing_id()), "embedding-classes")


def _keys(labels: list, vectors: list[bytes], plans: dict[int, Plan]) -> tuple[list[int], list[np.ndarray]]:
    """What a class may be compared within, and its buckets, as 64-bit keys."""
    out: list[np.ndarray] = [np.empty(0)] * len(vectors)
    scopes = [xxhash.xxh64_intdigest(f"{len(v)}:{label!r}") - 2**63 for label, v in zip(labels, vectors)]
    sizes = np.array([len(v) // 8 for v in vectors])
    for size in np.unique(sizes).tolist():
        at = np.flatnonzero(sizes == size)
        rows = unit(np.frombuffer(b"".join(vectors[i] for i in at), "<f8").reshape(len(at), size))
        codes = probed(rows, plans[padded(size)]).astype("<i4")
        for i, tables in zip(at.tolist(), codes):
            seed = scopes[i] + 2**63
            keys = {xxhash.xxh64_intdigest(bucket.tobytes(), seed ^ t) for t, table in enumerate(tables) for bucket in table}
            out[i] = np.fromiter(keys, np.uint64, len(keys)).view(np.int64)
    return scopes, out


def buckets(classes: DataFrame, plans: dict[int, Plan], whole: bool) -> DataFrame:
    """A row per class and bucket; with all buckets and the vector, or only for counting."""
    schema = "key bigint, node bigint" + (", scope bigint, n_rows bigint, keys array<bigint>, vector binary" if whole else "")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scopes, keys = _keys(batch.column("label").to_pylist(), batch.column("vector").to_pylist(), plans)
            each = pa.array(np.repeat(np.arange(len(keys)), [len(k) for k in keys]))
            columns = {"key": pa.array(np.concatenate(keys)) if keys else pa.array([], pa.int64()), "node": batch.column("node").take(each)}
            if whole:
                columns["scope"] = pa.array(scopes, pa.int64()).take(each)
                columns["n_rows"] = batch.column("n_rows").take(each)
                columns["keys"] = pa.array(keys, pa.list_(pa.int64())).take(each)
                columns["vector"] = batch.column("vector").take(each)
            yield pa.RecordBatch.from_pydict(columns)

    return classes.select("node", "n_rows", "label", "vector").mapInArrow(hashed, schema)


# What tells groups apart, and the order within them.
GROUP = ("key", "scope", "a", "b")


def dealt(classes: DataFrame, plans: dict[int, Plan]) -> DataFrame:
    """Buckets cut to groups: (key, scope, a, b) holds the parts a and b of a bucket."""
    entries = buckets(classes, plans, True)
    sizes = buckets(classes, plans, False).groupBy("key").agg(F.count(F.lit(1)).alias("n_rows"))
    large = staged(sizes.where(F.col("n_rows") > PART).withColumn("parts", F.ceil(F.col("n_rows") / PART).cast("int")), "large-buckets")
    if large.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        joined = entries.join(F.broadcast(large.drop("n_rows")), "key", "left")
    else:
        joined = spread_lookup(entries, large, "key", ["node"])
    parts = F.coalesce("parts", F.lit(1))
    return (
        joined.withColumn("part", F.pmod(F.xxhash64("node"), parts).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
        .withColumns({"a": F.least("part", "other"), "b": F.greatest("part", "other")})
        .select(*GROUP, "part", "node", "n_rows", "keys", "vector")
    )


def links_within(rows: np.ndarray, first: int, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a group at the threshold or above; ``first`` rows are part a, pairs join both parts.

    With ``first`` zero all rows are of one part, and all pairs count.
    """
    if first:
        sums = rows[:first] @ rows[first:].T
        i, j = np.nonzero(sums >= cosine - CLOSE)
        found = sums[i, j]
        j = j + first
    else:
        sums = rows @ rows.T
        i, j = np.nonzero(np.triu(sums >= cosine - CLOSE, 1))
        found = sums[i, j]
    unsure = np.flatnonzero(np.abs(found - cosine) < CLOSE)
    found[unsure] = [math.fsum(rows[a] * rows[b]) for a, b in zip(i[unsure], j[unsure])]
    sure = found >= cosine
    return i[sure], j[sure]


def forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Per row the smallest row that the pairs connect it to."""
    roots = np.arange(n)
    while True:
        low = np.minimum(roots[i], roots[j])
        before = roots.copy()
        np.minimum.at(roots, roots[i], low)
        np.minimum.at(roots, roots[j], low)
        roots = roots[roots]
        if (roots == before).all():
            return roots


def counted_here(key: int, keys: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Which pairs share no smaller bucket than this one."""
    most = max(map(len, keys))
    held = np.full((len(keys), most), np.iinfo(np.int64).max)
    for row, own in zip(held, keys):
        row[: len(own)] = own
    smaller = held < key
    out = np.empty(len(i), bool)
    for a in range(0, len(i), 4096):
        x, y = i[a : a + 4096], j[a : a + 4096]
        shared = (held[x][:, :, None] == held[y][:, None, :]) & smaller[x][:, :, None]
        out[a : a + 4096] = ~shared.any(axis=(1, 2))
    return out


def _linked(cosine: float):
    """Count and connect the links of whole groups, a few thousand rows at a time."""

    def found(held: pa.Table, bounds: np.ndarray) -> Iterator[pa.RecordBatch]:
        node, weight = held["node"].to_numpy(), held["n_rows"].to_numpy()
        a, b, part, key = (held[c].to_numpy() for c in ("a", "b", "part", "key"))
        keys, vectors = held["keys"].combine_chunks(), held["vector"].combine_chunks()
        nodes, others, counts = [], [], []
        for start, stop in zip(bounds.tolist(), bounds[1:].tolist()):
            n = stop - start
            first = int((part[start:stop] == a[start]).sum()) if a[start] < b[start] else 0
            if n < 2 or first == n or (a[start] < b[start] and first == 0):
                continue
            i, j = links_within(_matrix(vectors.slice(start, n)), first, cosine)
            if not len(i):
                continue
            nodes_here = node[start:stop]
            roots = forest(n, i, j)
            tied = np.flatnonzero(roots != np.arange(n))
            own = keys.slice(start, n)
            flat, at = own.flatten().to_numpy(), own.offsets.to_numpy()
            once = counted_here(int(key[start]), np.split(flat, (at - at[0])[1:-1]), i, j)
            i, j = i[once], j[once]
            sums = np.bincount(i, weight[start:stop][j], n) + np.bincount(j, weight[start:stop][i], n)
            some = np.flatnonzero(sums)
            nodes += [nodes_here[tied], nodes_here[some]]
            others += [nodes_here[roots[tied]], np.full(len(some), -1)]
            counts += [np.zeros(len(tied), np.int64), sums[some].astype(np.int64)]
        if nodes:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (nodes, others, counts)], ["node", "other", "n"])

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        n = 0
        for batch in batches:
            waiting.append(batch)
            n += len(batch)
            if n >= ROWS:
                held = pa.Table.from_batches(waiting)
                bounds = starts(held)
                yield from found(held, bounds)  # all but the last group, which may go on
                rest = held.slice(bounds[-1]).combine_chunks()
                waiting, n = rest.to_batches(), len(rest)
        if n:
            held = pa.Table.from_batches(waiting)
            yield from found(held, np.append(starts(held), len(held)))

    return linked


def starts(held: pa.Table) -> np.ndarray:
    """Where the groups of a sorted table begin."""
    columns = [held[c].to_numpy() for c in GROUP]
    new = np.any([c[1:] != c[:-1] for c in columns], axis=0)
    return np.concatenate(([0], np.flatnonzero(new) + 1))


def near_duplicates(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """Per vector: how many others it links with, and its component.

    ``vectors`` has ``vec_id``, ``label`` and ``embedding``.
    """
    kinds = {name: vectors.schema[name].dataType.simpleString() for name in ("vec_id", "label")}
    schema = f"vec_id {kinds['vec_id']}, label {kinds['label']}, digest binary, vector binary"
    rows = staged(vectors.select("vec_id", "label", "embedding").mapInArrow(_addressed, schema), "embedding-rows")
    classes = classes_of(rows)
    counts = classes.groupBy("label", (F.octet_length("vector") / 8).cast("int").alias("size")).count()
    most: dict[int, int] = {}
    for size, n in counts.groupBy("size").agg(F.max("count")).collect():
        most[padded(size)] = max(n, most.get(padded(size), 0))
    plans = {size: plan_for(size, 1 << max(0, n - 1).bit_length(), cosine) for size, n in most.items()}

    groups = dealt(classes, plans)
    groups = groups.repartition(shuffle_partitions(groups), *GROUP).sortWithinPartitions(*GROUP, "part", "node")
    found = staged(groups.mapInArrow(_linked(cosine), "node bigint, other bigint, n bigint"), "embedding-links")

    direct = found.where("n > 0").groupBy("node").agg(F.sum("n").alias("n"))
    roots = staged(members(found.where("other >= 0").select(F.col("node").alias("a"), F.col("other").alias("b"))), "embedding-roots")
    lows = (
        roots.join(classes.select(F.col("node").alias("member"), "low"), "member")
        .groupBy("root")
        .agg(F.min("low").alias("component_id"), F.count(F.lit(1)).alias("n_rows"))
    )
    own = spread_lookup(roots, staged(lows, "embedding-components"), "root", ["member"]).select(F.col("member").alias("node"), "component_id")
    per_class = (
        classes.join(direct, "node", "left")
        .join(own, "node", "left")
        .select("digest", "n_rows", (F.col("n_rows") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), F.coalesce("component_id", "low").alias("component_id"))
    )
    joined = spread_lookup(rows.select("vec_id", "digest"), staged(per_class, "embedding-per-class"), "digest", ["vec_id"])
    component = F.when(F.col("digest").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return joined.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept")
    )
