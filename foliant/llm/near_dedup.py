"""Operator 9: near-duplicate groups by circulant MinHash, banding and exact verification.

Signatures need two permutations of one universe of bins: the first scatters a document's
shingles, the second, shifted circularly by k, gives coordinate k. Shifted reads of one table
are neighbouring cells, so all coordinates of a shingle are one contiguous slice.

1. Documents of equal shingle sets collapse into one class (an exact test on 64-bit shingle
   hashes), so copies are never paired.
2. Bands of coordinates put classes into buckets, which the member that meets most others
   leads. Each class is verified on full sets against its best lead (one pair a class) and
   links are joined into components; then against leads of components that are not its own.
3. Buckets that still hold several components
   are searched for links between these: blocks of members meet in one task, are compared by
   one-byte signatures, and pairs whose estimated similarity lies ``slack`` standard errors
   below the threshold or closer are verified there on full sets. Only links leave the task;
   with them the components are joined again.

So no link between documents that share a bucket is lost, though pairs inside a component
are not listed. With 32 bands of 6 coordinates a pair at the threshold of 0.85 shares no
bucket with a chance of 3e-7, more similar pairs with less.

Defined results: documents without words (null, empty or white text) have empty sets, are
linked with nothing and are components of their own; null ids count in no minimum, so a
component has a null id only if all its ids are null, and a row of null id is never kept.
Repeated rows are copies. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliant.llm.common import durable
from foliant.llm.components import components
from foliant.llm.hashing import mix, shingles


class Circulant:
    """Signatures of sets of 64-bit hashes: two permutations of 2 ** bits bins."""

    def __init__(self, coordinates: int, bits: int = 20, seed: int = 1):
        rng = np.random.default_rng(seed)
        self._mask = np.uint64((1 << bits) - 1)
        self._scatter = rng.permutation(1 << bits).astype(np.int64)
        table = rng.permutation(1 << bits).astype(np.int32)
        wrapped = np.concatenate([table, table[:coordinates]])
        self._slices = np.lib.stride_tricks.sliding_window_view(wrapped, coordinates)
        self._n = coordinates

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        at = self._scatter[(hashes & self._mask).astype(np.int64)]
        out = np.full(self._n, np.iinfo(np.int32).max, np.int32)
        for i in range(0, len(at), 1024):
            np.minimum(out, self._slices[at[i : i + 1024]].min(0), out=out)
        return out


def band_keys(signature: np.ndarray, bands: int) -> np.ndarray:
    key = np.arange(bands, dtype=np.uint64)
    for column in signature.reshape(bands, -1).T:
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + column.astype(np.uint64))
    return key.view(np.int64)


def _sign(size: int, bands: int, rows: int, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        circulant = Circulant(bands * rows)
        for batch in batches:
            for at in range(0, len(batch), 512):
                n, keys, buckets, short = [], [], [], []
                for text in batch.column(1).slice(at, 512).to_pylist():
                    s = shingles(text, size)
                    n.append(len(s))
                    keys.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                    signature = circulant(s) if len(s) else None
                    buckets.append(band_keys(signature, bands) if len(s) else [])
                    short.append(signature.astype(np.uint8).tobytes() if len(s) else b"")
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, 512).cast(pa.int64()), *(pa.array(c, t.type) for c, t in zip((n, keys, buckets, short), list(schema)[1:], strict=True))], schema=schema)

    return run


def _keyed(size: int, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 512):
                texts = batch.column(0).slice(at, 512)
                keys = [hashlib.blake2b(shingles(t, size).tobytes(), digest_size=16).digest() for t in texts.to_pylist()]
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), texts], schema=schema)

    return run


def _verify(size: int, percent: int, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, np.ndarray] = {}

        def of(node: int, text: bytes) -> np.ndarray:
            if node not in kept:
                if len(kept) >= 64:
                    kept.pop(next(iter(kept)))
                kept[node] = shingles(text, size)
            return kept[node]

        for batch in batches:
            for at in range(0, len(batch), 256):
                part, ok = batch.slice(at, 256), []
                for u, v, a, b in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    x, y = of(u, a), of(v, b)
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    ok.append(100 * both >= percent * (len(x) + len(y) - both))
                yield pa.RecordBatch.from_arrays(part.columns[:2], schema=schema).filter(pa.array(ok, pa.bool_()))

    return run


def _close(size: int, percent: int, coordinates: int, slack: float, schema: pa.Schema):
    """Links between two blocks of a bucket, of different components. A pair that shares
    several buckets is looked at in the one of its first common band."""
    p = percent / 100
    least = int(coordinates * p - slack * (coordinates * p * (1 - p)) ** 0.5)

    def run(group: pa.Table) -> pa.Table:
        side = group.column("side").to_numpy()
        node, comp, n = (group.column(c).to_numpy() for c in ("node", "component", "n"))
        sig = np.frombuffer(b"".join(group.column("short").to_pylist()), np.uint8).reshape(len(side), -1)
        bands = np.array(group.column("buckets").to_pylist(), np.int64)
        band = int(np.argmax(bands[0] == group.column("bucket")[0].as_py()))
        texts, sets = group.column("text"), {}

        def of(i: int) -> np.ndarray:
            if i not in sets:
                sets[i] = shingles(texts[i].as_py(), size)
            return sets[i]

        same = group.column("i")[0].as_py() == group.column("j")[0].as_py()
        left = np.flatnonzero(side == 0)
        right = left if same else np.flatnonzero(side == 1)
        out: list[tuple[int, int]] = []
        for a in left:
            b = right[(comp[right] != comp[a]) & (100 * np.minimum(n[right], n[a]) >= percent * np.maximum(n[right], n[a]))]
            if same:
                b = b[node[b] > node[a]]
            b = b[(sig[b] == sig[a]).sum(1) >= least]
            b = b[(bands[b] == bands[a]).argmax(1) == band]
            for c in b:
                both = len(np.intersect1d(of(a), of(c), assume_unique=True))
                if 100 * both >= percent * (n[a] + n[c] - both):
                    out.append((max(node[a], node[c]), min(node[a], node[c])))
        return pa.table([pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)], schema=schema)

    return run


def near_duplicate_groups(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = 5,
    percent: int = 85,
    bands: int = 32,
    rows: int = 6,
    slack: float = 6.0,
    block: int = 512,
    broadcast_rows: int = 500_000,
) -> DataFrame:
    """One row per document row: doc_id, n_shingles, component_id (smallest id of the
    component), kept (doc_id is that id) and component, a key that is never null.

    ``broadcast_rows``: up to so many 16-byte keys of candidates are broadcast to pick their
    texts from the scan; beyond, texts and keys meet by a shuffle.
    """
    pair = pa.schema([("u", pa.int64()), ("v", pa.int64())])
    text = F.col(text_col).cast("binary").alias("text")
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("key", pa.binary()), ("buckets", pa.list_(pa.int64())), ("short", pa.binary())])
    base = durable(
        docs.select(F.col(id_col).cast("long").alias("doc_id"), text)
        .mapInArrow(_sign(size, bands, rows, schema), "doc_id long, n long, key binary, buckets array<long>, short binary")
        .withColumn("row", F.monotonically_increasing_id())
    )
    sets = base.where("n > 0")
    classes = sets.groupBy("key").agg(F.min("row").alias("node"), F.min("doc_id").alias("id"), F.first("n").alias("n"), F.first("buckets").alias("buckets"), F.first("short").alias("short"))
    buckets = classes.select("node", F.explode("buckets").alias("bucket"))
    sizes = buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    shared = durable(buckets.join(sizes, "bucket").select("bucket", "node", "m"))
    # the member that meets most others leads a bucket: in a family of copies, its original
    degree = shared.groupBy("node").agg(F.sum("m").alias("degree"))
    leads = shared.join(degree, "node").groupBy("bucket").agg(F.max(F.struct("degree", (-F.col("node")).alias("node"))).alias("x"))
    leads = leads.select("bucket", "x.degree", (-F.col("x.node")).alias("lead"))
    crowded = durable(shared.join(leads, "bucket").select("bucket", "node", "lead", "degree"))

    some = classes.select("node", "key", "n", "short", "buckets").join(crowded.select("node").distinct(), "node")
    some = durable(some)
    wanted = some.select("key", "node")
    if some.count() <= broadcast_rows:
        wanted = F.broadcast(wanted)
    keyed = docs.select(text).mapInArrow(_keyed(size, pa.schema([("key", pa.binary()), ("text", pa.binary())])), "key binary, text binary")
    texts = durable(keyed.join(wanted, "key").groupBy("node").agg(F.first("text").alias("text")))

    def linked(pairs: DataFrame) -> DataFrame:
        """The pairs (u, v) whose full sets are similar enough."""
        of = lambda c: texts.select(F.col("node").alias(c), F.col("text").alias(f"text_{c}"))
        both = pairs.join(of("u"), "u").join(of("v"), "v").select("u", "v", "text_u", "text_v")
        return both.mapInArrow(_verify(size, percent, pair), "u long, v long")

    n_of = lambda c: some.select(F.col("node").alias(c), F.col("n").alias(f"n_{c}"))

    def similar_size(pairs: DataFrame) -> DataFrame:
        both = pairs.join(n_of("u"), "u").join(n_of("v"), "v")
        return both.where(100 * F.least("n_u", "n_v") >= percent * F.greatest("n_u", "n_v")).select("u", "v")

    # first each class against its best lead, one pair a class; then, where the two are not
    # one component yet, against the leads of its other buckets
    rays = crowded.where("node <> lead")
    best = rays.groupBy("node").agg(F.max(F.struct("degree", (-F.col("lead")).alias("lead"))).alias("x")).select(F.col("node").alias("u"), (-F.col("x.lead")).alias("v"))
    edges = durable(linked(similar_size(best)))
    labels = components(edges)
    of = lambda c: labels.select(F.col("node").alias(c), F.col("component").alias(f"c_{c}"))
    other = rays.select(F.col("node").alias("u"), F.col("lead").alias("v")).join(of("u"), "u", "left").join(of("v"), "v", "left")
    other = other.where(F.coalesce("c_u", "u") != F.coalesce("c_v", "v")).select("u", "v").distinct().join(best, ["u", "v"], "left_anti")
    edges = durable(linked(similar_size(other)))
    if not edges.isEmpty():
        labels = components(edges.unionByName(labels.select(F.col("node").alias("u"), F.col("component").alias("v"))))

    member = crowded.join(labels, "node", "left").select("bucket", "node", F.coalesce("component", "node").alias("component"))
    mixed = member.groupBy("bucket").agg(F.min("component").alias("a"), F.max("component").alias("b"), F.count(F.lit(1)).alias("m")).where("a < b")
    parts = F.ceil(F.col("m") / block).cast("int")
    open_ = member.join(mixed.select("bucket", parts.alias("parts")), "bucket").join(some.select("node", "n", "short", "buckets"), "node").join(texts, "node")
    own = open_.withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    cells = own.select("*", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other")).select(
        "bucket", "node", "component", "n", "short", "buckets", "text", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), (F.col("part") > F.col("other")).cast("int").alias("side")
    )
    more = durable(cells.groupBy("bucket", "i", "j").applyInArrow(_close(size, percent, bands * rows, slack, pair), "u long, v long").distinct())
    if not more.isEmpty():
        labels = components(more.unionByName(labels.select(F.col("node").alias("u"), F.col("component").alias("v"))))
    # a class's node, its component and the component's smallest document id
    classed = classes.select("key", "node", "id").join(labels, "node", "left").select("key", "id", F.coalesce("component", "node").alias("component"))
    smallest = classed.groupBy("component").agg(F.min("id").alias("component_id"))
    found = classed.select("key", "component").join(smallest, "component")
    placed = base.select("doc_id", "n", "key", "row").where("n > 0").join(found, "key").select("doc_id", "n", "component_id", "component")
    alone = base.where("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id"), F.col("row").alias("component"))
    return placed.unionByName(alone).select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"), "component"
    )
