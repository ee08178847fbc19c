"""Operator 13: components of all links between similar shingle sets, found without loss.

1. Documents of equal sets are one class. A class has a bitmap, the parity of its hashes by
   their low bits, as wide as its size band asks for. Two bitmaps differ in at most as many bits
   as the sets in elements, so counting bits bounds the overlap from above.
2. Sets of a size band (sizes of one bit length; larger sets that may still be similar visit the
   band below) are dealt into the same number of bins by the high bits of their hashes. Similar
   sets differ in at most k elements, so in at most k bins; of the bins of each, ordered by size
   and hash and empty ones last, the first k + 1 must share one that is equal as a whole. These
   equal bins are the buckets, so no similar pair is in none.
3. Each class is compared with the smallest class of its buckets: by bitmaps, then what is left
   by intersecting the sorted sets, the fullest shared bucket first and others only between
   components that are not joined yet.
4. Buckets that still hold several components are cut into tiles: blocks of one fine size band
   against blocks of the same or the next (others can't be similar). Tiles compare bitmaps and
   keep the members that have a partner in another component; only their texts are fetched, and
   the sets are intersected in the same tiles. A tile's links join its components at once, so
   copies of copies are not compared pair by pair.

A part that is shared by chance or by a common passage only costs comparisons of bitmaps; the
members of one bucket are compared in blocks, so their number squared bounds that work.

Defined results: documents without words (null, empty or white text) have empty sets, are
linked with nothing and are components of their own; null ids count in no minimum, so a
component has a null id only if all its ids are null. Repeated rows are copies. An empty table
gives no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliant.llm import common
from foliant.llm.common import Scratch
from foliant.llm.components import components
from foliant.llm.hashing import mix, shingles

_TURN, _NONE = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)  # odd, of random bits


def durable(df: DataFrame) -> DataFrame:
    """A checkpoint; then the files of the shuffles behind it may go, which Spark removes once
    the driver has collected their objects."""
    out = common.durable(df)
    df.sparkSession._jvm.System.gc()
    return out


def most_different(a: int, b: int, percent: int) -> int:
    """Elements in which sets of these sizes may differ when they are similar."""
    return (a + b) * (100 - percent) // (100 + percent)


def bins_of(hashes: np.ndarray, bins: int, first: int, seed: int) -> np.ndarray:
    """Keys of the first bins of sorted hashes: by size, large ones first, then by key."""
    at = ((hashes >> np.uint64(32)) * np.uint64(bins)) >> np.uint64(32)
    starts = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    salt = np.uint64(seed * int(_NONE) % (1 << 64))
    keys = mix(np.add.reduceat(hashes, starts) + (at[starts] + np.uint64(1)) * _TURN + salt)
    size = np.diff(np.append(starts, len(hashes)))
    keys = keys[np.lexsort((keys, -size))[:first]]
    if len(keys) < first:  # bins that are empty come last
        empty = np.setdiff1d(np.arange(bins, dtype=np.uint64), at[starts])
        keys = np.concatenate([keys, np.sort(mix((empty + np.uint64(1)) * _NONE + salt))[: first - len(keys)]])
    return keys


def bucket_keys(hashes: np.ndarray, percent: int) -> np.ndarray:
    """Keys of a set's buckets, in its size band and in those below whose sets may be similar."""
    n, out = len(hashes), []
    band = n.bit_length() - 1
    for b in range(band, -1, -1):
        top = (2 << b) - 1
        if b < band and n * percent > 100 * top:
            break
        bins = 6 * most_different(top, 100 * top // percent, percent) // 5 + 2
        first = most_different(n, 100 * n // percent if b == band else top, percent) + 1
        out.append(bins_of(hashes, bins, first, b + 1))
    return np.concatenate(out).view(np.int64)


def bitmap(hashes: np.ndarray) -> bytes:
    """Parity of the hashes by their low bits, in two to four bits an element, 64 at least."""
    bits = max(64, 4 << (len(hashes).bit_length() - 1))
    return np.packbits(np.bincount((hashes & np.uint64(bits - 1)).astype(np.int64), minlength=bits).astype(np.uint8) & 1, bitorder="little").tobytes()


def folded(maps: list[bytes], width: int) -> np.ndarray:
    """Bitmaps brought to one width in bytes, as rows of 64-bit words."""
    out = np.empty((len(maps), width), np.uint8)
    for i, m in enumerate(maps):
        x = np.frombuffer(m, np.uint8)
        while len(x) > width:
            x = x[: len(x) // 2] ^ x[len(x) // 2 :]
        out[i] = x
    return out.view(np.uint64)


def may_be_similar(differ: np.ndarray, n: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets of n and m elements whose bitmaps differ in so many bits may be similar."""
    most = np.minimum((n + m - differ) // 2, np.minimum(n, m))
    return 100 * most >= percent * (n + m - most)


def fine_bands(percent: int, most: int = 1 << 40) -> np.ndarray:
    """Lower ends of size bands such that similar sets are in one or in neighbouring bands."""
    ends = [1]
    while ends[-1] < most:
        ends.append(100 * ends[-1] // percent + 1)
    return np.array(ends)


def _sign(size: int, percent: int, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ends = fine_bands(percent)
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.slice(at, 256)
                sets = [shingles(t, size) for t in part.column(2).to_pylist()]
                n = np.array([len(s) for s in sets], np.int64)
                columns = [part.column(0), part.column(1), pa.array(n), pa.array(np.searchsorted(ends, n, "right").astype(np.int32)), pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()), pa.array([bitmap(s) if len(s) else b"" for s in sets], pa.binary()), pa.array([bucket_keys(s, percent) if len(s) else [] for s in sets], pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return run


def _near(percent: int, schema: pa.Schema):
    """Pairs (u, v, m) whose bitmaps leave them similar."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            c = {x: batch.column(x) for x in ("n_u", "n_v", "map_u", "map_v")}
            n, m = c["n_u"].to_numpy(), c["n_v"].to_numpy()
            differ = np.empty(len(batch), np.int64)
            for i, (a, b) in enumerate(zip(c["map_u"].to_pylist(), c["map_v"].to_pylist(), strict=True)):
                x = folded([a, b], min(len(a), len(b)))
                differ[i] = int(np.bitwise_count(x[0] ^ x[1]).sum())
            yield pa.RecordBatch.from_arrays([batch.column(x) for x in schema.names], schema=schema).filter(pa.array(may_be_similar(differ, n, m, percent)))

    return run


def _similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def _verify(size: int, percent: int, schema: pa.Schema):
    """Pairs (u, v) whose sets are similar."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, np.ndarray] = {}

        def of(node: int, text: bytes) -> np.ndarray:
            if node not in kept:
                if len(kept) >= 16:
                    kept.pop(next(iter(kept)))
                kept[node] = shingles(text, size)
            return kept[node]

        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.slice(at, 256)
                ok = [_similar(of(u, a), of(v, b), percent) for u, v, a, b in zip(*(c.to_pylist() for c in part.columns), strict=True)]
                yield pa.RecordBatch.from_arrays(part.columns[:2], schema=schema).filter(pa.array(ok, pa.bool_()))

    return run


_TILE = ["bucket", "a", "i", "b", "j"]


def _tiles(percent: int, schema: pa.Schema, size: int = 0):
    """For the tiles of a group: their members with a partner in another component by the
    bitmaps; with ``size``, links by the sets instead, enough to join all that are linked."""

    def run(group: pa.Table) -> pa.Table:
        keys = np.stack([group.column(c).to_numpy() for c in _TILE])
        order = np.lexsort(keys[::-1])
        cuts = np.flatnonzero((np.diff(keys[:, order], axis=1) != 0).any(0)) + 1
        side, node, comp, n = (group.column(c).to_numpy() for c in ("side", "node", "component", "n"))
        maps, texts, out = group.column("bitmap"), group.column("text") if size else None, []
        for tile in np.split(order, cuts):
            same = keys[1, tile[0]] == keys[3, tile[0]] and keys[2, tile[0]] == keys[4, tile[0]]
            own = np.zeros(len(tile), bool) if same else side[tile] == 1
            left, right = (np.arange(len(tile)),) * 2 if same else (np.flatnonzero(~own), np.flatnonzero(own))
            if not len(left) or not len(right) or (comp[tile] == comp[tile[0]]).all():
                continue
            each = [maps[int(k)].as_py() for k in tile]
            words, sets, roots = folded(each, min(map(len, each))), {}, {int(c): int(c) for c in comp[tile]}

            def root(c: int, roots: dict[int, int] = roots) -> int:
                while roots[c] != c:
                    roots[c] = c = roots[roots[c]]
                return c

            def of(k: int, tile: np.ndarray = tile, sets: dict[int, np.ndarray] = sets) -> np.ndarray:
                if k not in sets:
                    sets[k] = shingles(texts[int(tile[k])].as_py(), size)
                return sets[k]

            met = np.zeros(len(tile), bool)
            for x in left:
                y = right[right > x] if same else right
                differ = np.bitwise_count(words[y] ^ words[x]).sum(1, dtype=np.int64)
                y = y[(comp[tile[y]] != comp[tile[x]]) & may_be_similar(differ, n[tile[y]], n[tile[x]], percent)]
                if not size:
                    met[y] = True
                    met[x] |= len(y) > 0
                    continue
                for k in y:
                    a, b = root(int(comp[tile[x]])), root(int(comp[tile[k]]))
                    if a != b and _similar(of(int(x)), of(int(k)), percent):
                        roots[a] = b
                        out.append((int(node[tile[x]]), int(node[tile[k]])))
            if not size:
                out.extend(tile[met].tolist())
        if not size:
            return group.select(schema.names).take(pa.array(out, pa.int64())).cast(schema)
        return pa.table([pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)], schema=schema)

    return run


def similar_groups(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = 80, block: int = 512, block_words: int = 1 << 21, broadcast_rows: int = 500_000) -> DataFrame:
    """One row per document row: doc_id, n_shingles, component_id (smallest id reachable by
    links) and component, a key that is never null.

    ``block``, ``block_words``: rows of a tile's side, and elements of their sets (16 rows at
    least). ``broadcast_rows``: up to so many 16-byte digests are broadcast to pick texts from
    the scan; beyond, texts and digests meet by a shuffle.
    """
    if not 50 < percent <= 100:
        raise ValueError("percent lies between 51 and 100")
    spark, pair = docs.sparkSession, pa.schema([("u", pa.int64()), ("v", pa.int64())])
    scratch = Scratch(spark)
    text = F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))
    digest = F.unhex(F.md5(text)).alias("digest")
    schema = pa.schema([("doc_id", pa.int64()), ("digest", pa.binary()), ("n", pa.int64()), ("fine", pa.int32()), ("key", pa.binary()), ("bitmap", pa.binary()), ("buckets", pa.list_(pa.int64()))])
    signed = docs.select(F.col(id_col).cast("long").alias("doc_id"), digest, text.alias("text")).mapInArrow(_sign(size, percent, schema), "doc_id long, digest binary, n long, fine int, key binary, bitmap binary, buckets array<long>")
    base = scratch.write(signed.withColumn("row", F.monotonically_increasing_id()))
    sets = base.where("n > 0")
    # a number for each class; another hash is taken if two classes have the same
    for salt in count():
        node = F.xxhash64("key", F.lit(salt))
        classes = durable(sets.groupBy("key").agg(F.min("doc_id").alias("id"), F.min("digest").alias("digest")).withColumn("node", node))
        if classes.groupBy("node").count().where("count > 1").isEmpty():
            break
    rows = sets.select(node.alias("node"), F.explode("buckets").alias("bucket"))
    # written, so that the files of its shuffle may go before the rows are shuffled again
    several = scratch.write(rows.groupBy("bucket").agg(F.min("node").alias("lead"), F.max("node").alias("last")).where("lead < last").drop("last"))
    shared = durable(rows.join(several, "bucket").select("bucket", "node", "lead").distinct())
    scratch.drop(several)
    some = sets.select(node.alias("node"), "n", "fine", "bitmap").join(shared.select("node").distinct(), "node", "left_semi")
    some = durable(some.groupBy("node").agg(F.first("n").alias("n"), F.first("fine").alias("fine"), F.first("bitmap").alias("bitmap")))

    def texts_of(nodes: DataFrame) -> DataFrame:
        """(node, text) of a document of each class."""
        wanted = durable(classes.select("node", "digest").join(nodes, "node", "left_semi"))
        few = F.broadcast(wanted) if wanted.count() <= broadcast_rows else wanted
        return durable(docs.select(digest, text.alias("text")).join(few, "digest").groupBy("node").agg(F.first("text").alias("text")))

    def sided(pairs: DataFrame, facts: DataFrame, names: dict[str, str]) -> DataFrame:
        for s in ("u", "v"):
            pairs = pairs.join(facts.select(F.col("node").alias(s), *(F.col(c).alias(f"{x}_{s}") for c, x in names.items())), s)
        return pairs

    rays = shared.where("node <> lead").groupBy(F.col("node").alias("u"), F.col("lead").alias("v")).agg(F.count(F.lit(1)).alias("m"))
    triple = pa.schema([*pair, ("m", pa.int64())])
    near = sided(rays, some.drop("fine"), {"n": "n", "bitmap": "map"}).where(100 * F.least("n_u", "n_v") >= percent * F.greatest("n_u", "n_v"))
    near = durable(near.mapInArrow(_near(percent, triple), "u long, v long, m long"))
    ends = near.select(F.col("u").alias("node")).unionByName(near.select(F.col("v").alias("node"))).distinct()
    texts = texts_of(ends)

    def linked(pairs: DataFrame) -> DataFrame:
        return sided(pairs.select("u", "v"), texts, {"text": "text"}).select("u", "v", "text_u", "text_v").mapInArrow(_verify(size, percent, pair), "u long, v long")

    best = near.groupBy("u").agg(F.max(F.struct("m", (-F.col("v")).alias("v"))).alias("x")).select("u", (-F.col("x.v")).alias("v"))
    labels = durable(components(durable(linked(best))))
    named = lambda c: labels.select(F.col("node").alias(c), F.col("component").alias(f"c_{c}"))
    other = near.join(best, ["u", "v"], "left_anti").join(named("u"), "u", "left").join(named("v"), "v", "left")
    links = durable(linked(other.where(F.coalesce("c_u", "u") != F.coalesce("c_v", "v"))))
    joined = lambda more: durable(components(more.unionByName(labels.select(F.col("node").alias("u"), F.col("component").alias("v")))))
    if not links.isEmpty():
        labels = joined(links)

    # tiles of the buckets that still hold several components
    member = shared.join(labels, "node", "left").select("bucket", "node", F.coalesce("component", "node").alias("component"))
    mixed = member.groupBy("bucket").agg(F.min("component").alias("a"), F.max("component").alias("b"), F.count(F.lit(1)).alias("m")).where("a < b AND m > 2")
    member = durable(member.join(mixed.select("bucket"), "bucket").join(some.select("node", "fine", "n"), "node"))
    bands = member.groupBy("bucket", "fine").agg(F.count(F.lit(1)).alias("m"), F.max("n").alias("n"))
    bands = bands.select("bucket", F.col("fine").alias("other_fine"), F.ceil(F.col("m") / F.least(F.lit(block), F.greatest(F.lit(16), F.floor(block_words / F.col("n"))))).cast("int").alias("parts"))
    own = bands.select("bucket", F.col("other_fine").alias("fine"), F.col("parts").alias("own_parts"))
    placed = member.join(own, ["bucket", "fine"]).withColumn("part", F.pmod(F.xxhash64("node"), F.col("own_parts")).cast("int"))
    meets = placed.join(bands, "bucket").where("abs(fine - other_fine) <= 1").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    here, there = F.struct(F.col("fine").alias("f"), F.col("part").alias("p")), F.struct(F.col("other_fine").alias("f"), F.col("other").alias("p"))
    low, high = F.least(here, there), F.greatest(here, there)
    tiled = meets.select("bucket", low["f"].alias("a"), low["p"].alias("i"), high["f"].alias("b"), high["p"].alias("j"), (here > there).cast("int").alias("side"), "node", "component", "n")
    if member.isEmpty():
        links = None
    else:
        packs = tiled.count() // 1024 + 1
        pack = F.pmod(F.xxhash64(*_TILE), F.lit(packs)).alias("pack")
        facts = pa.schema([*((c, t) for c, t in zip(_TILE, (pa.int64(), *[pa.int32()] * 4), strict=True)), ("side", pa.int32()), ("node", pa.int64()), ("component", pa.int64()), ("n", pa.int64()), ("bitmap", pa.binary())])
        kept = "bucket long, a int, i int, b int, j int, side int, node long, component long, n long, bitmap binary"
        meet = durable(tiled.join(some.select("node", "bitmap"), "node").withColumn("pack", pack).groupBy("pack").applyInArrow(_tiles(percent, facts), kept))
        bodies = texts_of(meet.select("node").distinct())
        links = durable(meet.join(bodies, "node").withColumn("pack", pack).groupBy("pack").applyInArrow(_tiles(percent, pair, size), "u long, v long"))
    if links is not None and not links.isEmpty():
        labels = joined(links)
    classed = classes.select("key", "node", "id").join(labels, "node", "left").select("key", "id", F.coalesce("component", "node").alias("component"))
    found = classed.select("key", "component").join(classed.groupBy("component").agg(F.min("id").alias("component_id")), "component")
    whole = base.select("doc_id", "n", "key", "row")
    placed = whole.where("n > 0").join(found, "key").select("doc_id", "n", "component_id", F.struct(F.lit(False).alias("alone"), F.col("component").alias("at")).alias("component"))
    alone = whole.where("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id"), F.struct(F.lit(True).alias("alone"), F.col("row").alias("at")).alias("component"))
    return scratch.keep(scratch.write(placed.unionByName(alone).select("doc_id", F.col("n").alias("n_shingles"), "component_id", "component")))
