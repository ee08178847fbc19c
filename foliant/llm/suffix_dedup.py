"""Operator 10: removal of repeated byte strings by a distributed merge sort of suffixes.

A byte goes if a ``size``-byte string that covers it also starts somewhere else. The strings
are suffixes cut at ``size`` bytes, and equal ones are neighbours in sorted order. Several
sizes (levels) are answered at once:

1. Every suffix is anchored at the least hashed gram inside its first bytes (as many as the
   least size). Equal suffixes have equal anchors at equal offsets, so suffixes whose anchor
   occurs once are unique and drop out. Anchors whose whole context (all bytes that their
   suffixes can hold) is equal collapse into one with a count; suffixes of a context that
   occurs twice are repeats at every size.
2. Where different contexts share an anchor, the suffixes are taken in blocks of neighbours
   and the same is done again: a block whose core (what all its strings of a size hold) occurs
   once is unique at that size and above, and blocks that are equal as a whole collapse.
3. The suffixes left, those at the edges of what is shared, are sorted in runs by the tasks
   that read them. Runs are front-coded (length of the common prefix with the entry before,
   then the rest) and exchanged by ranges of a bounded sample of keys.
4. Each range is merged by a loser tree that carries common prefix lengths: entries compare
   only beyond what both share with the last winner. Entries whose common prefix is the
   whole key are one string; its occurrences are counted.

A key is the first ``head`` bytes of the suffix and a 96-bit hash of all of it, so a whole
key stands for the whole string and the exchange stays small. A run carries an entry once,
with its count, however often it occurs in the run. No step gathers the holders of one
string in one task: counts are combined before they are exchanged, joins deal out frequent
keys, and ranges are cut at whole keys.

A passage is a maximal repeated run at the least size that has more than ``words`` words
(those it cuts included) or at least ``size`` bytes.

Defined results: null text is empty; texts shorter than ``size`` keep all bytes. Repeated
rows count as occurrences elsewhere. Null ids are kept. An empty table gives no rows. Other
columns are not read (they are passed on by ``remove_repeats``, whatever their names).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliant.llm.common import Scratch, bytes_of
from foliant.llm.hashing import Prefix, mix

_SEGMENT = 1 << 20  # suffixes of a text that are anchored at once
_INDEX = np.uint64((1 << 22) - 1)
_REF = np.dtype([("id", "<i8"), ("offset", "<i4")])
_LEVELS = 4  # sizes that a reference can tell apart
_HASH = 12  # bytes of a key that stand for the whole suffix


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    cur, n = x, 1
    while n * 2 <= w:
        cur = np.minimum(cur[:-n], cur[n:])
        n *= 2
    m = len(x) - w + 1
    return np.minimum(cur[:m], cur[w - n : w - n + m])


def anchors(text: bytes, sizes: tuple[int, ...], w: int) -> dict[str, np.ndarray]:
    """Anchors of a text's suffixes: hashes of gram and context, position, first and last suffix."""
    values = np.frombuffer(text, np.uint8).astype(np.uint64) + np.uint64(1)
    size = sizes[0]
    n, k = len(text), size - w + 1
    prefix, at, first, grams = Prefix(values), [], [], []
    for a in range(0, n - size + 1, _SEGMENT):
        b = min(n - size + 1, a + _SEGMENT)
        gram = Prefix(values[a : b + size - 1]).windows(k)
        low = sliding_min((gram & ~_INDEX) | (np.arange(len(gram), dtype=np.uint64) & _INDEX), w) & _INDEX
        change = np.flatnonzero(np.concatenate([[True], low[1:] != low[:-1]]))
        where = low[change].astype(np.int64)
        at.append(where + a)
        first.append(change + a)
        grams.append(gram[where])
    p, lo, gram = np.concatenate(at), np.concatenate(first), np.concatenate(grams)
    new = np.concatenate([[True], p[1:] != p[:-1]])  # one anchor may serve both sides of a segment's end
    p, lo, gram = p[new], lo[new], gram[new]
    # the longest size's context decides all sizes; near a text's end it is cut
    left, right = np.maximum(p - (w - 1), 0), np.minimum(p + k + w - 1 + sizes[-1] - size, n)
    edges = ((p - left) * (1 << 20) + (right - p)).astype(np.uint64)
    context = mix(prefix(left, right) ^ mix(edges))
    return {"gram": gram.view(np.int64), "context": context.view(np.int64), "p": p, "lo": lo, "hi": np.concatenate([lo[1:] - 1, [n - size]])}


def _anchored(sizes: tuple[int, ...], w: int, schema: pa.Schema):
    names = schema.names[1:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1)
            for at in range(0, len(batch), 64):
                found = [anchors(t, sizes, w) for t in texts.slice(at, 64).to_pylist()]
                which = np.repeat(np.arange(at, at + len(found)), [len(x["p"]) for x in found])
                columns = [pa.array(np.concatenate([x[c] for x in found])).cast(pa.int64()) for c in names]
                yield pa.RecordBatch.from_arrays([keys.take(pa.array(which)), *columns], schema=schema)

    return run


def _bodies(most: int, schema: pa.Schema):
    """Cut each context out of its text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 128):
                rows = []
                for r in batch.slice(at, 128).to_pylist():
                    for c in r["contexts"]:
                        rows.append((r["h"], c["p"], c["many"], c["p"] - c["lo"], c["hi"] - c["lo"] + 1, r["text"][c["lo"] : c["hi"] + most]))
                yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], t.type) for j, t in enumerate(schema)], schema=schema)

    return run


def _ints(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False).astype(np.int64)


def _joined(bodies: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of all bodies one after another, where each begins, and their lengths."""
    found = bodies.to_pylist()
    sizes = np.array([len(x) for x in found], np.int64)
    return np.frombuffer(b"".join(found), np.uint8), np.cumsum(sizes) - sizes, sizes


def _each(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For counts of entries: the owner of each entry and its number in the owner."""
    owner = np.repeat(np.arange(len(counts)), counts)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)


def _blocks(sizes: tuple[int, ...], block: int, schema: pa.Schema):
    """The suffixes of each body in blocks, numbered from the anchor: for each size the hashes
    of core and whole (0: no suffix of the block is that long)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for all_ in batches:
            for at in range(0, len(all_), 1024):
                batch = all_.slice(at, 1024)
                back, n = (_ints(batch, c) for c in ("back", "n"))
                raw, base, length = _joined(batch.column("body"))
                hashed = Prefix(raw.astype(np.uint64) + np.uint64(1))
                lowest = -back // block
                which, j = _each((n - 1 - back) // block - lowest + 1)
                j = j + lowest[which]
                back, n, base, length = (x[which] for x in (back, n, base, length))
                columns = {"j": j}
                x, place = np.maximum(back + j * block, 0), mix((j + (1 << 20)).astype(np.uint64))
                for i, t in enumerate(sizes):
                    y = np.minimum(back + (j + 1) * block - 1, np.minimum(n, length - t + 1) - 1)
                    long = np.flatnonzero(y >= x)
                    o, b, jl, yl, xl = base[long], back[long], j[long], y[long], x[long]
                    core, whole = np.zeros(len(j), np.uint64), np.zeros(len(j), np.uint64)
                    core[long] = mix(hashed(o + b + (jl + 1) * block - 1, o + b + jl * block + t) ^ place[long]) | np.uint64(1)
                    edges = ((xl - b + (1 << 20)) * (1 << 22) + yl - b + (1 << 20)).astype(np.uint64)
                    whole[long] = mix(hashed(o + xl, o + yl + t) ^ mix(edges)) | np.uint64(1)
                    columns |= {f"core{i}": core.view(np.int64), f"whole{i}": whole.view(np.int64)}
                rows = pa.array(which)
                yield pa.RecordBatch.from_arrays([pa.array(columns[f.name]).cast(f.type) if f.name in columns else batch.column(f.name).take(rows) for f in schema], schema=schema)

    return run


def front_code(keys: np.ndarray) -> tuple[np.ndarray, bytes]:
    """(common prefix with the key before, the keys' remaining bytes) of sorted byte rows."""
    n, width = keys.shape
    lcp = np.zeros(n, np.uint8)
    if n > 1:
        differ = keys[1:] != keys[:-1]
        lcp[1:] = np.where(differ.any(1), differ.argmax(1), width)
    return lcp, keys[np.arange(width) >= lcp[:, None]].tobytes()


def _pack(refs: np.ndarray) -> bytes:
    """References byte by byte of their numbers, which compresses well."""
    return np.ascontiguousarray(refs).view(np.uint8).reshape(len(refs), _REF.itemsize).T.tobytes()


def _unpack(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(_REF.itemsize, -1).T).view(_REF).ravel()


def sorted_run(keys: np.ndarray, counts: np.ndarray, refs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct sorted keys with their counts and one reference each, and the references of
    keys that this run alone shows to be repeats."""
    order = np.argsort(np.ascontiguousarray(keys).view(f"S{keys.shape[1]}").ravel(), kind="stable")
    keys, counts, refs = keys[order], counts[order], refs[order]
    new = np.concatenate([[True], (keys[1:] != keys[:-1]).any(1)])
    first = np.flatnonzero(new)
    total = np.add.reduceat(counts, first)
    done = refs[(total >= 2)[np.cumsum(new) - 1] & (counts == 1)]
    return keys[first], np.minimum(total, 2), refs[first], done


def _keys(batch: pa.RecordBatch, sizes: tuple[int, ...], block: int, head: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys, counts and references of the suffixes in the open blocks of the bodies."""
    back, n, ids = (_ints(batch, c) for c in ("back", "n", "id"))
    raw, base, length = _joined(batch.column("body"))
    blocks = batch.column("blocks").to_pylist()
    which = np.repeat(np.arange(len(batch)), [len(x) for x in blocks])
    level, j, many = (np.array([b[c] for x in blocks for b in x], t) for c, t in (("level", np.int64), ("j", np.int64), ("many", bool)))
    t = np.array(sizes)[level]
    x, y = np.maximum(back[which] + j * block, 0), np.minimum(back[which] + (j + 1) * block, np.minimum(n[which], length[which] - t + 1)) - 1
    owner, k = _each(y - x + 1)
    at, which, t, level = x[owner] + k, which[owner], t[owner], level[owner]
    starts, ends = base[which] + at, base[which] + at + t
    values = raw.astype(np.uint64) + np.uint64(1)
    # strings of different sizes never meet
    hashes = np.stack([Prefix(values)(starts, ends) ^ mix(t.astype(np.uint64)), Prefix(mix(values))(starts, ends)], 1)
    keys = np.hstack([np.lib.stride_tricks.sliding_window_view(raw, head)[starts], np.ascontiguousarray(hashes).view(np.uint8)[:, :_HASH]])
    refs = np.empty(len(at), _REF)
    refs["id"], refs["offset"] = ids[which], (back[which] - at) * _LEVELS + level
    return keys, np.where(many[owner], 2, 1), refs


def _first_keys(sizes: tuple[int, ...], block: int, head: int):
    """The key of the first suffix in each open block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 256):
                keys, _, _ = _keys(batch.slice(at, 256), sizes, block, head)
                yield pa.RecordBatch.from_arrays([pa.array([k.tobytes() for k in keys[::block]], pa.binary())], ["key"])

    return run


def _runs(sizes: tuple[int, ...], block: int, head: int, splitters: list[bytes], limit: int, schema: pa.Schema):
    """Sort suffixes in runs and deal their front-coded parts out by ranges of keys."""

    press = zstandard.compress

    def flush(parts: list[tuple]) -> Iterator[tuple]:
        keys, counts, refs, done = sorted_run(*(np.concatenate(x) for x in zip(*parts, strict=True)))
        width = keys.shape[1]
        edges = np.array(splitters, f"S{width}") if splitters else np.empty(0, f"S{width}")
        side = np.searchsorted(edges, np.ascontiguousarray(keys).view(f"S{width}").ravel(), side="right")
        cut = np.concatenate([[0], np.flatnonzero(side[1:] != side[:-1]) + 1, [len(keys)]])
        for j, (a, b) in enumerate(zip(cut, cut[1:], strict=False)):
            lcp, rest = front_code(keys[a:b])
            part = (lcp.tobytes(), rest, counts[a:b].astype(np.uint8).tobytes(), _pack(refs[a:b]), b"" if j else _pack(done))
            yield int(side[a]), *map(press, part)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in batches:
            for at in range(0, len(batch), 256):
                rows: list[tuple] = []
                parts.append(_keys(batch.slice(at, 256), sizes, block, head))
                held += len(parts[-1][1])
                if held >= limit:
                    rows += flush(parts)
                    parts, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array([x[j] for x in rows], t.type) for j, t in enumerate(schema)], schema=schema)
        if held:
            rows = list(flush(parts))
            yield pa.RecordBatch.from_arrays([pa.array([x[j] for x in rows], t.type) for j, t in enumerate(schema)], schema=schema)

    return run


class _Run:
    """A front-coded run, decoded one entry at a time."""

    __slots__ = ("_at", "_i", "_lcp", "_rest", "_width", "key")

    def __init__(self, lcp: bytes, rest: bytes, width: int):
        self._lcp, self._rest, self._width, self._i, self._at, self.key = lcp, rest, width, -1, 0, b""

    def step(self) -> int:
        """Move on; the common prefix with the entry before, or -1 at the end."""
        self._i += 1
        if self._i >= len(self._lcp):
            self.key = None
            return -1
        h = self._lcp[self._i]
        end = self._at + self._width - h
        self.key = self.key[:h] + self._rest[self._at : end]
        self._at = end
        return h

    @property
    def index(self) -> int:
        return self._i


def _common(a: bytes, b: bytes, h: int, width: int) -> int:
    """Length of the common prefix, known to be h at least."""
    while h + 8 <= width and a[h : h + 8] == b[h : h + 8]:
        h += 8
    while h < width and a[h] == b[h]:
        h += 1
    return h


def merge(runs: list[tuple[bytes, bytes]], width: int) -> Iterator[tuple[int, int, int]]:
    """Entries of front-coded runs in order: (common prefix with the entry before, run, index).

    A loser tree whose nodes hold the loser and its common prefix with the winner that beat
    it. Of two entries the one that shares more with the last winner is smaller; only if both
    share the same are bytes compared, from there on.
    """
    streams = [_Run(lcp, rest, width) for lcp, rest in runs]
    k = 1 << max(0, (len(streams) - 1).bit_length())
    streams += [_Run(b"", b"", width) for _ in range(k - len(streams))]
    for s in streams:
        s.step()
    losers: list[tuple[int, int]] = [(0, 0)] * k

    def play(a: int, ha: int, b: int, hb: int) -> tuple[int, int, int, int]:
        """Winner and its prefix with the last winner; loser and its prefix with this one."""
        x, y = streams[a].key, streams[b].key
        if x is None:
            return b, hb, a, 0
        if y is None or ha > hb:
            return a, ha, b, 0 if y is None else hb
        if hb > ha:
            return b, hb, a, ha
        h = _common(x, y, ha, width)
        if h == width or x[h] < y[h]:
            return a, ha, b, h
        return b, hb, a, h

    def build(node: int) -> tuple[int, int]:
        if node >= k:
            return node - k, 0
        a, ha = build(2 * node)
        b, hb = build(2 * node + 1)
        winner, hw, loser, hl = play(a, ha, b, hb)
        losers[node] = (loser, hl)
        return winner, hw

    winner, h = build(1)
    while streams[winner].key is not None:
        yield h, winner, streams[winner].index
        h, node = max(0, streams[winner].step()), (winner + k) >> 1
        while node:
            other, ho = losers[node]
            winner, h, loser, hl = play(winner, h, other, ho)
            losers[node] = (loser, hl)
            node >>= 1


def _merged(width: int, schema: pa.Schema):
    def run(group: pa.Table) -> pa.Table:
        loose = zstandard.decompress
        parts = [{k: loose(v) for k, v in p.items()} for p in group.select(["lcp", "rest", "counts", "refs", "done"]).to_pylist()]
        refs = [_unpack(p["refs"]) for p in parts]
        out = [_unpack(p["done"]) for p in parts]
        same: list[tuple[int, int]] = []
        hit: list[tuple[int, int]] = []

        def close() -> None:
            if sum(parts[r]["counts"][i] for r, i in same) >= 2:
                # an entry of a count over 1 was settled in its run
                hit.extend((r, i) for r, i in same if parts[r]["counts"][i] == 1)

        for h, r, i in merge([(p["lcp"], p["rest"]) for p in parts], width):
            if h < width:
                close()
                same = []
            same.append((r, i))
        close()
        if hit:
            out.append(np.array([refs[r][i] for r, i in hit], _REF))
        found = np.concatenate(out) if out else np.empty(0, _REF)
        return pa.table([pa.array(np.ascontiguousarray(found[c]).astype(np.int64)) for c in ("id", "offset")], schema=schema)

    return run


def _spans(row: np.ndarray, start: np.ndarray, end: np.ndarray, n_rows: int) -> list[np.ndarray]:
    """For each row the maximal runs (start, end) of its ranges' bytes."""
    wide = int(end.max(initial=0)) + 2
    order = np.argsort(row * wide + start, kind="stable")
    row, start, end = row[order], start[order] + row[order] * wide, end[order] + row[order] * wide
    reach = np.maximum.accumulate(end) if len(end) else end
    first = np.concatenate([[True], start[1:] > reach[:-1]]) if len(end) else np.empty(0, bool)
    at = np.flatnonzero(first)
    last = np.concatenate([at[1:] - 1, [len(end) - 1]]) if len(at) else at
    spans = np.stack([start[at], reach[last]], 1) - (row[at] * wide)[:, None]
    return np.split(spans, np.searchsorted(row[at], np.arange(1, n_rows)))


def _listed(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The values of a list column and the row of each; null lists are empty."""
    counts = np.diff(column.offsets.to_numpy()) if column.null_count == 0 else np.array([0 if x is None else x for x in column.value_lengths().to_pylist()], np.int64)
    return column.flatten(), np.repeat(np.arange(len(column)), counts)


def _removed(sizes: tuple[int, ...], words: int | None, full: int, cut: str, schema: pa.Schema):
    """Spans of the last size and, if words are given, passages of the first (more words or
    ``full`` bytes); with ``cut`` ("spans" or "passages") the text without those."""
    number = lambda a: a.to_numpy(zero_copy_only=False).astype(np.int64)

    def found(batch: pa.RecordBatch, lengths: np.ndarray) -> dict[int, list[np.ndarray]]:
        whole, w_row = _listed(batch.column("whole"))
        level, lo, hi = (number(whole.field(c)) for c in ("level", "lo", "hi"))
        single, s_row = _listed(batch.column("single"))
        offset, of = _listed(single.field("offsets"))
        offset = number(offset)
        p, s_row = number(single.field("p"))[of], s_row[of]
        out = {}
        for i, t in enumerate(sizes):
            last = lengths[w_row] - t
            a = ((level == -1) | (level == i)) & (lo <= last)
            b = offset % _LEVELS == i
            begin = p[b] - offset[b] // _LEVELS
            out[t] = _spans(np.concatenate([w_row[a], s_row[b]]), np.concatenate([lo[a], begin]), np.concatenate([np.minimum(hi[a], last[a]) + t, begin + t]), len(batch))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, len(whole), 128):
                batch = whole.slice(at, 128)
                texts = batch.column("text").to_pylist()
                spans = found(batch, np.array([len(t) for t in texts], np.int64))
                out: dict[str, list] = {f.name: [] for f in schema}
                for i, (h, text) in enumerate(zip(batch.column("h").to_pylist(), texts, strict=True)):
                    chosen = {"spans": spans[sizes[-1]][i].tolist()}
                    if words is not None:
                        chosen["passages"] = [(b, e) for b, e in spans[sizes[0]][i].tolist() if e - b >= full or len(text[b:e].split()) > words]
                    kept, last = [], 0
                    for b, e in chosen[cut]:
                        kept.append(text[last:b])
                        last = e
                    kept = b"".join([*kept, text[last:]])
                    row = {k: [{"start": b, "end": e} for b, e in v] for k, v in chosen.items()} | {"h": h, "kept_sha256": hashlib.sha256(kept).hexdigest(), "kept": kept}
                    for name, column in out.items():
                        column.append(row[name].decode("utf-8", "ignore") if name == "kept" else row[name])
                yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in schema], schema=schema)

    return run


_SPAN = "array<struct<start: long, end: long>>"
_SPAN_ARROW = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _repeats(rows: DataFrame, sizes: tuple[int, ...], words: int | None, full: int, cut: str, w: int, block: int, head: int, run_rows: int, range_rows: int, sample: int, broadcast_rows: int, with_text: bool) -> DataFrame:
    """For each distinct text (h, text) in which something repeats: what goes."""
    spark = rows.sparkSession
    block, head = max(1, min(block, sizes[0] // 2)), min(head, sizes[0])
    ints = lambda *names: [(n, pa.int64()) for n in names]
    long = rows.where(F.octet_length("text") >= sizes[0])

    def texts_of(wanted: DataFrame) -> DataFrame:
        """The distinct texts that wanted (h, ...) names, with its other columns."""
        keys = wanted.select("h")
        if keys.count() <= broadcast_rows:
            keys = F.broadcast(keys)
        return long.join(keys, "h", "left_semi").groupBy("h").agg(F.first("text").alias("text")).join(wanted, "h")

    def meet(rows: DataFrame, groups: DataFrame, on: list[str], by: str) -> DataFrame:
        """The rows whose key is in groups (key, n: rows that hold it). Fewer than 1000 keys
        can have more than a thousandth of the rows; these meet theirs in as many places as
        there are shuffle partitions."""
        total = groups.agg(F.sum("n")).first()[0] or 0
        hot = [r.k for r in groups.where(F.col("n") * 1000 > total).select(F.xxhash64(*on).alias("k")).collect()]
        spread = F.lit(int(spark.conf.get("spark.sql.shuffle.partitions")))
        is_hot = F.xxhash64(*on).isin(hot) if hot else F.lit(False)
        dealt = rows.withColumn("salt", F.when(is_hot, F.pmod(F.xxhash64(by), spread)).otherwise(0).cast("int"))
        places = groups.select(*on, F.explode(F.sequence(F.lit(0), F.when(is_hot, spread - 1).otherwise(0))).alias("salt"))
        return dealt.join(places.hint("merge"), [*on, "salt"], "left_semi").drop("salt")

    def settle(rows: DataFrame, part: list[str], whole: str, place: list[str], by: str) -> tuple[DataFrame, DataFrame]:
        """Of rows (part, whole, many, place): the rows whose whole occurs again, and one for
        each of the wholes that share their part with another (many: it occurs again)."""
        stand = F.min(F.struct(*place)).alias("x")
        wholes = tables.write(rows.groupBy(*part, whole).agg(stand, F.count(F.lit(1)).alias("n"), F.max("many").alias("many")))
        several = tables.write(wholes.groupBy(*part).agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
        left = tables.write(meet(wholes, several, part, whole).select(*part[:-1], "x.*", (F.col("many") | (F.col("n") > 1)).alias("many")))
        again = tables.write(meet(rows, wholes.where("n > 1"), [*part, whole], by).select(*part[:-1], *place))
        tables.drop(rows, wholes, several)
        return again, left

    tables = Scratch(spark)
    schema = pa.schema([("h", pa.binary()), *ints("gram", "context", "p", "lo", "hi")])
    # written, as it is read twice and the anchors cost more than the table
    anchored = tables.write(long.select("h", "text").mapInArrow(_anchored(sizes, w, schema), "h binary, gram long, context long, p long, lo long, hi long"))
    grams = tables.write(anchored.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    members = tables.write(meet(anchored, grams, ["gram"], "h").withColumn("many", F.lit(False)))
    tables.drop(anchored, grams)
    again, left = settle(members, ["gram"], "context", ["h", "p", "lo", "hi"], "h")

    of_text = tables.write(left.groupBy("h").agg(F.collect_list(F.struct("many", "p", "lo", "hi")).alias("contexts")))
    body = pa.schema([("h", pa.binary()), *ints("p"), ("many", pa.bool_()), *ints("back", "n"), ("body", pa.binary())])
    bodies = texts_of(of_text).select("h", "text", "contexts").mapInArrow(_bodies(sizes[-1], body), "h binary, p long, many boolean, back long, n long, body binary")
    bodies = tables.write(bodies.withColumn("id", F.monotonically_increasing_id()))
    tables.drop(left, of_text)
    hashes = [f"{c}{i}" for i in range(len(sizes)) for c in ("core", "whole")]
    schema = pa.schema([("id", pa.int64()), ("many", pa.bool_()), ("j", pa.int32()), *ints(*hashes)])
    blocks = bodies.select("id", "many", "back", "n", "body").mapInArrow(_blocks(sizes, block, schema), "id long, many boolean, j int, " + ", ".join(f"{c} long" for c in hashes))
    blocks = tables.write(blocks)
    cores = tables.write(blocks.groupBy("core0").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    level = F.explode(F.array(*(F.struct(F.lit(i).alias("level"), F.col(f"core{i}").alias("core"), F.col(f"whole{i}").alias("whole")) for i in range(len(sizes)))))
    kept = tables.write(meet(blocks, cores, ["core0"], "id").select("id", "many", "j", level.alias("x")).select("id", "many", "j", "x.*").where("core <> 0"))
    tables.drop(blocks, cores)
    again_block, left = settle(kept, ["level", "core"], "whole", ["id", "j"], "id")

    opened = left.groupBy("id").agg(F.collect_list(F.struct("level", "j", "many")).alias("blocks"))
    open_ = tables.write(bodies.join(opened, "id").select("id", "back", "n", "body", "blocks"))
    # samples and sizes balance the ranges only; every open suffix is sorted
    size = open_.agg(F.sum(F.size("blocks")).alias("blocks"), F.count(F.lit(1)).alias("n")).first()
    ranges = max(1, (size.blocks or 0) * block // range_rows)
    share = int(min(1.0, max(sample, 8 * ranges) / max(1, size.n)) * (1 << 30))
    drawn = open_.where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < share)
    drawn = sorted({bytes(r.key) for r in drawn.mapInArrow(_first_keys(sizes, block, head), "key binary").collect()}) if ranges > 1 else []
    splitters = sorted({drawn[i * len(drawn) // ranges] for i in range(1, ranges)}) if len(drawn) >= ranges else drawn
    runs = pa.schema([("range", pa.int32()), *((c, pa.binary()) for c in ("lcp", "rest", "counts", "refs", "done"))])
    settled = (
        open_.mapInArrow(_runs(sizes, block, head, splitters, run_rows, runs), "range int, lcp binary, rest binary, counts binary, refs binary, done binary")
        .groupBy("range")
        .applyInArrow(_merged(head + _HASH, pa.schema(ints("id", "offset"))), "id long, offset long")
        .groupBy("id")
        .agg(F.collect_set("offset").alias("offsets"))
    )
    single = bodies.select("id", "h", "p").join(settled, "id").groupBy("h").agg(F.collect_list(F.struct("p", "offsets")).alias("single"))
    first, p = F.col("p") + F.col("j") * block, F.col("p") - F.col("back")
    ends = F.greatest(first, p).alias("lo"), F.least(first + block - 1, p + F.col("n") - 1).alias("hi")
    in_block = again_block.join(bodies.select("id", "h", "p", "back", "n"), "id").select("h", "level", *ends)
    whole = again.select("h", F.lit(-1).alias("level"), "lo", "hi").union(in_block).groupBy("h").agg(F.collect_set(F.struct("level", "lo", "hi")).alias("whole"))
    found = texts_of(tables.keep(tables.write(whole.join(single, "h", "full")))).select("h", "text", "whole", "single")
    names = ["spans"] + ["passages"] * (words is not None)
    schema = pa.schema([("h", pa.binary()), *((n, _SPAN_ARROW) for n in names), ("kept_sha256", pa.string())] + [("kept", pa.string())] * with_text)
    return found.mapInArrow(_removed(sizes, words, full, cut, schema), "h binary, " + "".join(f"{n} {_SPAN}, " for n in names) + "kept_sha256 string" + ", kept string" * with_text)


def _length(spans: str) -> F.Column:
    return F.aggregate(spans, F.lit(0).cast("long"), lambda a, x: a + x["end"] - x["start"])


def repeated_spans(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", size: int = 400, passage: int | None = None, words: int = 50, w: int = 151, block: int = 16, head: int = 24, run_rows: int = 500_000, range_rows: int = 500_000, sample: int = 20_000, broadcast_rows: int = 500_000) -> DataFrame:
    """One row per document row: doc_id, n_bytes, n_removed, spans (byte ranges that go) and
    kept_sha256 of what stays; with ``passage`` (bytes, less than ``size``) also passages, the
    byte ranges of repeated runs of that many bytes with more than ``words`` words or ``size``
    bytes, and n_passage, their bytes.

    ``w``: suffixes per gram window (grams have w - 1 bytes less than the least size).
    ``block``: suffixes of a block. ``run_rows``: suffixes of a run. ``range_rows``: suffixes
    of a range of the exchange. ``sample``: open contexts drawn to balance the ranges (more for
    more ranges). ``broadcast_rows``: up to so many 16-byte keys are broadcast to pick texts
    from the scan; more meet by a shuffle.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), bytes_of(text_col).alias("text")).withColumn("h", F.unhex(F.md5("text")))
    sizes, count = ((passage, size), words) if passage else ((size,), None)
    found = _repeats(rows.select("h", "text"), sizes, count, size, "spans", w, block, head, run_rows, range_rows, sample, broadcast_rows, False)
    each = rows.select("doc_id", "h", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("own"))
    none = F.array().cast(_SPAN)
    full = each.join(found, "h", "left").withColumns({c: F.coalesce(c, none) for c in found.columns if c in ("spans", "passages")})
    more = ["passages", _length("passages").alias("n_passage")] if passage else []
    return full.select("doc_id", "n_bytes", _length("spans").alias("n_removed"), "spans", F.coalesce("kept_sha256", "own").alias("kept_sha256"), *more)


def remove_repeats(docs: DataFrame, *, text_col: str = "text", size: int = 400, passage: int | None = None, words: int = 50, w: int = 151, block: int = 16, head: int = 24, run_rows: int = 500_000, range_rows: int = 500_000, sample: int = 20_000, broadcast_rows: int = 500_000) -> DataFrame:
    """The documents, all columns, with repeated strings cut out of their texts: those of
    ``size`` bytes or, with ``passage``, passages (runs of so many bytes with more than
    ``words`` words or ``size`` bytes). Where a cut parts a character of several bytes, its
    rest goes too. Rows whose texts are equal stay equal; null text stays null."""
    whole = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), bytes_of(text_col).alias("text")).withColumn("h", F.unhex(F.md5("text")))
    sizes, count, cut = ((passage,), words, "passages") if passage else ((size,), None, "spans")
    found = _repeats(whole.select("h", "text"), sizes, count, size, cut, w, block, head, run_rows, range_rows, sample, broadcast_rows, True)
    joined = whole.select("row", "h").join(found.select("h", "kept"), "h", "left")
    kept = F.coalesce("kept", F.col("row").getField(text_col))
    return joined.select(*((kept if c == text_col else F.col("row").getField(c)).alias(c) for c in docs.columns))
