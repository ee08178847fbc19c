"""Operator 4: benchmark decontamination by Wu-Manber multi-pattern search over words.

Test strings are windows of ``size`` consecutive words of an item (an item of fewer words is
one window). Windows of one length form a class with its own Wu-Manber tables, whose symbols
are words and whose blocks are two words (one for windows of one word):

* the shift table gives, for a block of words, how far the search may move on;
* where the shift is 0, the block's suffix bucket gives the windows that end in it, selected
  by their first word;
* the words themselves are compared.

Test strings reach the executors in shards of at most ``shard_bytes`` of item text. Every
shard is searched, so any number of items gives whole results; only the number of passes
over the words of a batch of documents grows.

Defined results: null text has no words (n_words 0, nothing hit). Items of null text or
without words have no windows. Items of null id count under the id "null"; repeated item
rows count once. Repeated documents are rows of their own; null ids are kept. An empty
documents table gives no rows, an empty benchmark hits nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A-Z to a-z, and every ASCII byte but letters and digits to a space.
_FOLD = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20
    for c in range(256)
)


def words_of(text: bytes | None) -> list[bytes]:
    """Words of lower-cased UTF-8 text: runs of letters, digits and bytes over 0x7F."""
    return text.translate(_FOLD).split() if text else []


class WuManber:
    """Search for test strings of one length in words."""

    def __init__(self, windows: dict[tuple[bytes, ...], set[str]]):
        self.length = m = len(next(iter(windows)))
        self.block = b = min(2, m)
        self.default = m - b + 1
        self.shift: dict[object, int] = {}
        self.suffix: dict[object, dict[bytes, list[tuple[tuple[bytes, ...], set[str]]]]] = {}
        for window, items in windows.items():
            for end in range(b, m + 1):
                key = window[end - b : end] if b == 2 else window[0]
                self.shift[key] = min(self.shift.get(key, m), m - end)
            self.suffix.setdefault(key, {}).setdefault(window[0], []).append((window, items))

    def __call__(self, words: list[bytes]) -> Iterator[tuple[int, set[str]]]:
        """(start, items) of every occurrence, in order."""
        m, shift, default, n = self.length, self.shift.get, self.default, len(words)
        blocks = words if self.block == 1 else list(zip(words, words[1:], strict=False))
        at, back = m - self.block, m - self.block
        while at < len(blocks):
            step = shift(blocks[at], default)
            if step:
                at += step
                continue
            start = at - back
            for window, items in self.suffix[blocks[at]].get(words[start], ()):
                if start + m <= n and tuple(words[start : start + m]) == window:
                    yield start, items
            at += 1


def compile_patterns(items: Iterable[tuple[str, bytes]], size: int) -> list[WuManber]:
    """Tables for the windows of items, one for each window length."""
    classes: dict[int, dict[tuple[bytes, ...], set[str]]] = {}
    for item_id, text in items:
        words = words_of(text)
        m = min(size, len(words))
        for i in range(len(words) - m + 1 if m else 0):
            classes.setdefault(m, {}).setdefault(tuple(words[i : i + m]), set()).add(item_id)
    return [WuManber(windows) for _, windows in sorted(classes.items())]


def _shards(items: DataFrame, shard_bytes: int) -> Iterator[list[tuple[str, bytes]]]:
    shard, used = [], 0
    for item_id, text in items.toLocalIterator(prefetchPartitions=True):
        shard.append((item_id, bytes(text)))
        used += len(text) + 64
        if used >= shard_bytes:
            yield shard
            shard, used = [], 0
    if shard:
        yield shard


def _search(shards: list, size: int, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = compile_patterns(shards[0].value, size) if len(shards) == 1 else None
        for batch in batches:
            for at in range(0, len(batch), 1024):
                docs = [words_of(t) for t in batch.column(1).slice(at, 1024).to_pylist()]
                items: list[set[str]] = [set() for _ in docs]
                spans: list[list[tuple[int, int]]] = [[] for _ in docs]
                for s in shards:
                    for search in tables if tables is not None else compile_patterns(s.value, size):
                        m = search.length
                        for words, found, hit in zip(docs, items, spans, strict=True):
                            for start, of in search(words):
                                found |= of
                                hit.append((start, start + m))
                    if tables is None:
                        s.unpersist_local()
                merged = [_merge(x) for x in spans]
                columns = [
                    batch.column(0).slice(at, 1024).cast(pa.int64()),
                    pa.array([len(w) for w in docs], pa.int64()),
                    pa.array([sum(e - b for b, e in x) for x in merged], pa.int64()),
                    pa.array([sorted(x) for x in items], pa.list_(pa.string())),
                    pa.array([[{"start": b, "end": e} for b, e in x] for x in merged], schema.field(4).type),
                ]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return run


def _merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for b, e in sorted(spans):
        if out and b <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((b, e))
    return out


class _Shard:
    """A broadcast whose copy in the worker can be let go after use."""

    def __init__(self, broadcast):
        self._broadcast = broadcast

    @property
    def value(self) -> list[tuple[str, bytes]]:
        return self._broadcast.value

    def unpersist_local(self) -> None:
        self._broadcast.__dict__.pop("_value", None)


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    size: int = 10,
    shard_bytes: int = 8 << 20,
) -> DataFrame:
    """One row per document row: doc_id, n_words, n_hit, items (ids as strings, sorted) and
    spans (merged word ranges that occurrences cover).

    Items are read a partition at a time; the driver holds one shard of them at once.
    """
    sc = docs.sparkSession.sparkContext
    items = benchmark.select(
        F.coalesce(F.col(item_col).cast("string"), F.lit("null")).alias("item"), F.col(item_text_col).cast("binary").alias("body")
    ).where(F.col("body").isNotNull())
    shards = [_Shard(sc.broadcast(s)) for s in _shards(items, shard_bytes)]
    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.string())), ("spans", pa.list_(span))])
    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("binary")).mapInArrow(
        _search(shards, size, schema),
        "doc_id long, n_words long, n_hit long, items array<string>, spans array<struct<start: long, end: long>>",
    )


def contamination_digest(found: DataFrame) -> DataFrame:
    """The contract's columns from the operator's output."""
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def digest_of(items: Iterable[str]) -> str:
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
