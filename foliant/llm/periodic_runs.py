"""Operator 11: maximal periodic runs of the words of each document.

By the runs theorem every run has a Lyndon root that is the longest Lyndon word at its place
under one of the two orders of the alphabet. A stack scanned from right to left gives the
longest Lyndon word at every place; suffixes are compared by their first words, then by the
longest common extension: a few words directly, else a bisection over rolling hashes whose
result is verified on the words. Roots that follow each other with one length are extended to
both sides by the same bisection, over all of a document's roots at once, and verified word by
word. No suffix array is built.

Only stretches in which every window of ``(least + 2) // 3`` words occurs again in the document
are scanned: a run of ``least`` words and three periods lies inside one of them, with the words
that bound it.

Defined results: words are the runs of bytes other than ASCII white space; null, empty and white
texts have none, no runs and an empty collapsed text. A run found from several roots is one run.
The strongest run has the greatest length by period; of equal ones the smallest start, then the
smallest period. Ids are carried along, null and repeated ones too; an empty table gives no rows.
Documents are looked at one by one, so a text must fit a task.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliant.llm.hashing import Prefix, mix

_PRIME, _BASE = (1 << 61) - 1, 0x1F3D5B79A3C5E7F1 % ((1 << 61) - 1)
_DIRECT = 8  # words that are compared before hashes are


class Extension:
    """Length of the longest common prefix of two suffixes of a list of small numbers."""

    def __init__(self, codes: list[int]):
        self._codes, self._raw = codes, array("i", codes).tobytes()
        self._sums: list[int] = []
        self._powers: list[int] = []

    def _hashes(self) -> None:
        self._sums, self._powers, s, p = [0], [1], 0, 1
        for c in self._codes:
            s, p = (s * _BASE + c + 1) % _PRIME, p * _BASE % _PRIME
            self._sums.append(s)
            self._powers.append(p)

    def equal(self, i: int, j: int, n: int) -> bool:
        """Whether n words from i and from j are the same, by the words."""
        return self._raw[4 * i : 4 * (i + n)] == self._raw[4 * j : 4 * (j + n)]

    def __call__(self, i: int, j: int) -> int:
        codes, n = self._codes, len(self._codes) - max(i, j)
        k, m = 0, min(n, _DIRECT)
        while k < m and codes[i + k] == codes[j + k]:
            k += 1
        if k < m or k == n:
            return k
        if not self._sums:
            self._hashes()
        sums, powers, low, high = self._sums, self._powers, k, n
        while low < high:
            x = (low + high + 1) // 2
            same = (sums[i + x] - sums[i] * powers[x]) % _PRIME == (sums[j + x] - sums[j] * powers[x]) % _PRIME
            low, high = (x, high) if same else (low, x - 1)
        if not self.equal(i, j, low):  # equal hashes of different words
            low = k
            while low < n and codes[i + low] == codes[j + low]:
                low += 1
        return low


def lyndon_lengths(codes: list[int], extension: Extension, down: bool = False) -> list[int]:
    """Length of the longest Lyndon word at each place, under the order of the numbers or, with
    ``down``, its reverse; under both a proper prefix is smaller.

    The places not yet passed by a smaller suffix form a stack, linked by ``smaller``. ``shared``
    holds what a suffix has in common with the next one on it, which gives the answer for a
    block that repeats the next without another search.
    """
    rank, n = [-c for c in codes] if down else codes, len(codes)
    smaller, shared = [n] * n, [0] * n
    for i in range(n - 1, -1, -1):
        c, j, e = rank[i], i + 1, 0
        while j < n:
            d = rank[j]
            if c < d:
                j = smaller[j]
                continue
            e = 0
            if c > d:
                break
            q, beyond = j - i, smaller[j]
            e = q + shared[j] if beyond - j == q and beyond < n and extension.equal(i, j, q) else extension(i, j)
            if j + e == n or rank[i + e] > rank[j + e]:
                break
            j = beyond
        smaller[i], shared[i] = j, e
    return [j - i for i, j in enumerate(smaller)]


def _common(prefix: Prefix, i: np.ndarray, j: np.ndarray, most: np.ndarray, back: bool) -> np.ndarray:
    """How far words from i and j (before them, with ``back``) agree by their hashes."""
    low, high = np.zeros_like(i), most.copy()
    while (low < high).any():
        x = (low + high + 1) // 2
        same = prefix(i - x, i) == prefix(j - x, j) if back else prefix(i, i + x) == prefix(j, j + x)
        low, high = np.where(same, x, low), np.where(same, high, x - 1)
    return low


def runs_of(codes: np.ndarray, least: int = 24, times: int = 3) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of at least ``least`` words and ``times`` periods, by
    start, then period."""
    n, listed = len(codes), codes.tolist()
    if n < least:
        return []
    extension, prefix, found = Extension(listed), Prefix(mix(codes.astype(np.uint64))), set()
    for down in (False, True):
        root = np.array(lyndon_lengths(listed, extension, down), np.int64)
        i = np.flatnonzero(np.arange(n) + 2 * root <= n)
        i = i[(root[i + root[i]] == root[i]) & (codes[i] == codes[i + root[i]])]
        q = root[i]
        start = i - _common(prefix, i, i + q, i, True)
        end = i + q + _common(prefix, i, i + q, n - i - q, False)
        long = end - start >= np.maximum(least, times * q)
        for s, e, p in {*zip(start[long].tolist(), end[long].tolist(), q[long].tolist(), strict=True)}:
            if not np.array_equal(codes[s : e - p], codes[s + p : e]) or s and codes[s - 1] == codes[s - 1 + p] or e < n and codes[e] == codes[e - p]:
                s, e = _direct(codes, s, e, p)  # equal hashes of different words
            if e - s >= max(least, times * p):
                found.add((s, e - s, p))
    return sorted(found, key=lambda x: (x[0], x[2]))


def _direct(codes: np.ndarray, s: int, e: int, p: int) -> tuple[int, int]:
    """The longest stretch of period p in [s, e), extended word by word."""
    same = np.concatenate([[False], codes[s : e - p] == codes[s + p : e], [False]])
    edges = np.flatnonzero(np.diff(same.astype(np.int8)))
    if not len(edges):
        return s, s
    a, b = max(edges.reshape(-1, 2).tolist(), key=lambda x: x[1] - x[0])
    a, b = s + a, s + b + p
    while a and codes[a - 1] == codes[a - 1 + p]:
        a -= 1
    while b < len(codes) and codes[b] == codes[b - p]:
        b += 1
    return a, b


def recurring(codes: np.ndarray, window: int) -> Iterator[tuple[int, int]]:
    """Stretches [start, end) in which every window of so many words occurs elsewhere too."""
    h = Prefix(mix(codes.astype(np.uint64))).windows(window)
    order = np.argsort(h, kind="stable")
    same = h[order[1:]] == h[order[:-1]]
    again = np.zeros(len(h) + 2, bool)
    again[1 + order[1:][same]] = again[1 + order[:-1][same]] = True
    edges = np.flatnonzero(again[1:] != again[:-1]).tolist()
    yield from ((a, b - 1 + window) for a, b in zip(edges[::2], edges[1::2], strict=True))


def document_runs(words: list[bytes], least: int = 24, times: int = 3) -> list[tuple[int, int, int]]:
    """``runs_of`` a document's words, scanned where windows recur."""
    if len(words) < least:
        return []
    ids: dict[bytes, int] = {}
    codes = np.array([ids.setdefault(w, len(ids)) for w in words], np.int64)
    if len(ids) == len(words):
        return []
    stretches = [(a, b) for a, b in recurring(codes, max(1, (least + 2) // 3)) if b - a >= least]
    return [(a + s, n, p) for a, b in stretches for s, n, p in runs_of(codes[a:b], least, times)]


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words but for those that a run holds after its first period, joined by spaces."""
    gone = np.zeros(len(words) + 1, np.int64)
    for s, n, p in runs:
        gone[s + p] += 1
        gone[s + n] -= 1
    return b" ".join(w for w, g in zip(words, np.cumsum(gone).tolist()) if not g) if runs else b" ".join(words)


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _looked_at(least: int, times: int):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 256):
                part, n, runs, best, texts = batch.slice(at, 256), [], [], [], []
                for text in part.column(1).to_pylist():
                    words = (text or b"").split()  # bytes are split at ASCII white space
                    found = document_runs(words, least, times)
                    texts.append(collapsed(words, found))
                    n.append(len(words))
                    named = [{"start": s, "length": m, "period": p} for s, m, p in found]
                    runs.append(named)
                    best.append(_strongest(named))
                columns = [part.column(0), pa.array(n, pa.int64()), pa.array(runs, pa.list_(_RUN)), pa.array(best, _RUN), pa.array(texts, pa.binary()).view(pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "runs", "strongest", "collapsed"])

    return of


def _strongest(runs: list[dict]) -> dict | None:
    best = None
    for r in runs:  # by start, then period
        if best is None or r["length"] * best["period"] > best["length"] * r["period"]:
            best = r
    return best


def periodic_runs(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", least: int = 24, times: int = 3) -> DataFrame:
    """One row a row: doc_id, n_words, runs (by start, then period), strongest (null without
    runs) and collapsed, the words that no run holds after its first period. ``times``: 3 at
    least. Other columns are not read."""
    if times < 3 or least < 1:
        raise ValueError("runs have three periods at least")
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    run = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])
    out = T.StructType([slim.schema["doc_id"], *(T.StructField(c, t) for c, t in (("n_words", T.LongType()), ("runs", T.ArrayType(run)), ("strongest", run), ("collapsed", T.StringType())))])
    return slim.mapInArrow(_looked_at(least, times), out)


def collapse_runs(docs: DataFrame, *, text_col: str = "text", least: int = 24, times: int = 3) -> DataFrame:
    """The documents, each text that holds runs collapsed; other texts, null ones too, stay as
    they are, and so do all other columns, whatever they are named."""
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc_id"), F.col(text_col).alias("text"))
    found = periodic_runs(rows, least=least, times=times)
    text = F.when(F.size("runs") > 0, F.col("collapsed")).otherwise(F.col("doc_id").getField(text_col))
    return found.select(*(text.alias(c) if c == text_col else F.col("doc_id").getField(c).alias(c) for c in docs.columns))
