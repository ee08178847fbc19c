"""Operator 8: toxicity after noisy-channel deobfuscation.

A character trigram model is counted over all documents. Tokens that look written over
(look-alike signs, repeated letters, separators between letters) and runs of single letters
become lattices: look-alikes stand for one of their letters, runs for one or two letters,
separators for nothing or, in a second reading, for a word break where that is likelier.
Viterbi decoding picks the path likeliest under channel and language model, and the restored
words are scored. A run of single letters does not show where its words begin, so wherever one
of four letters or more that the weights hold begins in it, that counts too.

The score is a naive Bayes sum over the distinct tokens: each adds the largest log likelihood
ratio among its restored word and that word's beginnings, where the labelled sample shows
them to go with toxic documents. The sample is
bounded: at most ``sample`` labelled documents of each label, the first by a hash of their id,
and none that ``held_out`` marks.

Defined results: null and empty texts get the prior as their score (below 0.5). Labels of
unknown documents and null labels are left out; with no labels every score is near 0.
Repeated rows and null ids are rows of their own (a null id is not held out). Empty tables
give no rows. Other columns are not read.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Signs and the letters they are written for.
LOOK_ALIKES = {"4": "a", "@": "a", "8": "b", "3": "e", "6": "g", "9": "g", "1": "il", "!": "il", "|": "il", "0": "o", "5": "s", "$": "s", "7": "t", "+": "t", "2": "z"}
#: Log odds beyond the prior's that are tried.
MARGINS = tuple(x / 4 for x in range(25))
_SYMBOLS = 28  # boundary, a-z, any other letter
_SPACED = re.compile(r"(?<![\w@$!|+])[\w@$!|+](?:[\s.\-_*~/,]{1,2}[\w@$!|+]){2,}(?![\w@$|+])")
_SEPARATOR = re.compile(r"[\s.\-_*~/,]")
_EDGE = ".,;:?\"'()[]{}<>#%&*=~^`/\\-_…«»¿¡"
_LETTER, _SIGN, _LIKE, _THRICE = (re.compile(x) for x in (r"[^\W\d_]", r"[0-9@$!|+.\-_*~]", r"[0-9@$!|+]", r"([^\W\d_])\1\1"))


def _odd(token: str) -> bool:
    """A sign after a letter, a look-alike before one, or a letter thrice; linear in the length."""
    if not token.isalpha() and (first := _LETTER.search(token)):
        if _SIGN.search(token, first.end()):
            return True
        if (like := _LIKE.search(token)) and _LETTER.search(token, like.end()):
            return True
    return bool(_THRICE.search(token))


#: Classes of bytes for a quick test whether single letters follow each other at all.
_CLASS = bytes(0x61 if chr(c).isalnum() and c < 0x80 or c >= 0xC0 or chr(c) in "@$!|+" else 0x20 if chr(c) in " \t\n\r\v\f.-_*~/," else 0x23 for c in range(256))
_CONTINUED = bytes(range(0x80, 0xC0))


def _may_be_spaced(text: str) -> bool:
    return b"a a a" in text.encode().translate(_CLASS, _CONTINUED).replace(b"  ", b" ")


_CODE = np.zeros(256, np.int64)
_CODE[0x41:0x5B] = _CODE[0x61:0x7B] = np.arange(1, 27)
_CODE[0x80:] = 27


def trigram_counts(texts: list[bytes | None]) -> np.ndarray:
    x = _CODE[np.frombuffer(b" " + b"  ".join(t for t in texts if t) + b" ", np.uint8)]
    return np.bincount(x[:-2] * _SYMBOLS**2 + x[1:-1] * _SYMBOLS + x[2:], minlength=_SYMBOLS**3)


def _trigrams(schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 1024):
                n = trigram_counts(batch.column(0).slice(at, 1024).to_pylist())
                i = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(n[i], pa.int64())], schema=schema)

    return run


def language_model(counts: np.ndarray) -> np.ndarray:
    """log P(symbol | two before), interpolated with shorter contexts."""
    c3 = counts.reshape(_SYMBOLS, _SYMBOLS, _SYMBOLS).astype(float)
    c2, c1 = c3.sum(0), c3.sum((0, 1))
    p1 = (c1 + 1) / (c1.sum() + _SYMBOLS)
    p2 = (c2 + 5 * p1) / (c2.sum(1, keepdims=True) + 5)
    return np.log((c3 + 5 * p2) / (c3.sum(2, keepdims=True) + 5)).astype(np.float32)


def _symbol(c: str) -> int:
    return ord(c) - 96 if "a" <= c <= "z" else 27


class Restorer:
    """Viterbi decoding of one token's character lattice."""

    def __init__(self, log_p: np.ndarray):
        self._p = log_p.tolist()

    def lattice(self, token: str, breaks: bool = False) -> list[list[tuple[str, float]]]:
        """For each run of a sign: what it may stand for, and the channel's log probability.
        With ``breaks`` a separator may also stand for a space."""
        out = []
        for m in re.finditer(r"(.)\1*", token, re.S):
            c, n = m[1], len(m[0])
            if c in LOOK_ALIKES:
                ways = [(x, -1.0) for x in LOOK_ALIKES[c]] + [(x * 2, -1.5) for x in LOOK_ALIKES[c] if n > 1]
                ways += [("", -4.0)] if c in "!|+" else []
            elif c.isalpha():
                ways = [(c, 0.0)] if n == 1 else [(c * 2, 0.0), (c, -1.0)] if n == 2 else [(c, -0.5), (c * 2, -1.5)]
            else:
                ways = [("", -0.1), (" ", -0.1)] if breaks and _SEPARATOR.match(c) else [("", -0.1)]
            out.append(ways)
        return out

    def __call__(self, token: str, breaks: bool = False) -> str:
        # texts are linked lists: a token may be as long as its document
        paths: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}
        for ways in self.lattice(token, breaks):
            ahead: dict[tuple[int, int], tuple[float, tuple | None]] = {}
            for (a, b), (score, text) in paths.items():
                for letters, cost in ways:
                    x, y, s = a, b, score + cost
                    for c in letters:
                        z = 0 if c == " " else _symbol(c)
                        s += self._p[x][y][z]
                        x, y = y, z
                    if (x, y) not in ahead or s > ahead[x, y][0]:
                        ahead[x, y] = (s, (text, letters) if letters else text)
            paths = ahead
        text, out = max(((s + self._p[a][b][0], t) for (a, b), (s, t) in paths.items()), key=lambda x: x[0])[1], []
        while text:
            text, letters = text
            out.append(letters)
        return "".join(reversed(out))


class Words:
    """Features of a text's tokens (the restored word and its beginnings) or, with weights,
    the largest weight of each token; found once per token."""

    def __init__(self, log_p: np.ndarray, wanted: dict[str, float] | None = None, cache: int = 200_000):
        self._restore, self._wanted, self._size = Restorer(log_p), wanted, cache
        self._longest = max(map(len, wanted or ()), default=1) - 1  # without the mark
        self._kept: dict[str, tuple[str, ...] | float | None] = {}

    def _of(self, token: str) -> tuple[str, ...] | float | None:
        run = token[0] == " "  # see tokens
        whole = token.replace(" ", "")
        words = {whole.strip(_EDGE + "!|+0123456789@$")}
        core = whole.strip(_EDGE).rstrip("!")
        if len(core) >= 3 and _odd(core):
            words.add(self._restore(core))
        joined = words.copy() if run else set()
        core = token.strip(_EDGE + " ").rstrip("!")
        if len(core) >= 3 and _SEPARATOR.search(core) and (run or _odd(core)):
            words.update(self._restore(core, True).split())
        found = {f for w in words if len(w) > 2 for f in (f"={w}", *(f"^{w[:n]}" for n in (4, 5) if len(w) > n))}
        if self._wanted is None:
            return tuple(found)
        found |= {f for w in joined for i in range(1, len(w)) for n in range(4, min(self._longest, len(w) - i) + 1) for f in (f"={w[i : i + n]}", f"^{w[i : i + n]}") if f in self._wanted}
        found |= {f for w in joined for n in range(4, min(self._longest, len(w)) + 1) if (f := f"={w[:n]}") in self._wanted}
        return max((self._wanted[f] for f in found if f in self._wanted), default=None)

    def tokens(self, text: str) -> set[str]:
        """Tokens between white space, and runs of single letters: a space and the letters
        with a space for each separator."""
        text = text.lower()
        tokens = set(text.split())
        if _may_be_spaced(text):
            tokens |= {" " + _SEPARATOR.sub(" ", m) for m in _SPACED.findall(text)}
        return tokens

    def __call__(self, text: str) -> list:
        """What is found for each distinct token that has anything."""
        out, kept = [], self._kept
        for t in self.tokens(text):
            if t in kept:
                f = kept[t]
            else:
                f = self._of(t)
                if len(kept) < self._size and len(t) <= 256:
                    kept[t] = f
            if f:
                out.append(f)
        return out


def _labelled(log_p: np.ndarray, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(log_p)
        for batch in batches:
            for at in range(0, len(batch), 512):
                n: Counter[tuple[str, int]] = Counter()
                toxic: Counter[tuple[str, int]] = Counter()
                for text, label, fold in zip(*(c.to_pylist() for c in batch.slice(at, 512).columns), strict=True):
                    found = [(f, fold) for f in set().union(*words(text or ""))]
                    n.update(found)
                    if label:
                        toxic.update(found)
                yield pa.RecordBatch.from_arrays([pa.array([f for f, _ in n], pa.string()), pa.array([k for _, k in n], pa.int32()), pa.array(list(n.values()), pa.int64()), pa.array([toxic[f] for f in n], pa.int64())], schema=schema)

    return run


def _fold(i: int, folds: int) -> int:
    return zlib.crc32(f"fold {i}".encode()) % folds


def _tried(log_p: np.ndarray, parts: list[dict[str, float]], start: float, schema: pa.Schema):
    """Log odds of sampled documents by the weights that their fold has no part in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = [Words(log_p, w) for w in parts]
        for batch in batches:
            for at in range(0, len(batch), 512):
                rows = list(zip(*(c.to_pylist() for c in batch.slice(at, 512).columns), strict=True))
                z = [start + (sum(words[fold](text)) if text else 0.0) for text, _, fold in rows]
                yield pa.RecordBatch.from_arrays([pa.array([t for _, t, _ in rows], pa.bool_()), pa.array(z, pa.float64())], schema=schema)

    return run


def _scores(log_p: np.ndarray, weights: dict[str, float], start: float, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(log_p, weights)
        for batch in batches:
            for at in range(0, len(batch), 512):
                out = []
                for text in batch.column(1).slice(at, 512).to_pylist():
                    z = start + (sum(words(text)) if text else 0.0)
                    out.append(1 / (1 + math.exp(-min(z, 40.0))))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, 512).cast(pa.int64()), pa.array(out, pa.float64())], schema=schema)

    return run


def score_toxicity(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", held_out: F.Column | None = None, sample: int = 6000, least_rows: int = 3, least: float = 0.5, shrink: float = 10.0, margin: float | None = None, folds: int = 5) -> DataFrame:
    """doc_id and score (0 to 1) of every row.

    ``held_out``: a condition on labels' rows that must not be learned from. A feature counts
    if at least ``least_rows`` toxic documents of the sample have it and its smoothed
    probability (``shrink`` rows of the prior are added) is at least ``least``.
    ``margin``: log odds that the evidence must show beyond the prior's, against words that
    merely chanced to be in toxic documents of the sample. Unless given it is the least of
    ``MARGINS`` with the fewest errors when each of ``folds`` parts of the sample, dealt by a
    hash of the id, is scored by weights learned from the others; clean rows count as often as
    the labels have them. Held-out labels play no part in it.
    """
    spark = docs.sparkSession
    counts = np.zeros(_SYMBOLS**3, np.int64)
    schema = pa.schema([("i", pa.int32()), ("n", pa.int64())])
    gathered = docs.select(F.col(text_col).cast("binary")).mapInArrow(_trigrams(schema), "i int, n long")
    for r in gathered.groupBy("i").agg(F.sum("n").alias("n")).collect():  # at most 28 ** 3 rows
        counts[r.i] = r.n
    log_p = language_model(counts)

    usable = labels.where(~held_out) if held_out is not None else labels
    usable = usable.select(F.col(id_col).cast("long").alias("id"), (F.col(label_col) > 0).alias("toxic")).dropna()
    shares = usable.agg(F.avg(F.col("toxic").cast("double"))).first()[0]
    drawn = {r["id"]: r["toxic"] for x in (False, True) for r in usable.where(F.col("toxic") == x).orderBy(F.xxhash64("id"), "id").limit(sample).collect()}
    prior = min(0.4, max(1e-4, shares or 0.0))
    start = math.log(prior / (1 - prior))
    weights: dict[str, float] = {}
    if any(drawn.values()):
        # at most sample rows a label
        ids = spark.createDataFrame([(i, t, _fold(i, folds)) for i, t in drawn.items()], "id long, toxic boolean, fold int")
        rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).join(F.broadcast(ids), "id")
        schema = pa.schema([("f", pa.string()), ("fold", pa.int32()), ("n", pa.int64()), ("toxic", pa.int64())])
        counted = rows.select("text", "toxic", "fold").mapInArrow(_labelled(log_p, schema), "f string, fold int, n long, toxic long").groupBy("f", "fold").agg(F.sum("n").alias("n"), F.sum("toxic").alias("toxic"))
        # clean rows are thinner in the sample than in the labels: weigh them back
        n_toxic = sum(drawn.values())
        lift = max(1.0, (1 - prior) / max(prior, 1e-9) * n_toxic / max(1, len(drawn) - n_toxic))
        bar = max(least, 1.5 * prior)
        chance = lambda n, toxic: (toxic + shrink * prior) / (toxic + (n - toxic) * lift + shrink)
        many = counted.groupBy("f").agg(F.sum("n").alias("n"), F.sum("toxic").alias("toxic"), F.collect_list(F.struct("fold", "n", "toxic")).alias("parts")).where(F.col("toxic") >= least_rows)
        # those that count with all folds or without one of them; bounded by the sample
        counts_without = F.exists("parts", lambda x: chance(F.col("n") - x["n"], F.col("toxic") - x["toxic"]) >= bar)
        found = many.where((chance(F.col("n"), F.col("toxic")) >= bar) | counts_without).collect()

        def learned(left_out: int | None) -> dict[str, float]:
            out = {}
            for r in found:
                n, toxic = r.n, r.toxic
                for x in r.parts:
                    if x.fold == left_out:
                        n, toxic = n - x.n, toxic - x.toxic
                p = chance(n, toxic)
                if toxic >= least_rows and p >= bar:
                    out[r.f] = math.log(p / (1 - p)) - start
            return out

        weights = learned(None)
        if margin is None:
            parts = [learned(k) for k in range(folds)]
            schema = pa.schema([("toxic", pa.bool_()), ("z", pa.float64())])
            tried = rows.select("text", "toxic", "fold").mapInArrow(_tried(log_p, parts, start, schema), "toxic boolean, z double").collect()  # a row a sampled document
            errors = lambda m: sum((0 if r.z >= m else 1) if r.toxic else (lift if r.z >= m else 0) for r in tried)
            margin = min(MARGINS, key=lambda m: (errors(m), m))
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])
    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(_scores(log_p, weights, start - (margin or 0.0), schema), "doc_id long, score double")
