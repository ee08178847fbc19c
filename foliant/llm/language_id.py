"""Operator 7: language identification by Bayesian fusion of several kinds of evidence.

The posterior of a language is the product of

* the likelihood of the text's hashed byte trigrams under the language, tempered because
  neighbouring trigrams are not independent. Counts cover all documents, by declared language;
* the declared (markup) language: right with ``trust``, else any other;
* the address suffix, where given, in the same way;
* the host's prior: shares of declared languages of its documents, smoothed towards the
  shares of all documents, by grouped aggregation.

Languages are all declared values, however rare. They are counted and scored in shards of
``shard`` languages: a shard takes 2 ** bits numbers a language on the driver and in each
worker, and only the shares of the languages are held for all. A document is rejected if it
has no letters or if no language reaches ``confidence``.

Defined results: null or empty text, or text without letters, is rejected (language null).
Null or unknown declared values, suffixes and hosts give no evidence. With no languages at
all every document is rejected. Repeated rows are rows of their own. Empty tables give no
rows. All columns of a document pass through inside ``row``. A text must fit a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliant.llm.common import written
from foliant.llm.grams import gram_counts

_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def _counted(bits: int, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 1024):
                part, total = batch.slice(at, 1024), {}
                for lang, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    total[lang] = total.get(lang, 0) + gram_counts(text, bits)
                rows = [(lang, i, x[i]) for lang, x in total.items() for i in np.flatnonzero(x)]
                yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], t.type) for j, t in enumerate(schema)], schema=schema)

    return run


def _fused(bits: int, log_p: np.ndarray, first: int, langs: list[str], shares: np.ndarray, temper: float, trust: float, strength: float, columns: dict[str, int | str]):
    """Scores of the languages from ``first`` on, added to those of the shards before: the
    largest score, the sum of exponents below it and the index of its language."""
    here = {x: i for i, x in enumerate(langs)}
    yes, no = float(np.log(trust)), float(np.log((1 - trust) / max(1, len(langs) - 1)))
    n_here, log_share = log_p.shape[1], np.log(shares)

    def of(part: pa.RecordBatch, what: str) -> pa.Array:
        at = columns[what]
        return part.column("row").field(at) if isinstance(at, int) else part.column(at)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 64):
                part = batch.slice(at, 64)
                texts = [t.encode() if t else b"" for t in of(part, "text").to_pylist()]
                scores = temper * (np.array([gram_counts(t, bits) for t in texts], float) @ log_p)
                prior = np.repeat(log_share[None, first : first + n_here], len(texts), 0)
                if "which" in part.schema.names:
                    for row, (which, many) in enumerate(zip(part.column("which").to_pylist(), part.column("many").to_pylist(), strict=True)):
                        if which is not None:
                            n = np.zeros(n_here)
                            for i, k in zip(which, many, strict=True):
                                if first <= i < first + n_here:
                                    n[i - first] = k
                            prior[row] = np.log((n + strength * shares[first : first + n_here]) / (sum(many) + strength))
                scores += prior
                for said in ("declared", "suffix"):
                    if said in columns:
                        for row, x in enumerate(of(part, said).to_pylist()):
                            if (i := here.get(x)) is not None:
                                scores[row] += no
                                if first <= i < first + n_here:
                                    scores[row, i - first] += yes - no
                best = scores.argmax(1)
                top = scores[np.arange(len(texts)), best]
                total, best = np.exp(scores - top[:, None]).sum(1), best + first
                if first:
                    top0, total0, best0 = (part.column(c).to_numpy(zero_copy_only=False) for c in ("top", "total", "best"))
                    high = np.maximum(top, top0)
                    total = total * np.exp(top - high) + total0 * np.exp(top0 - high)
                    best, top = np.where(top > top0, best, best0), high
                letters = [bool(_LETTER[np.frombuffer(t, np.uint8)].any()) for t in texts]
                kept = [c for c in part.schema.names if c not in ("top", "total", "best", "letters")]
                made = {"top": pa.array(top, pa.float64()), "total": pa.array(total, pa.float64()), "best": pa.array(best, pa.int32()), "letters": pa.array(letters, pa.bool_())}
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), *made.values()], names=[*kept, *made])

    return run


def identify_languages(
    docs: DataFrame,
    *,
    text_col: str = "text",
    declared_col: str = "lang",
    host_col: str | None = "source",
    suffix_col: str | None = None,
    bits: int = 13,
    temper: float = 0.1,
    trust: float = 0.9,
    host_strength: float = 20.0,
    shard: int = 512,
    confidence: float = 0.6,
    broadcast_hosts: int = 50_000,
    spread: int = 32,
) -> DataFrame:
    """row (the document, all its columns as one struct, whatever their names), language (null if
    rejected), confidence and rejected. Of equally likely languages the first by name counts.

    Without ``suffix_col`` the address suffix is what follows the host's last dot, if that is a
    declared language. ``broadcast_hosts``: up to so many hosts' priors are broadcast; more meet
    their documents by a shuffle, each host in ``spread`` places.
    """
    whole = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    field = lambda c: F.col("row").getField(c)
    known = docs.where(F.col(declared_col).isNotNull()).select(F.col(declared_col).alias("lang"), F.col(text_col).cast("binary").alias("text"), *([F.col(host_col).alias("host")] if host_col else []))
    found = {r.lang: r.n for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row a language
    langs = sorted(found)
    if not langs:
        return whole.select("row", F.lit(None).cast("string").alias("language"), F.lit(0.0).alias("confidence"), F.lit(True).alias("rejected"))
    shares = np.array([found[x] for x in langs], float) / sum(found.values())
    numbers = docs.sparkSession.createDataFrame(list(enumerate(langs)), "i int, lang string")
    # where a document's evidence stands: a field of the row, or a column of its own
    columns: dict[str, int | str] = {"text": docs.columns.index(text_col), "declared": docs.columns.index(declared_col)} | ({"suffix": docs.columns.index(suffix_col)} if suffix_col else {})
    out = whole
    if host_col:
        each = known.where("host IS NOT NULL").groupBy("host", "lang").agg(F.count(F.lit(1)).alias("n"))
        each = each.join(F.broadcast(numbers), "lang").groupBy("host").agg(F.collect_list(F.struct("i", "n")).alias("x"))
        hosts = each.select("host", F.col("x.i").alias("which"), F.col("x.n").alias("many"))
        if hosts.count() <= broadcast_hosts:
            out = out.join(F.broadcast(hosts), field(host_col) == F.col("host"), "left").drop("host")
        else:  # a host's documents meet its prior in several places
            hosts = hosts.withColumn("place", F.explode(F.sequence(F.lit(0), F.lit(spread - 1))))
            place = F.pmod(F.xxhash64(field(text_col)), F.lit(spread)).cast("int")
            out = out.join(hosts, (field(host_col) == F.col("host")) & (place == F.col("place")), "left").drop("host", "place")
        if not suffix_col:
            out = out.withColumn("suffix", F.nullif(F.regexp_extract(F.lower(field(host_col)), r"\.([a-z]+)\.?$", 1), F.lit("")))
            columns["suffix"] = "suffix"
    schema = pa.schema([("lang", pa.string()), ("bin", pa.int32()), ("n", pa.int64())])
    made = (("top", T.DoubleType()), ("total", T.DoubleType()), ("best", T.IntegerType()), ("letters", T.BooleanType()))
    fields = T.StructType([*out.schema.fields, *(T.StructField(c, t) for c, t in made)])
    for first in range(0, len(langs), shard):
        part = langs[first : first + shard]
        within = known.where(F.col("lang").between(part[0], part[-1])) if len(langs) > shard else known
        counts = np.full((1 << bits, len(part)), 0.5)
        counted = within.select("lang", "text").mapInArrow(_counted(bits, schema), "lang string, bin int, n long")
        rows = counted.groupBy("lang", "bin").agg(F.sum("n").alias("n")).groupBy("lang").agg(F.collect_list(F.struct("bin", "n")).alias("x")).select("lang", "x.bin", "x.n")
        for r in rows.toLocalIterator():  # 2 ** bits numbers a language at most
            counts[r.bin, part.index(r.lang)] += r.n
        log_p = np.log(counts / counts.sum(0))
        if first:
            out = written(out)  # so that no task holds the tables of two shards
        out = out.mapInArrow(_fused(bits, log_p, first, langs, shares, temper, trust, host_strength, columns), fields)
    sure = F.when(F.col("letters"), 1 / F.col("total")).otherwise(0.0)
    named = out.join(F.broadcast(numbers.withColumnRenamed("i", "best")), "best")
    return named.select("row", F.when(sure >= confidence, F.col("lang")).alias("language"), sure.alias("confidence"), (sure < confidence).alias("rejected"))
