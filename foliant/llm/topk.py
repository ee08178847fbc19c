"""Operator 1: exact top-k inner products by columnar branch and bound.

Components become integers. Candidates lie in vertical layout (one array per dimension, the
dimensions of largest mass first). A query first takes exact scores of a few candidates as
its floor; then scores grow dimension block by dimension block, and after each block only
candidates stay whose score plus the largest possible rest (the product of both remaining
norms) reaches the floor. Whatever survives all blocks has an exact score.

Queries and candidates meet in a grid of blocks, each of bounded size, so no side is
broadcast and no cell grows with the data; the best k of each cell are merged by a window.
The work is queries times candidates by definition of the search.

Defined results: vectors that are null or hold null, NaN or infinite components, and rows of
null id, take no part. Vectors of unequal lengths are compared as if filled with zeros; an
empty vector scores 0 with all. Repeated rows (same id, same vector) count once; of the rows
of one id none is a candidate for that id's query. Scores beyond the range of a long are
clipped to it. Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_EXACT = float(1 << 52)  # integers up to here are exact as doubles
_LONG = (-(1 << 63), (1 << 63) - 1)


def quantised(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(vec_id, v): distinct usable rows, each component floor(scale * x) as a double."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    doubles = F.col(vector_col).cast("array<double>")
    return (
        vectors.select(F.col(id_col).cast("long").alias("vec_id"), doubles.alias("x"))
        .where(F.col("vec_id").isNotNull() & F.col("x").isNotNull() & ~F.exists("x", bad))
        # doubles from 2^52 on are whole and could overflow a long
        .select("vec_id", F.transform("x", lambda v: F.when(F.abs(v * scale) < _EXACT, F.floor(v * scale).cast("double")).otherwise(v * scale)).alias("v"))
        .distinct()
    )


def _matrix(rows: list[np.ndarray], order: np.ndarray) -> np.ndarray:
    """Vertical layout: dimensions by candidates, in the given order of dimensions."""
    out = np.zeros((len(order), len(rows)))
    for j, r in enumerate(rows):
        out[: len(r), j] = r
    return np.ascontiguousarray(out[order])


def search_block(q: np.ndarray, q_ids: np.ndarray, c: np.ndarray, c_ids: np.ndarray, k: int, step: int = 8, seed: int = 64) -> Iterator[tuple[int, int, int]]:
    """(query, candidate, score) of the best k per query; q and c in vertical layout."""
    dims = len(c)
    edges = list(range(0, dims, step)) + [dims]
    rest = lambda m: np.sqrt(np.maximum(0, (m * m).sum(0) - np.vstack([np.zeros(m.shape[1]), np.cumsum(m * m, 0)])))
    exact = float(np.sqrt((q * q).sum(0).max(initial=0)) * np.sqrt((c * c).sum(0).max(initial=0))) < _EXACT
    q_rest, c_rest = (rest(q), rest(c)) if exact else (None, None)
    for i in range(q.shape[1]):
        if not exact:  # scores that doubles can't hold: whole integers, no bounds
            a = [int(x) for x in q[:, i]]
            best = sorted((-sum(x * int(y) for x, y in zip(a, c[:, j], strict=True)), int(c_ids[j])) for j in range(c.shape[1]) if c_ids[j] != q_ids[i])[:k]
            yield from ((int(q_ids[i]), n, min(max(-s, _LONG[0]), _LONG[1])) for s, n in best)
            continue
        alive = np.flatnonzero(c_ids != q_ids[i])
        first = alive[:: max(1, len(alive) // seed)]
        sample = q[:, i] @ c[:, first]
        floor = np.partition(sample, len(sample) - k)[len(sample) - k] if len(sample) >= k else -np.inf
        score = np.zeros(len(alive))
        for a, b in zip(edges, edges[1:], strict=False):
            block = c[a:b] if len(alive) == c.shape[1] else c[a:b][:, alive]
            score = score + q[a:b, i] @ block
            if b < dims:
                # a little above the bound: norms are rounded
                stay = score + q_rest[b, i] * c_rest[b, alive] * (1 + 1e-9) + 1e-3 >= floor
                if not stay.all():
                    alive, score = alive[stay], score[stay]
        order = np.lexsort((c_ids[alive], -score))[:k]
        yield from ((int(q_ids[i]), int(c_ids[alive[j]]), int(score[j])) for j in order)


def _cell(order: list[int], k: int, schema: pa.Schema):
    def run(queries: pa.Table, candidates: pa.Table) -> pa.Table:
        out: list[tuple[int, int, int]] = []
        if len(queries) and len(candidates):
            take = lambda t: (_matrix([np.asarray(x, float) for x in t.column("v").to_pylist()], np.asarray(order, int)), t.column("vec_id").to_numpy())
            (q, q_ids), (c, c_ids) = take(queries), take(candidates)
            out = list(search_block(q, q_ids, c, c_ids, k))
        return pa.table([pa.array([r[j] for r in out], pa.int64()) for j in range(3)], schema=schema)

    return run


def top_k(
    vectors: DataFrame,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    every: int = 100,
    k: int = 10,
    scale: int = 1024,
    query_block: int = 8192,
    candidate_block: int = 8192,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k best candidates of each row whose id is divisible
    by ``every``. Block sizes bound what one task holds."""
    v = quantised(vectors, id_col, vector_col, scale)
    mass = v.select("vec_id", F.posexplode("v").alias("d", "x")).groupBy("d").agg(F.sum(F.col("x") * F.col("x")).alias("m"), F.count(F.lit(1)).alias("n")).collect()
    n = max([0, *(r.n for r in mass)])
    order = [r.d for r in sorted(mass, key=lambda r: (-r.m, r.d))]
    width = max(order, default=-1) + 1
    order += [d for d in range(width) if d not in set(order)]
    shuffle = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = max(1, -(-n // candidate_block), min(shuffle, -(-n // 512)))
    columns = max(1, -(-n // (every * query_block)))
    block = lambda salt, parts: F.pmod(F.xxhash64("vec_id", F.lit(salt)), F.lit(parts)).cast("int")
    spread = lambda parts: F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    queries = v.where(F.col("vec_id") % every == 0).select("vec_id", "v", block("q", columns).alias("qb"), spread(rows).alias("cb"))
    candidates = v.select("vec_id", "v", block("c", rows).alias("cb"), spread(columns).alias("qb"))
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])
    found = queries.groupBy("qb", "cb").cogroup(candidates.groupBy("qb", "cb")).applyInArrow(_cell(order, k, schema), "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
