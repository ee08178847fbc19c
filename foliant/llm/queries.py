"""Queries of the training-data operators, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from foliant.llm import url_filter
from foliant.llm.common import table


def op1_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    from foliant.llm.topk import top_k

    return top_k(table(spark, sf_dir, "embeddings"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from foliant.llm.packing import pack_documents

    path = public_tokenizers.path
    return pack_documents(table(spark, sf_dir, "documents"), path("byte_bpe_50k.json"), path("byte_bpe_50k.tiktoken"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from foliant.llm.quality import rate_documents, train

    docs = table(spark, sf_dir, "documents")
    rated = rate_documents(docs, train(docs, table(spark, sf_dir, "labels")))
    tail = F.coalesce(F.get("tails", F.lit(0)), F.lit(0.0))
    return rated.select("doc_id", "expected_grade", tail.alias("tail_probability"), (tail >= 0.5).alias("selected"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from foliant.llm.decontamination import contamination_digest, find_contamination

    return contamination_digest(find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from foliant.llm.url_filter import judge_urls

    return judge_urls(table(spark, sf_dir, "pages"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from foliant.llm.license_scan import scan_licenses

    return scan_licenses(table(spark, sf_dir, "documents"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from foliant.llm.language_id import identify_languages

    found = identify_languages(table(spark, sf_dir, "documents"))
    return found.select("row.doc_id", "language", "confidence", (~F.col("rejected")).alias("kept"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from foliant.llm.toxicity import score_toxicity

    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    found = score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), held_out=held_out)
    return found.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op9_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from foliant.llm.near_dedup import near_duplicate_groups

    return near_duplicate_groups(table(spark, sf_dir, "documents")).drop("component")


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from foliant.llm.suffix_dedup import repeated_spans

    found = repeated_spans(table(spark, sf_dir, "documents"), passage=200)
    spans, passages = (F.size(c).cast("long").alias(f"n_{c}") for c in ("spans", "passages"))
    return found.select("doc_id", "n_bytes", "n_removed", spans, "kept_sha256", "n_passage", passages)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from foliant.llm.filter_audit import words
    from foliant.llm.periodic_runs import periodic_runs

    c = F.col
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.crc32(c("doc_id").cast("string")).alias("h")).withColumn("w", F.when(c("h") % 10 == 0, words(c("text"))))
    docs = docs.withColumns({"n": F.size("w").cast("long"), "g": F.floor(c("h") / 10)})
    docs = docs.withColumn("a", F.when(c("n") > 0, c("g") % c("n"))).withColumn("p", 1 + F.floor((c("n") - c("a")) / (3 + c("g") % 8)))
    again = F.flatten(F.array_repeat(F.slice("w", c("a").cast("int") + 1, c("p").cast("int")), F.ceil((c("n") - c("a")) / c("p")).cast("int")))
    tiled = F.concat(F.slice("w", F.lit(1), c("a").cast("int")), F.slice(again, F.lit(1), (c("n") - c("a")).cast("int")))
    planted = docs.select("doc_id", F.when(c("n") > 0, F.array_join(tiled, " ")).otherwise(c("text")).alias("text"))
    found = periodic_runs(planted)
    listed = F.concat_ws("", F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], F.concat(r["period"], F.lit("\n")))))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "strongest.start", "strongest.length", "strongest.period", F.floor(1000 * c("strongest.length") / c("strongest.period")).cast("long").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    from foliant.llm.filter_audit import audit, text_filters

    return audit(text_filters(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")), "part", [*"ABCDE"], ["good", "toxic"])


def op13_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from foliant.llm.jaccard_join import similar_groups

    return similar_groups(table(spark, sf_dir, "documents")).drop("component")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_exact_topk, op2_packing, op3_quality, op4_decontamination, op5_url_filter, op6_license_scan, op7_language_id, op8_toxicity, op9_minhash_dedup, op10_suffix_dedup, op11_periodic_runs, op12_filter_audit, op13_jaccard_join)
}

ORACLE_SQL: dict[str, str] = {
    "op5_url_filter": url_filter.SQL,
    "op1_exact_topk": """
        WITH v AS (
            SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
        ), s AS (
            SELECT q.vec_id AS query_id, c.vec_id,
                   CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) AS BIGINT) AS score
            FROM v q, v c WHERE q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id
        ), r AS (
            SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s
        )
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
    """,
    "op4_decontamination": r"""
        WITH d AS (
            SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
        ), b AS (
            SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
        ), p AS (
            SELECT DISTINCT item_id, least(len(w), 10) AS m, w[i : i + least(len(w), 10) - 1] AS win
            FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0)
        ), l AS (SELECT DISTINCT m FROM p), dw AS (
            SELECT doc_id, i, m, w[i : i + m - 1] AS win
            FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM d, l WHERE len(w) >= m)
        ), hit AS (
            SELECT doc_id, i, dw.m, item_id FROM dw JOIN p ON p.m = dw.m AND p.win = dw.win
        ), words AS (
            SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + m)) AS k FROM hit) GROUP BY doc_id
        ), items AS (
            SELECT doc_id, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
            FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY doc_id
        )
        SELECT d.doc_id, CAST(coalesce(len(d.w), 0) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
               CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
    """,
    "op9_minhash_dedup": r"""
        WITH RECURSIVE d AS (
            SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
        ), s AS MATERIALIZED (
            SELECT DISTINCT doc_id, hash(w[i : i + least(len(w), 5) - 1]) AS h
            FROM (SELECT doc_id, w, unnest(range(1, len(w) - least(len(w), 5) + 2)) AS i FROM d WHERE len(w) > 0)
        ), n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id), e AS MATERIALIZED (
            SELECT x.a, x.b FROM (
                SELECT p.doc_id AS a, q.doc_id AS b, count(*) AS c FROM s p JOIN s q ON p.h = q.h AND p.doc_id <> q.doc_id GROUP BY ALL
            ) x JOIN n na ON na.doc_id = x.a JOIN n nb ON nb.doc_id = x.b WHERE 100 * x.c >= 85 * (na.n + nb.n - x.c)
        ), r AS (
            SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT r.a, e.b FROM r JOIN e ON e.a = r.b
        ), c AS (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a)
        SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept FROM c LEFT JOIN n USING (doc_id)
    """,
    "op12_filter_audit": r"""
        WITH t AS (
            SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS x FROM documents
        ), w AS (
            SELECT *, regexp_extract_all(x, '[^\x20\x09-\x0D]+') AS w, min(doc_id) OVER (PARTITION BY x) AS first FROM t
        ), l AS (
            SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id
        ), d AS (
            SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
                   [len(w) < 50, 100 * len(list_distinct(w)) < 65 * len(w), 100 * len(regexp_extract_all(x, '[A-Z]')) > 5 * length(x),
                    regexp_matches(x, '[#$%&*|]'), coalesce(w.doc_id > first, false)] AS f
            FROM w LEFT JOIN l USING (doc_id)
        ), m AS (
            SELECT part, f, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM d GROUP BY part, f
        ), i AS (SELECT unnest([1, 2, 3, 4, 5]) AS i), o AS (
            SELECT [a.i, b.i, c.i, d.i, e.i] AS o FROM i a, i b, i c, i d, i e WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5
        ), s AS (
            SELECT part, o, s.i AS step, n, good, toxic, f[o[s.i]] AS fails, coalesce(list_position(list_transform(o, lambda k: f[k]), true), 6) AS gone,
                   len(list_filter(f, lambda x: x)) AS many
            FROM m, o, i s
        ), r AS (
            SELECT part, o, step, o[step] AS k, sum(n) FILTER (gone > step) AS kept, sum(n) FILTER (gone = step) AS removed, sum(n) FILTER (fails AND gone < step) AS redundant,
                   sum(n) FILTER (fails AND many = 1) AS unique_fails, sum(good) FILTER (gone = step) AS good_lost, sum(toxic) FILTER (gone = step) AS toxic_lost
            FROM s GROUP BY part, o, step
        )
        SELECT part, list_aggregate(list_transform(o, lambda k: substr('ABCDE', k, 1)), 'string_agg', '') AS filter_order, CAST(step AS INTEGER) AS step,
               CAST(coalesce(kept, 0) AS BIGINT) AS kept, CAST(coalesce(removed, 0) AS BIGINT) AS removed, CAST(coalesce(redundant, 0) AS BIGINT) AS redundant,
               CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails, CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost, CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
               CAST(coalesce(sum(removed) OVER (PARTITION BY part, k), 0) AS BIGINT) AS shapley
        FROM r
    """,
}

_PAIRS = ORACLE_SQL["op9_minhash_dedup"].replace("85 *", "80 *")
ORACLE_SQL["op13_jaccard_join"] = _PAIRS.replace("component_id, doc_id = component_id AS kept", "component_id")
