"""Queries of operators that take keys of any size, on the driver's whole tables, with SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.functions.json import json_key
from foliant.functions.text import normalise_space
from foliant.operators.clauses import section_windows
from foliant.operators.quotes import validate_items
from foliant.operators.scan import islands_of


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quote_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quotes out of whole turns that end in every tier: changed letters (fuzzy_match), what all
    turns of a conversation hold (verified, ties), half of a quote that no turn has, cited
    (weak_match) or not (unverified), and quotes across two turns (verified by a run)."""
    c, w = F.col, F.lit
    letters = F.regexp_replace(F.lower(normalise_space(c("text"))), "[^a-z]", "_")
    turns = _t(spark, sf_dir, "conversations").select("conv_id", "turn", F.lpad(c("turn").cast("string"), 3, "0").alias("clause_id"), F.concat(w("t"), c("turn"), w("-"), letters, w("."), c("conv_id")).alias("clause_text"))
    after = turns.select("conv_id", (c("turn") - 1).alias("turn"), F.substring(c("clause_text"), w(1), F.least(w(25), F.length("clause_text") - 1)).alias("after"))
    kind = F.pmod(c("turn") + c("conv_id"), w(5))
    hit = lambda x, at: F.concat(F.substring(x, 1, at - 1), w("#"), F.substring(x, at + 1, 50))
    half = F.concat(F.substring("clause_text", 1, 20), w("#" * 20))
    # as much of both turns, and neither whole: a turn that a quote holds would be its match
    across = F.concat(F.right(c("clause_text"), F.length("after")), w(" "), c("after"))
    quote = F.when(kind == 0, hit(hit(hit(hit(F.substring("clause_text", 1, 50), 4), 6), 8), 10)).when(kind == 1, F.concat(w("."), c("conv_id"))).when(kind == 4, across).otherwise(half)
    long = F.length("clause_text") >= 60
    items = turns.join(after, ["conv_id", "turn"], "left").where(long & ((kind != 4) | c("after").isNotNull())).select("conv_id", "turn", quote.alias("exact_quote"), F.when(kind == 2, F.array("clause_id")).alias("supporting_clause_ids"))
    clauses = turns.select("conv_id", "turn", "clause_id", "clause_text", c("turn").alias("page_start"), c("turn").alias("page_end"), w(None).cast("array<double>").alias("bbox"))
    found = validate_items(items, clauses, ["conv_id"], order=["turn"])
    return found.select("conv_id", "turn", F.col("validation_status").alias("status"), F.col("quote_match_score").alias("score"), F.array_join("matched_clause_ids", ",").alias("ids"))


def source_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows over all lines of a source's documents: sections of any number of clauses."""
    lines = _t(spark, sf_dir, "documents").select(F.coalesce("source", F.lit("")).alias("source"), "doc_id", F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("line", "t"))
    found = section_windows(lines, ["source"], ["doc_id", "line"], "t", most=400)
    return found.select("source", F.col("window_index").cast("long").alias("place"), F.col("start").cast("long").alias("first"), F.col("end").cast("long").alias("last"), F.col("n_words").cast("long").alias("n_words"), F.sha2("context_text", 256).alias("text_sha"))


def event_stretches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of neighbouring events of one user type inside each event type, over all days: a
    few keys hold all rows."""
    e = _t(spark, sf_dir, "events").select("event_type", "event_id", "ts", F.pmod("user_id", F.lit(3)).alias("kind"))
    found = islands_of(e, ["event_type"], ["ts", "event_id"], F.col("kind") == F.col("prev.kind"))
    return found.groupBy("event_type", "island").agg(F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first_id"), F.max("event_id").alias("last_id"))


def json_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of whole conversations as nested values, by their JSON with sorted names."""
    turn = F.struct("turn", "role", "text")
    talks = _t(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    value = F.struct("turns", F.col("conv_id").alias("id"), F.struct(F.size("turns").alias("n"), F.lit(True).alias("all")).alias("about"))
    rows = talks.select("conv_id", value.alias("v"))
    return rows.select("conv_id", json_key(F.col("v"), rows.schema["v"].dataType).alias("key"))


QUERIES = {f.__name__: f for f in (quote_tiers, source_windows, event_stretches, json_keys)}

_NORM = r"trim(regexp_replace(replace(coalesce({0}, ''), chr(173), ''), '[\s\p{{Z}}\x0B]+', ' ', 'g'))"

ORACLE_SQL = {
    "quote_tiers": f"""WITH c AS (
            SELECT conv_id, turn, lpad(CAST(turn AS VARCHAR), 3, '0') AS id, 't' || turn || '-' || regexp_replace(lower({_NORM.format("text")}), '[^a-z]', '_', 'g') || '.' || conv_id AS t,
                   row_number() OVER w - 1 AS i, lead(turn) OVER w = turn + 1 AS follows, (turn + conv_id) % 5 AS kind
            FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)
        )
        SELECT c.conv_id, c.turn, CASE kind WHEN 0 THEN 'fuzzy_match' WHEN 2 THEN 'weak_match' WHEN 3 THEN 'unverified' ELSE 'verified' END AS status,
               CASE kind WHEN 0 THEN 0.92 WHEN 2 THEN 0.5 WHEN 3 THEN 0.5 ELSE 1.0 END::DOUBLE AS score,
               CASE kind WHEN 1 THEN (SELECT string_agg(a.id, ',' ORDER BY a.i) FROM c a WHERE a.conv_id = c.conv_id)
                    WHEN 4 THEN (SELECT string_agg(a.id, ',' ORDER BY a.i) FROM c a WHERE a.conv_id = c.conv_id AND a.i BETWEEN greatest(c.i - 1, 0) AND greatest(c.i - 1, 0) + 2) ELSE c.id END AS ids
        FROM c WHERE length(t) >= 60 AND (kind <> 4 OR coalesce(follows, false))""",
    "source_windows": r"""WITH RECURSIVE l AS (
            SELECT coalesce(source, '') AS source, doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS t, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS line FROM documents
        ), r AS MATERIALIZED (
            SELECT source, row_number() OVER w - 1 AS i, t, len(list_filter(regexp_split_to_array(t, '[\s\p{Z}\x0B]+'), lambda x: x <> '')) AS w
            FROM l WHERE trim(t) <> '' WINDOW w AS (PARTITION BY source ORDER BY doc_id, line)
        ), u AS MATERIALIZED (SELECT *, sum(w) OVER (PARTITION BY source ORDER BY i) AS upto FROM r),
        n AS (SELECT source, count(*) AS n, max(upto) AS total FROM u GROUP BY source),
        e AS MATERIALIZED (
            SELECT a.source, a.i AS s, greatest(a.i + 1, coalesce(b.i + 1, 0)) AS e FROM u a ASOF LEFT JOIN u b ON a.source = b.source AND a.upto - a.w + 400 >= b.upto
        ), c AS (
            SELECT n.source, 0 AS k, CAST(0 AS BIGINT) AS s, CASE WHEN total <= 400 THEN n ELSE e.e END AS e, CASE WHEN total <= 400 THEN n ELSE greatest(1, e.e - 2) END AS nx, n FROM n JOIN e ON e.source = n.source AND e.s = 0
            UNION ALL SELECT c.source, k + 1, e.s, e.e, greatest(e.s + 1, e.e - 2), n FROM c JOIN e ON e.source = c.source AND e.s = c.nx WHERE c.nx < n AND k < 200
        )
        SELECT c.source, CAST(k AS BIGINT) AS place, CAST(c.s AS BIGINT) AS "first", CAST(c.e AS BIGINT) AS "last", CAST(sum(u.w) AS BIGINT) AS n_words, sha256(string_agg(u.t, chr(10) || chr(10) ORDER BY u.i)) AS text_sha
        FROM c JOIN u ON u.source = c.source AND u.i >= c.s AND u.i < c.e GROUP BY c.source, k, c.s, c.e""",
    "event_stretches": """WITH p AS (SELECT event_type, event_id, ts, CASE WHEN lag(user_id % 3) OVER w = user_id % 3 THEN 0 ELSE 1 END AS b FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id)),
        i AS (SELECT *, CAST(sum(b) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS BIGINT) AS island FROM p)
        SELECT event_type, island, count(*) AS n, min(event_id) AS first_id, max(event_id) AS last_id FROM i GROUP BY event_type, island""",
    "json_keys": """SELECT conv_id, substr(sha256('{"about": {"all": true, "n": ' || count(*) || '}, "id": ' || conv_id || ', "turns": ['
            || string_agg('{"role": ' || coalesce(CAST(to_json(role) AS VARCHAR), 'null') || ', "text": ' || coalesce(CAST(to_json(text) AS VARCHAR), 'null') || ', "turn": ' || turn || '}', ', ' ORDER BY turn) || ']}'), 1, 24) AS key
        FROM conversations GROUP BY conv_id""",
}
