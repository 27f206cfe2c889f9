"""Queries of entity resolution: keys, pairs, components, merging."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import resolve
from .registry import query, read


@query("""WITH RECURSIVE n AS (SELECT doc_id, ['t' || sha256(text), 's' || source || n_chars::VARCHAR] AS keys, row_number() OVER (ORDER BY doc_id) AS i FROM documents),
 walk(i, doc_id, kept, seen) AS (SELECT 0::BIGINT, NULL::BIGINT, false, (SELECT coalesce(list('t' || sha256(text)), []) FROM benchmark)
 UNION ALL SELECT n.i, n.doc_id, NOT list_has_any(w.seen, n.keys), CASE WHEN list_has_any(w.seen, n.keys) THEN w.seen ELSE list_concat(w.seen, n.keys) END FROM walk w JOIN n ON n.i = w.i + 1)
 SELECT doc_id FROM walk WHERE kept""")
def multi_key_dedup(spark, d) -> DataFrame:
    docs = read(spark, d, "documents")
    digest = lambda c: F.concat(F.lit("t"), F.sha2(c.cast("binary"), 256))
    keys = docs.select("doc_id", digest(F.col("text")).alias("k1"), F.concat(F.lit("s"), "source", F.col("n_chars").cast("string")).alias("k2"))
    known = read(spark, d, "benchmark").select(digest(F.col("text")))
    return resolve.first_of_any_key(keys, [F.col("k1"), F.col("k2")], "doc_id", known).select("doc_id")


_EDGES = """SELECT a, doc_id AS b, 'same_text' AS reason FROM (SELECT doc_id, min(doc_id) OVER (PARTITION BY sha256(text)) AS a FROM documents) WHERE a < doc_id
 UNION ALL SELECT a, doc_id, 'same_shape' FROM (SELECT doc_id, min(doc_id) OVER (PARTITION BY lang, n_chars, left(text, 24)) AS a FROM documents) WHERE a < doc_id"""


def _edges(spark, d) -> DataFrame:
    docs = read(spark, d, "documents").withColumn("block", F.lit("all"))
    keys = {"same_text": F.sha2(F.col("text").cast("binary"), 256), "same_shape": F.concat_ws("|", "lang", "n_chars", F.left("text", F.lit(24)))}
    return resolve.evidence_edges(docs, keys, "doc_id", ["block"])


@query(_EDGES)
def pair_match(spark, d) -> DataFrame:
    return _edges(spark, d)


_COMPONENTS = f"""WITH RECURSIVE e AS (SELECT a, b FROM ({_EDGES}) UNION SELECT b, a FROM ({_EDGES})), walk(v, r) AS (SELECT a, a FROM e UNION SELECT w.v, e.b FROM walk w JOIN e ON e.a = w.r)
 SELECT v, min(r) AS component FROM walk GROUP BY v"""


@query(_COMPONENTS)
def connected_components(spark, d) -> DataFrame:
    return resolve.connected_components(_edges(spark, d))


@query(f"SELECT count(*) AS clusters, sum(n)::BIGINT AS members, max(n) AS largest FROM (SELECT component, count(*) AS n FROM ({_COMPONENTS}) GROUP BY component)")
def dedup_audit(spark, d) -> DataFrame:
    c = resolve.connected_components(_edges(spark, d)).groupBy("component").agg(F.count("*").alias("n"))
    return c.agg(F.count("*").alias("clusters"), F.sum("n").alias("members"), F.max("n").alias("largest"))


@query("SELECT lang, doc_id, source, n_chars FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n_chars DESC, source DESC, doc_id DESC) AS k FROM documents) WHERE k = 1")
def representative_pick(spark, d) -> DataFrame:
    return resolve.best_by(read(spark, d, "documents").select("lang", "doc_id", "source", "n_chars"), ["lang"], [F.col("n_chars"), F.col("source"), F.col("doc_id")])


@query("""SELECT user_id, arg_max(event_type, (ts, event_id)) AS event_type, array_to_string(list_sort(list(DISTINCT event_type)), ',') AS tags, count(*) AS merged_source_count FROM events GROUP BY user_id""")
def merge_members(spark, d) -> DataFrame:
    e = read(spark, d, "events").withColumn("tags", F.array("event_type"))
    out = resolve.merge_members(e, "user_id", [F.col("ts"), F.col("event_id")], ["event_type"], ["tags"], ["event_type"])
    return out.select("user_id", "event_type", F.array_join("tags", ",").alias("tags"), "merged_source_count")
