"""Queries of row operators: normalization, filters, decision lists, scores, times."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import times
from ..operators import graph, ontology, quality, rank, recurrence, rules, scoring
from ..operators.durable import Rounds
from ..sources import readers
from .registry import query, read

#: Our own small vocabularies, for the words that the tables have.
TERMS = {"specific": ["license", "copyright"], "generic": ["contact", "call"], "action": ["the", "und"], "access": ["@", "http"], "attend": ["please"], "recruit": ["apply"], "deadline": ["until"], "world": ["buy now"], "product": ["cheap"], "giveaway": ["free"]}
CATEGORIES = [
    {"id": "english", "priority": 30, "strong_keywords": ["the ", " and "], "keywords": ["tion", "ing"]},
    {"id": "german", "priority": 20, "strong_keywords": [" und ", "der "], "keywords": ["ung", "keit"]},
    {"id": "french", "priority": 10, "strong_keywords": [" les ", "que "], "keywords": ["eau", "ment"]},
    {"id": "spanish", "priority": 10, "strong_keywords": [" los ", "ción"], "keywords": ["que", "mente"]},
]
VOCABULARY = ["tion", "idiot", "license", "ung", "eau", "nowhere-at-all"]


@query("SELECT doc_id, trim(regexp_replace(text, '[\\s\\x{3000}]+', ' ', 'g')) AS cleaned FROM documents")
def clean_text(spark, d) -> DataFrame:
    return read(spark, d, "documents").select("doc_id", T.clean_text(F.col("text")).alias("cleaned"))


@query("SELECT doc_id, substr(sha256(source || ':' || doc_id::VARCHAR), 1, 20) AS id FROM documents")
def event_identity(spark, d) -> DataFrame:
    n = F.lit(None).cast("string")
    return read(spark, d, "documents").select("doc_id", T.event_identity(F.col("source"), F.col("doc_id").cast("string"), n, n, n, n).alias("id"))


@query("SELECT page_id, 'src_' || substr(sha256('pages|source-id|' || page_id::VARCHAR), 1, 20) AS record_id FROM pages")
def source_record_id(spark, d) -> DataFrame:
    n = F.lit(None).cast("string")
    return read(spark, d, "pages").select("page_id", T.source_record_id(n, F.lit("pages"), F.col("page_id").cast("string"), F.col("url"), n).alias("record_id"))


_HOST, _PATH, _QUERY = "lower(regexp_extract(url, '^[A-Za-z]+://([^/?#:]*)', 1))", "regexp_extract(url, '^[A-Za-z]+://[^/?#]*([^?#]*)', 1)", "regexp_extract(url, '^[^?#]*\\?([^#]*)', 1)"


@query(f"""SELECT page_id, CASE WHEN url LIKE 'https://%' THEN 'https://' || {_HOST} || rtrim({_PATH}, '/') ||
 CASE WHEN q <> '' THEN '?' || q ELSE '' END END AS canonical FROM
 (SELECT *, array_to_string(list_filter(string_split({_QUERY}, '&'), lambda p: p <> '' AND NOT starts_with(lower(p), 'utm_')), '&') AS q FROM pages)""")
def canonical_url_strict(spark, d) -> DataFrame:
    return read(spark, d, "pages").select("page_id", T.canonical_url_strict(F.col("url")).alias("canonical"))


@query(f"""SELECT page_id, lower(regexp_extract(url, '^([A-Za-z]+)://', 1)) || '://' || {_HOST} || CASE WHEN p = '' THEN '/' ELSE p END ||
 CASE WHEN q <> '' THEN '?' || q ELSE '' END AS canonical FROM (SELECT *, rtrim({_PATH}, '/') AS p, array_to_string(list_filter(string_split({_QUERY}, '&'),
 lambda p: p <> '' AND NOT starts_with(lower(p), 'utm_') AND NOT starts_with(lower(p), 'ref=') AND NOT starts_with(lower(p), 'source=')), '&') AS q FROM pages)""")
def canonical_url_lenient(spark, d) -> DataFrame:
    return read(spark, d, "pages").select("page_id", T.canonical_url_lenient(F.col("url")).alias("canonical"))


@query("""SELECT kind, count(*) AS n FROM (SELECT CASE page_id % 5 WHEN 0 THEN 'community' WHEN 1 THEN 'announcement' WHEN 2 THEN 'related_web' WHEN 3 THEN 'application' ELSE 'official_x' END AS kind FROM pages) GROUP BY kind""")
def link_kind(spark, d) -> DataFrame:
    i = F.col("page_id").cast("string")
    made = F.when(F.col("page_id") % 5 == 0, F.concat(F.lit("https://Discord.gg/a"), i)).when(F.col("page_id") % 5 == 1, F.concat(F.lit("https://x.com/u/status/"), i)).when(F.col("page_id") % 5 == 2, F.col("url")).when(F.col("page_id") % 5 == 3, F.concat(F.lit("https://forms.gle/"), i)).otherwise(F.concat(F.lit("https://twitter.com/u"), i))
    return read(spark, d, "pages").groupBy(T.link_kind(made).alias("kind")).agg(F.count("*").alias("n"))


@query("SELECT event_id, make_timestamp_ms(1288834974657 + event_id * 1000) AS created_at FROM events WHERE event_id > 0")
def snowflake_time(spark, d) -> DataFrame:
    e = read(spark, d, "events").where("event_id > 0")
    return e.select("event_id", times.snowflake_time(F.shiftleft(F.col("event_id") * 1000, 22)).cast("timestamp_ntz").alias("created_at"))


@query("""SELECT band, count(*) AS n FROM (SELECT CASE WHEN h BETWEEN 5 AND 10 THEN '朝' WHEN h BETWEEN 11 AND 16 THEN '昼' WHEN h BETWEEN 17 AND 22 THEN '夜' ELSE '深夜' END AS band
 FROM (SELECT hour(ts + INTERVAL 9 HOUR) AS h FROM events)) GROUP BY band""")
def time_band(spark, d) -> DataFrame:
    return read(spark, d, "events").groupBy(times.time_band(F.col("ts").cast("timestamp")).alias("band")).agg(F.count("*").alias("n"))


@query("SELECT event_id, ts FROM events WHERE CAST(ts + INTERVAL 9 HOUR AS DATE) = DATE '2024-01-15'")
def tonight_jst(spark, d) -> DataFrame:
    at = F.col("ts").cast("timestamp")
    return read(spark, d, "events").where((F.col("ts") >= F.lit("2024-01-14 00:00:00").cast("timestamp_ntz")) & (F.col("ts") < F.lit("2024-01-16 00:00:00").cast("timestamp_ntz"))).where(times.local_date(at) == F.lit("2024-01-15").cast("date")).select("event_id", "ts")


@query("SELECT event_id, ts FROM events WHERE ts BETWEEN TIMESTAMP '2024-01-10 00:00:00' AND TIMESTAMP '2024-01-12 12:00:00'")
def window_filter(spark, d) -> DataFrame:
    return read(spark, d, "events").where(F.col("ts").between(F.lit("2024-01-10 00:00:00").cast("timestamp_ntz"), F.lit("2024-01-12 12:00:00").cast("timestamp_ntz"))).select("event_id", "ts")


@query("SELECT doc_id, lang FROM documents WHERE contains(lower(concat_ws(' ', text, lang, source)), 'license')")
def search_text(spark, d) -> DataFrame:
    return read(spark, d, "documents").where(F.contains(F.lower(F.concat_ws(" ", "text", "lang", "source")), F.lit("license"))).select("doc_id", "lang")


ALIASES = {"red": ["red", "crimson", "ring"], "bolt": ["bolt", "screw"]}


@query("""SELECT DISTINCT a.q AS query, p_partkey FROM part JOIN (VALUES ('red','red'),('red','crimson'),('red','ring'),('bolt','bolt'),('bolt','screw')) a(q, alias) ON contains(lower(p_name), a.alias)""")
def search_alias(spark, d) -> DataFrame:
    wanted = F.array_compact(F.array(*(F.when(T.has_any(F.col("p_name"), v), F.lit(k)) for k, v in ALIASES.items())))
    return read(spark, d, "part").select(F.explode(wanted).alias("query"), "p_partkey")


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 50 OFFSET 100")
def paginate(spark, d) -> DataFrame:
    return rank.page(read(spark, d, "orders").select("o_orderkey", "o_totalprice"), 50, 100, F.desc("o_totalprice"), F.col("o_orderkey"))


@query("SELECT doc_id, (contains(lower(text), 'license') OR contains(lower(text), 'trash') OR contains(lower(text), 'contact')) AS found FROM documents")
def has_any_terms(spark, d) -> DataFrame:
    return read(spark, d, "documents").select("doc_id", T.has_any(F.col("text"), ["license", "trash", "contact"]).alias("found"))


_F = {k: "(" + " OR ".join(f"contains(lower(text), '{t}')" for t in v) + ")" for k, v in TERMS.items()}
_E = f"({_F['specific']} OR ({_F['generic']} AND {_F['action']}) OR ({_F['generic']} AND {_F['attend']}) OR ({_F['action']} AND {_F['access']}) OR ({_F['access']} AND {_F['attend']}))"
_R = f"({_F['recruit']} OR ({_F['deadline']} AND {_F['access']}))"
_WHY = f"""CASE WHEN {_F['giveaway']} AND NOT {_E} THEN 'giveaway_only' WHEN {_F['product']} AND NOT {_E} AND NOT {_R} THEN 'product_only'
 WHEN {_F['world']} AND NOT {_F['specific']} AND NOT ({_F['action']} AND {_F['access']}) THEN 'missing_event_marker' WHEN NOT {_R} AND NOT {_E} THEN 'missing_event_marker' END"""


@query(f"SELECT doc_id, CASE WHEN why IS NULL THEN CASE WHEN r THEN 'recruitment_deadline' ELSE 'event' END END AS category, why AS reason FROM (SELECT doc_id, {_WHY} AS why, {_R} AS r FROM documents)")
def classify_structured(spark, d) -> DataFrame:
    f = rules.features(F.col("text"), rules.RuleSet(terms=TERMS, marker=None))
    docs = read(spark, d, "documents").withColumns(f)
    category, reason = rules.structured({k: F.col(k) for k in f})
    return docs.select("doc_id", category.alias("category"), reason.alias("reason"))


@query(f"""SELECT doc_id, CASE WHEN {_F['giveaway']} AND NOT {_F['specific']} THEN 'giveaway_only' WHEN EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.quality = 0) THEN 'duplicate_x_source' WHEN length(trim(regexp_replace(text, '\\s+', ' ', 'g'))) < 12 THEN 'missing_text'
 WHEN length(trim(regexp_replace(text, '\\s+', ' ', 'g'))) > 12000 THEN 'malformed_text' WHEN why IS NOT NULL THEN why WHEN n_chars < 300 THEN 'retweet_below_threshold' END AS reason FROM (SELECT *, {_WHY} AS why FROM documents) d""")
def accept_reject(spark, d) -> DataFrame:
    rs = rules.RuleSet(terms=TERMS, marker=None, min_retweets=300, max_length=12000, malformed=())
    c = read(spark, d, "documents").select("doc_id", "text", F.concat(F.lit("9"), F.lpad(F.col("doc_id").cast("string"), 11, "0")).alias("status_id"), F.col("n_chars").alias("retweet_count"))
    known = read(spark, d, "labels").where("quality = 0").select(F.concat(F.lit("9"), F.lpad(F.col("doc_id").cast("string"), 11, "0")))
    out = rules.accept_or_reject(c, F.lit("2024-01-10 00:00:00").cast("timestamp"), rs, known)
    timely = F.when(F.col("reason").isin("missing_datetime", "past_event", "too_far_future"), F.lit(None)).otherwise(F.col("reason"))
    return out.select("doc_id", timely.alias("reason"))


@query(r"""SELECT doc_id FROM documents WHERE regexp_matches(text, '(?i)\b[A-Z0-9._%+-]+@[A-Z0-9.-]+\.[A-Z]{2,}\b') OR regexp_matches(text, '(^|[^0-9])(\+?[0-9][0-9 .()_-]{7,}[0-9])($|[^0-9])')""")
def pii_filter(spark, d) -> DataFrame:
    return read(spark, d, "documents").where(T.sensitive(F.col("text"))).select("doc_id")


def _score_sql(terms: list[str], base: int) -> str:
    one = lambda t: f"CASE WHEN greatest(CASE WHEN contains(lower(text), '{t}') THEN 3 ELSE 0 END, CASE WHEN contains(lower(source), '{t}') THEN 2 ELSE 0 END) > 0 THEN {base} + greatest(CASE WHEN contains(lower(text), '{t}') THEN 3 ELSE 0 END, CASE WHEN contains(lower(source), '{t}') THEN 2 ELSE 0 END) ELSE 0 END"
    return " + ".join(one(t.strip()) for t in terms)


_SCORES = " UNION ALL ".join(f"SELECT doc_id, '{c['id']}' AS id, {c['priority']} AS priority, ({_score_sql(c['strong_keywords'], 4)} + {_score_sql(c['keywords'], 1)})::BIGINT AS score FROM documents" for c in CATEGORIES)


@query(_SCORES.replace(", 30 AS priority", "").replace(", 20 AS priority", "").replace(", 10 AS priority", ""))
def keyword_score(spark, d) -> DataFrame:
    fields = [(F.col("text"), 3), (F.col("source"), 2)]
    rows = F.array(*(F.struct(F.lit(c["id"]).alias("id"), (scoring.term_score(fields, c["strong_keywords"], 4) + scoring.term_score(fields, c["keywords"], 1)).cast("long").alias("score")) for c in CATEGORIES))
    return read(spark, d, "documents").select("doc_id", F.explode(rows).alias("r")).select("doc_id", "r.*")


@query(f"""WITH s AS ({_SCORES}), r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, priority DESC, id) AS k, count(*) OVER (PARTITION BY doc_id, score) AS same FROM s)
 SELECT doc_id, CASE WHEN score >= 3 THEN id ELSE 'other' END AS category, score, CASE WHEN score < 3 THEN CASE WHEN score > 0 THEN 0.35 ELSE 0.25 END
 ELSE round(least(0.96, 0.48 + score * 0.035, CASE WHEN same > 1 THEN 0.58 ELSE 1.0 END)::DOUBLE, 3) END::DOUBLE AS confidence FROM r WHERE k = 1""")
def category_decision(spark, d) -> DataFrame:
    out = scoring.category_decision(read(spark, d, "documents"), [(F.col("text"), 3), (F.col("source"), 2)], CATEGORIES)
    return out.select("doc_id", "category", F.col("score").cast("long").alias("score"), "confidence")


@query(f"""WITH s AS ({_SCORES}), r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, priority DESC, id) AS k FROM s)
 SELECT CASE WHEN score >= 3 THEN id ELSE 'other' END AS category, count(*) AS n FROM r WHERE k = 1 GROUP BY 1""")
def category_counts(spark, d) -> DataFrame:
    """The flagship: clean, score, decide, count."""
    docs = read(spark, d, "documents").select("source", T.clean_text(F.col("text")).alias("text"))
    return scoring.category_decision(docs, [(F.col("text"), 3), (F.col("source"), 2)], CATEGORIES).groupBy("category").agg(F.count("*").alias("n"))


@query("""SELECT doc_id, CASE WHEN contains(lower(text), 'eau') AND NOT contains(lower(text), 'hybrid-only') AND contains(lower(text), 'ung') THEN 'hybrid' WHEN contains(lower(text), 'eau') THEN 'offline'
 WHEN contains(lower(text), 'ung') AND contains(lower(text), 'tion') THEN 'hybrid' WHEN contains(lower(text), 'ung') THEN 'stream' WHEN contains(lower(text), 'tion') THEN 'in_world' ELSE 'unknown' END AS mode FROM documents""")
def modality(spark, d) -> DataFrame:
    terms = {"hybrid": [], "offline": ["eau"], "stream": ["ung"], "in_world": ["tion"]}
    return read(spark, d, "documents").select("doc_id", T.modality(F.col("text"), F.lit("event"), terms).alias("mode"))


@query("SELECT t.term, count(doc_id) AS matches, coalesce(array_to_string((list(doc_id ORDER BY doc_id) FILTER (doc_id IS NOT NULL))[1:5], ','), '') AS examples FROM (VALUES " + ", ".join(f"('{t}')" for t in VOCABULARY) + ") t(term) LEFT JOIN documents ON contains(lower(text), lower(t.term)) GROUP BY t.term")
def term_vocabulary(spark, d) -> DataFrame:
    out = scoring.term_vocabulary(read(spark, d, "documents"), "text", "doc_id", VOCABULARY)
    return out.select("term", "matches", F.array_join(F.col("examples").cast("array<string>"), ",").alias("examples"))


@query(r"SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title, regexp_extract(html, '<h1>([^<]*)</h1>', 1) AS heading, regexp_extract(html, '<meta charset=.([A-Za-z0-9-]+)', 1) AS charset FROM pages")
def html_meta_extract(spark, d) -> DataFrame:
    h = F.col("html")
    return read(spark, d, "pages").select("page_id", F.regexp_extract(h, "<title>([^<]*)</title>", 1).alias("title"), F.regexp_extract(h, "<h1>([^<]*)</h1>", 1).alias("heading"), F.regexp_extract(h, "<meta charset=.([A-Za-z0-9-]+)", 1).alias("charset"))


_EDGES = f"SELECT {_HOST} AS src, 'https://site' || regexp_replace(unnest(regexp_extract_all(html, '<a href=\"([^\"]*)\"', 1)), '[?#].*$', '') AS dst FROM pages"


def _edges(spark, d) -> DataFrame:
    return graph.link_edges(read(spark, d, "pages"), T.url_host(F.col("url")), "html", F.lit("https://site"))


@query(f"SELECT src, dst, count(*) AS n FROM ({_EDGES}) WHERE dst <> 'https://site' GROUP BY src, dst")
def link_edges(spark, d) -> DataFrame:
    return _edges(spark, d).groupBy("src", "dst").agg(F.count("*").alias("n"))


@query(f"SELECT dst AS node, count(DISTINCT src) AS in_degree FROM ({_EDGES}) WHERE dst <> 'https://site' GROUP BY dst")
def graph_indegree(spark, d) -> DataFrame:
    e = _edges(spark, d)
    return graph.in_degree(e, e.select(F.col("dst").alias("node")), "node")


@query(f"""WITH RECURSIVE e AS (SELECT DISTINCT src, dst FROM ({_EDGES}) WHERE dst <> 'https://site'), both_ways AS (SELECT src, dst FROM e UNION SELECT dst, src FROM e),
 walk(node, depth) USING KEY (node) AS (SELECT (SELECT min(src) FROM e), 0::BIGINT UNION SELECT b.dst, min(w.depth) + 1 FROM walk w JOIN both_ways b ON b.src = w.node WHERE b.dst NOT IN (SELECT node FROM recurring.walk) GROUP BY b.dst)
 SELECT node, depth FROM walk""")
def graph_bfs(spark, d) -> DataFrame:
    e = Rounds(spark).put(_edges(spark, d).distinct())  # read three times; pages are tokenized once
    both = e.union(e.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    return graph.bfs(both, e.agg(F.min("src").alias("node"))).select("node", F.col("depth").cast("long").alias("depth"))


_PLAN = [("core", ["Event", "event", "Party"]), ("access", ["join", "PARTY", "instance"])]


@query("""WITH p(g, gi, term, ti) AS (VALUES ('core',0,'Event',0),('core',0,'event',1),('core',0,'Party',2),('access',1,'join',0),('access',1,'PARTY',1),('access',1,'instance',2)),
 r AS (SELECT g AS grp, term || ' ' || n_name AS query, row_number() OVER (PARTITION BY lower(term || ' ' || n_name) ORDER BY gi, ti) AS k FROM p CROSS JOIN nation) SELECT grp, query FROM r WHERE k = 1""")
def query_plan(spark, d) -> DataFrame:
    """Ordered groups of terms for each name; of queries that differ in case only the first."""
    plan = F.array(*(F.struct(F.lit(i * 100 + j).alias("ord"), F.lit(g).alias("grp"), F.lit(t).alias("term")) for i, (g, terms) in enumerate(_PLAN) for j, t in enumerate(terms)))
    q = read(spark, d, "nation").select("n_name", F.explode(plan).alias("p")).select("p.ord", "p.grp", F.concat_ws(" ", "p.term", "n_name").alias("query"))
    from ..operators import resolve

    return resolve.latest(q.withColumn("_k", F.lower("query")), ["_k"], F.col("ord")).select("grp", "query")


@query("""SELECT doc_id AS "row", code FROM (SELECT doc_id, 'invalid_datetime' AS code FROM documents WHERE doc_id % 10 = 3 UNION ALL SELECT doc_id, 'missing_title' FROM documents WHERE doc_id % 7 = 0
 UNION ALL SELECT doc_id, 'invalid_url' FROM documents WHERE doc_id % 11 = 0
 UNION ALL SELECT doc_id, 'duplicate_identity' FROM (SELECT doc_id, row_number() OVER (PARTITION BY sha256(text) ORDER BY doc_id) AS k FROM documents) WHERE k > 1)""")
def feed_audit(spark, d) -> DataFrame:
    i = F.col("doc_id")
    docs = read(spark, d, "documents").withColumn("row", i)
    return quality.feed_audit(docs, "row", F.sha2(F.col("text").cast("binary"), 256), F.when(i % 7 == 0, F.lit("")).otherwise("t"), F.when(i % 10 == 3, F.lit("soon")).otherwise("2024-01-01T00:00:00Z"), F.when(i % 11 == 0, F.lit("ftp:/x")).otherwise("https://a.example/x"))


@query("SELECT page_id FROM pages WHERE regexp_extract(html, '<title>([^<]*)</title>', 1) <> '' AND page_id % 3 <> 0 AND url NOT LIKE '%spam%' AND html LIKE '%<a href=%'")
def indexable(spark, d) -> DataFrame:
    links = F.regexp_extract_all("html", F.lit('<a href="([^"]*)"'), F.lit(1))
    ok = quality.indexable(F.col("page_id").cast("string"), F.regexp_extract("html", "<title>([^<]*)</title>", 1), F.lit("2024-01-01"), links, F.col("page_id") % 3 == 0, F.contains("url", F.lit("spam")))
    return read(spark, d, "pages").where(ok).select("page_id")


@query("""SELECT event_id, ts AS parsed FROM (SELECT event_id, date_trunc('minute', ts) AS ts FROM events)""")
def parse_datetime(spark, d) -> DataFrame:
    """Instants written as Japanese local date and clock, read back."""
    e = read(spark, d, "events").select("event_id", F.date_trunc("minute", F.col("ts").cast("timestamp")).alias("at"))
    written = F.concat(F.lit("開催 "), F.date_format(times.local("at"), "yyyy年M月d日 HH:mm"), F.lit(" から"))
    return e.select("event_id", times.event_datetime(written, F.col("at")).cast("timestamp_ntz").alias("parsed"))


@query("""SELECT event_id, CASE WHEN m = 0 THEN 'next_calendar_week_weekday' ELSE 'next_occurrence_explicit' END AS method,
 CASE WHEN m = 0 THEN CAST(l AS DATE) - (isodow(l) - 1)::INTEGER + 7 + (event_id % 7)::INTEGER ELSE CAST(l AS DATE) + (CASE WHEN (event_id - (isodow(l) - 1)) % 7 = 0 THEN 7 ELSE ((event_id - (isodow(l) - 1)) % 7 + 7) % 7 END)::INTEGER END
 + INTERVAL 12 HOUR AS resolved FROM (SELECT event_id, event_id % 2 AS m, ts + INTERVAL 9 HOUR AS l FROM events)""")
def relative_weekday(spark, d) -> DataFrame:
    i = F.col("event_id")
    day = F.substring(F.lit(times.WEEKDAYS), (i % 7 + 1).cast("int"), F.lit(1))
    text = F.concat(F.when(i % 2 == 0, "来週").otherwise("次の"), day, F.lit("曜日 21:00"))
    at, method = times.relative_weekday(text, F.col("ts").cast("timestamp"))
    return read(spark, d, "events").select(i, method.alias("method"), at.cast("timestamp_ntz").alias("resolved"))


_ENTRIES = [(1, ["red ring", "ring red"], ["Brand#2"], ["red"]), (2, ["bolt"], [], []), (3, ["blue bolt"], ["Brand#4"], ["blue", "bolt"]), (4, ["widget"], [], [])]
_MATCH = """SELECT p_partkey AS event_id, e.id AS entry_id, (CASE WHEN a THEN 5 ELSE 0 END + CASE WHEN o THEN 3 ELSE 0 END + CASE WHEN p THEN 2 ELSE 0 END)::BIGINT AS score FROM (
 SELECT p_partkey, e.id, len(list_filter(e.aliases, lambda x: contains(p_name, x))) > 0 AS a, list_contains(e.orgs, p_brand) AS o, len(e.pats) > 0 AND len(list_filter(e.pats, lambda x: NOT contains(p_name, x))) = 0 AS p
 FROM part CROSS JOIN (VALUES (1, ['red ring','ring red'], ['Brand#2'], ['red']), (2, ['bolt'], []::VARCHAR[], []::VARCHAR[]), (3, ['blue bolt'], ['Brand#4'], ['blue','bolt']), (4, ['widget'], []::VARCHAR[], []::VARCHAR[])) e(id, aliases, orgs, pats)) e WHERE a OR (o AND p)"""
_BEST = f"""WITH s AS ({_MATCH}), t AS (SELECT *, max(score) OVER (PARTITION BY event_id) AS top FROM s), b AS (SELECT event_id, count(*) AS n, min(entry_id) AS e, max(score) AS score FROM t WHERE score = top GROUP BY event_id)
 SELECT p_partkey AS event_id, CASE WHEN n IS NULL THEN 'unmatched' WHEN n > 1 THEN 'ambiguous' ELSE 'matched' END AS status, CASE WHEN n = 1 THEN e END AS entry_id, score FROM part LEFT JOIN b ON event_id = p_partkey"""


def _match(spark, d) -> tuple[DataFrame, DataFrame]:
    events = read(spark, d, "part").select(F.col("p_partkey").alias("event_id"), F.col("p_name").alias("body"), F.col("p_brand").alias("organizer"))
    entries = spark.createDataFrame(_ENTRIES, "entry_id int, aliases array<string>, organizers array<string>, patterns array<string>")
    return events, ontology.match_scores(events, entries)


@query(_MATCH)
def ontology_match(spark, d) -> DataFrame:
    return _match(spark, d)[1].select("event_id", "entry_id", F.col("score").cast("long").alias("score"))


@query(_BEST)
def select_unique_best(spark, d) -> DataFrame:
    events, scores = _match(spark, d)
    return ontology.unique_best(scores, events).select("event_id", "status", "entry_id", F.col("score").cast("long").alias("score"))


@query(f"SELECT status, entry_id, count(*) AS n FROM ({_BEST}) GROUP BY status, entry_id")
def match_audit(spark, d) -> DataFrame:
    events, scores = _match(spark, d)
    return ontology.match_audit(ontology.unique_best(scores, events))


@query("""SELECT s_suppkey, CAST(g AS DATE) AS day FROM supplier, generate_series(DATE '2024-01-01', DATE '2024-03-31', INTERVAL 1 DAY) t(g)
 WHERE isodow(g) - 1 IN (s_suppkey % 7, (s_suppkey + 2) % 7) AND (floor(date_diff('day', DATE '2024-01-03', CAST(g AS DATE)) / 7.0)::BIGINT % (1 + s_suppkey % 3) + (1 + s_suppkey % 3)) % (1 + s_suppkey % 3) = 0""")
def recur_weekly(spark, d) -> DataFrame:
    k = F.col("s_suppkey")
    t = read(spark, d, "supplier").select(k, F.array((k % 7).cast("int"), ((k + 2) % 7).cast("int")).alias("weekdays"), (1 + k % 3).alias("interval_weeks"), F.lit("2024-01-03").cast("date").alias("anchor_date"))
    return recurrence.weekly(t, F.lit("2024-01-01").cast("date"), F.lit("2024-03-31").cast("date")).select("s_suppkey", "day")


@query("""SELECT n_nationkey, CAST(g AS DATE) AS day FROM nation, generate_series(DATE '2024-01-01', DATE '2024-06-30', INTERVAL 1 DAY) t(g) WHERE isodow(g) - 1 = n_nationkey % 7 AND
 CASE WHEN n_nationkey % 3 = 0 THEN floor((day(last_day(CAST(g AS DATE))) - day(g)) / 7) = 0 ELSE ceil(day(g) / 7.0) = n_nationkey % 5 + 1 END""")
def recur_nth_weekday(spark, d) -> DataFrame:
    k = F.col("n_nationkey")
    t = read(spark, d, "nation").select(k, (k % 7).alias("weekday"), F.when(k % 3 == 0, -1).otherwise(k % 5 + 1).alias("nth"))
    return recurrence.monthly_nth(t, F.lit("2024-01-01").cast("date"), F.lit("2024-06-30").cast("date")).select("n_nationkey", "day")


@query("SELECT n_nationkey, CAST(g AS DATE) AS day FROM nation, generate_series(DATE '2024-01-01', DATE '2024-06-30', INTERVAL 1 DAY) t(g) WHERE day(g) IN (n_nationkey + 1, 31)")
def recur_month_days(spark, d) -> DataFrame:
    k = F.col("n_nationkey")
    t = read(spark, d, "nation").select(k, F.array((k + 1).cast("int"), F.lit(31)).alias("days"))
    return recurrence.monthly_days(t, F.lit("2024-01-01").cast("date"), F.lit("2024-06-30").cast("date")).select("n_nationkey", "day")


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def json_path(spark, d) -> DataFrame:
    return read(spark, d, "events").select("event_id", F.try_variant_get(F.try_parse_json("props"), "$.k", "bigint").alias("k"))


@query("SELECT CASE WHEN n < 4 THEN '1-3' WHEN n <= 10 THEN '4-10' WHEN n <= 20 THEN '11-20' WHEN n <= 50 THEN '21-50' ELSE '51+' END AS band, count(*) AS n FROM (SELECT l_quantity AS n FROM lineitem) GROUP BY 1")
def position_band(spark, d) -> DataFrame:
    return read(spark, d, "lineitem").groupBy(T.position_band(F.col("l_quantity")).alias("band")).agg(F.count("*").alias("n"))


@query("SELECT doc_id, CASE WHEN length(s) > 40 THEN rtrim(s[1:39]) || '…' ELSE s END AS short FROM (SELECT doc_id, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS s FROM documents)")
def truncate(spark, d) -> DataFrame:
    return read(spark, d, "documents").select("doc_id", T.truncate(T.clean_text(F.col("text")), 40).alias("short"))


@query()
def text_similarity(spark, d) -> DataFrame:
    """Ratcliff/Obershelp of neighbouring parts' names; no SQL."""
    p = read(spark, d, "part").select("p_partkey", "p_name")
    q = p.select((F.col("p_partkey") - 1).alias("p_partkey"), F.col("p_name").alias("next_name"))
    return p.join(q, "p_partkey").select("p_partkey", T.ratcliff("p_name", "next_name").alias("likeness"))


@query()
def folded_text(spark, d) -> DataFrame:
    """NFKC and case folding; no SQL."""
    return read(spark, d, "documents").select("doc_id", T.match_key(F.col("text")).alias("key"))


@query("SELECT event_id, 'ev-' || event_id::VARCHAR AS uid, date_trunc('second', ts) AS starts_at FROM events")
def ics_round_trip(spark, d) -> DataFrame:
    """Events rendered as calendar text and read back."""
    from ..sources import sinks

    e = read(spark, d, "events").select("event_id", F.concat(F.lit("ev-"), F.col("event_id").cast("string")).alias("uid"), F.col("event_type").alias("title"), F.date_trunc("second", F.col("ts").cast("timestamp")).alias("starts_at"))
    text = e.select("event_id", sinks.vevent(e).alias("value"))
    return readers.ics_events(text, "value").select("event_id", "uid", F.col("starts_at").cast("timestamp_ntz").alias("starts_at"))
