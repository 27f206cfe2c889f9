"""Matching events to curated entries without guessing: a unique best match or none.

Entries whose names take AUTOMATON_BYTES at most become one Aho-Corasick automaton, which is sent to the tasks; each
event's text is read once, whatever the number of entries. More entries are matched by joins: a term is looked up by its
rarest gram of three characters (or the whole term if it is shorter) among the grams of the texts, and verified.
"""

from __future__ import annotations

import pickle
import uuid
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import IntegerType, StructField, StructType

from . import text_index
from .durable import Rounds

#: Bytes of all names of entries (with 32 for each) that one automaton may take.
AUTOMATON_BYTES = 32 << 20
GRAM = 3
ALIAS, ORGANIZER, PATTERNS = 5, 3, 2
NAMES = ("aliases", "organizers", "patterns")

_BUILT: dict = {}


class _Entries:
    """Names of entries by text, for matching inside a task."""

    def __init__(self, rows: list[tuple]):
        self.ids = [r[0] for r in rows]
        self.by_organizer: dict[str, set[int]] = {}
        self.wanted = [0] * len(rows)  # patterns of an entry; 0 if it has none or one can't be met
        terms: dict[str, tuple[list[int], list[int]]] = {}
        self.always: tuple[list[int], list[int]] = ([], [])
        for i, (_, aliases, organizers, patterns) in enumerate(rows):
            for o in set(organizers or ()) - {None}:
                self.by_organizer.setdefault(o, set()).add(i)
            if patterns and None not in patterns:
                self.wanted[i] = len(set(patterns))
            for side, names in enumerate((aliases, patterns)):
                for t in set(names or ()) - {None}:
                    (terms.setdefault(t, ([], [])) if t else self.always)[side].append(i)
        self.automaton = ahocorasick.Automaton()
        for t, found in terms.items():
            self.automaton.add_word(t, found)
        if terms:
            self.automaton.make_automaton()
        else:
            self.automaton = None

    def scores(self, body: str | None, organizer: str | None) -> Iterator[tuple]:
        if body is None:
            return
        hits = {id(x): x for _, x in self.automaton.iter(body)}.values() if self.automaton else ()
        alias, met = set(self.always[0]), {}
        for one in (*hits, ([], self.always[1])):
            alias.update(one[0])
            for i in one[1]:
                met[i] = met.get(i, 0) + 1
        own = self.by_organizer.get(organizer, set())
        all_met = {i for i, n in met.items() if n == self.wanted[i]}
        for i in alias | (own & all_met):
            yield self.ids[i], ALIAS * (i in alias) + ORGANIZER * (i in own) + PATTERNS * (i in all_met)


def match_scores(events: DataFrame, entries: DataFrame) -> DataFrame:
    """event_id, entry_id, score (alias 5, organizer 3, all patterns 2) of pairs with an alias, or organizer and patterns.

    events: event_id, body, organizer (normalized). entries: entry_id, aliases, organizers, patterns (normalized arrays;
    null names match nothing, an empty one is in every text). An event without body matches nothing.
    """
    size = F.aggregate(F.concat(*(F.coalesce(c, F.array().cast("array<string>")) for c in NAMES)), F.lit(0).cast("long"), lambda n, t: n + F.coalesce(F.octet_length(t), F.lit(0)) + 32)
    total = entries.agg(F.sum(size + 32)).first()[0] or 0
    return _by_automaton(events, entries) if total <= AUTOMATON_BYTES else _by_grams(events, entries)


def _by_automaton(events: DataFrame, entries: DataFrame) -> DataFrame:
    rows = [tuple(r) for r in entries.select("entry_id", *NAMES).toLocalIterator()]  # AUTOMATON_BYTES at most
    sent, key = events.sparkSession.sparkContext.broadcast(pickle.dumps(rows)), uuid.uuid4().hex
    schema = StructType([StructField("event_id", events.schema["event_id"].dataType), StructField("entry_id", entries.schema["entry_id"].dataType), StructField("score", IntegerType())])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _BUILT:  # a worker keeps one
            _BUILT.clear()
            _BUILT[key] = _Entries(pickle.loads(sent.value))
        known = _BUILT[key]
        for b in batches:
            out = [{"event_id": i, "entry_id": e, "score": s} for i, body, organizer in zip(*(c.to_pylist() for c in b.columns), strict=True) for e, s in known.scores(body, organizer)]
            if out:
                yield pa.RecordBatch.from_pylist(out, arrow)

    return events.select("event_id", "body", "organizer").mapInArrow(run, schema)


def _term_hits(rows: DataFrame, terms: DataFrame, tables: Rounds) -> DataFrame:
    """_row, term of the terms in each body. rows: _row, body; terms: term, distinct and not empty."""
    each = F.flatten(F.array(*(F.when(F.length("body") >= n, text_index.runs(F.col("body"), n)).otherwise(F.array().cast("array<string>")) for n in range(1, GRAM + 1))))
    grams = tables.put(rows.where("body <> ''").select("_row", F.explode(F.array_distinct(each)).alias("gram")))
    often = tables.put(grams.groupBy("gram").agg(F.count("*").alias("n")))
    own = F.when(F.length("term") <= GRAM, F.array("term")).otherwise(F.transform(F.sequence(F.lit(1), F.length("term") - (GRAM - 1)), lambda i: F.substr("term", i, F.lit(GRAM))))
    # a term without a text that has each of its grams drops out here
    wanted = terms.select("term", F.size(F.array_distinct(own)).alias("m"), F.explode(F.array_distinct(own)).alias("gram")).join(often, "gram")
    rarest = tables.put(wanted.groupBy("term").agg(F.count("*").alias("k"), F.max("m").alias("m"), F.min_by("gram", F.struct("n", "gram")).alias("gram")).where("k = m").select("term", "gram"))
    found = grams.join(rarest, "gram").select("_row", "term")
    return tables.put(found.join(rows, "_row").where(F.contains("body", F.col("term"))).select("_row", "term"))


def _by_grams(events: DataFrame, entries: DataFrame) -> DataFrame:
    tables = Rounds(events.sparkSession)
    rows = tables.put(events.select("event_id", "body", "organizer").where("body is not null").withColumn("_row", F.monotonically_increasing_id()))
    known = tables.put(entries.select("entry_id", *NAMES).withColumn("_e", F.monotonically_increasing_id()))
    named = {c: known.select("_e", F.explode(F.array_distinct(c)).alias("term")).where("term is not null") for c in NAMES}
    met = known.where("size(patterns) > 0 and forall(patterns, p -> p is not null)").select("_e", F.size(F.array_distinct("patterns")).alias("_wanted"))
    terms = named["aliases"].union(named["patterns"]).select("term").distinct()
    hits = _term_hits(rows.select("_row", "body"), terms.where("term <> ''"), tables)
    if not terms.where("term = ''").isEmpty():
        hits = tables.put(hits.union(rows.select("_row", F.lit(""))))
    alias = hits.join(named["aliases"], "term").select("_row", "_e").distinct()
    pattern = hits.join(named["patterns"], "term").groupBy("_row", "_e").agg(F.count("*").alias("_met")).join(met, "_e").where("_met = _wanted").select("_row", "_e")
    pairs = alias.select("_row", "_e", F.lit(1).alias("a"), F.lit(0).alias("p")).union(pattern.select("_row", "_e", F.lit(0), F.lit(1))).groupBy("_row", "_e").agg(F.max("a").alias("a"), F.max("p").alias("p"))
    # organizers are looked at for these pairs only: one organizer may have many events and many entries
    pairs = pairs.join(rows.select("_row", "event_id", "organizer"), "_row").join(known.select("_e", "entry_id", "organizers"), "_e")
    pairs = pairs.withColumn("o", F.coalesce(F.array_contains("organizers", F.col("organizer")), F.lit(False)).cast("int")).where("a = 1 or (o = 1 and p = 1)")
    score = F.expr(f"{ALIAS} * a + {ORGANIZER} * o + {PATTERNS} * p")
    return pairs.select("event_id", "entry_id", score.alias("score"))


def unique_best(scores: DataFrame, events: DataFrame) -> DataFrame:
    """event_id, status (matched, ambiguous, unmatched), entry_id (only if matched), score."""
    by = Window.partitionBy("event_id")
    top = scores.withColumn("_top", F.max("score").over(by)).where(F.col("score") == F.col("_top"))
    one = top.groupBy("event_id").agg(F.count("*").alias("_n"), F.min("entry_id").alias("_e"), F.max("score").alias("score"))
    status = F.when(F.col("_n").isNull(), "unmatched").when(F.col("_n") > 1, "ambiguous").otherwise("matched")
    return events.select("event_id").join(one, "event_id", "left").select("event_id", status.alias("status"), F.when(F.col("_n") == 1, F.col("_e")).alias("entry_id"), "score")


def match_audit(decisions: DataFrame) -> DataFrame:
    return decisions.groupBy("status", "entry_id").agg(F.count("*").alias("n"))


def enrich(events: DataFrame, decisions: DataFrame, entries: DataFrame) -> DataFrame:
    """Matched events take location and url only where empty, and the union of tags. entries: entry_id, e_location, e_url, e_tags."""
    d = decisions.where("status = 'matched'").select("event_id", "entry_id")
    df = events.join(d, "event_id", "left").join(entries, "entry_id", "left")
    empty = F.array().cast("array<string>")
    return df.withColumns(
        {
            "location": F.coalesce(F.nullif("location", F.lit("")), F.col("e_location")),
            "url": F.coalesce(F.nullif("url", F.lit("")), F.col("e_url")),
            "tags": F.array_sort(F.array_union(F.coalesce("tags", empty), F.coalesce("e_tags", empty))),
        }
    ).drop("e_location", "e_url", "e_tags")
