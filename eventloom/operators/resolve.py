"""Duplicates: exact, by several keys, by evidence between pairs; components; merging with provenance.

Pairs are only formed inside a block (the same start, or a key of equal evidence). Equal evidence never needs all pairs
of a block: its members are linked to the block's first member. Only the similarity rule compares pairs, inside blocks
of start and organizer and behind an exact filter (see `similarity`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from . import similarity
from .durable import Rounds


def latest(rows: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """One row a key: the first by order (give descending columns for the latest). row_number, no collect."""
    by = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("_n", F.row_number().over(by)).where("_n = 1").drop("_n")


def best_by(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row a key, the greatest by order, as an aggregate: partial results shrink before the shuffle."""
    rest = [c for c in rows.columns if c not in keys]
    best = F.max_by(F.struct(*rest), F.struct(*order)).alias("_b")
    return rows.groupBy(*keys).agg(best).select(*keys, "_b.*")


def first_of_any_key(new: DataFrame, keys: list[Column], order: str, known: DataFrame | None = None) -> DataFrame:
    """Rows in order, leaving out each that shares a key with known (one column of keys) or with an earlier kept row.

    Rows without a key stay. In each round all rows that come first in every one of their keys are kept, and the rows
    that share a key with them go; only the rest, (key, order) pairs of undecided rows, goes round again.
    """
    each = new.select(F.col(order).alias("_o"), F.explode(F.array_distinct(F.array_compact(F.array(*keys)))).alias("_k"))
    out, tables = None, Rounds(new.sparkSession)
    if known is not None:
        k = known.select(F.col(known.columns[0]).alias("_k")).distinct()
        out = each.join(k, "_k", "left_semi").select("_o").distinct()
        each = each.join(out, "_o", "left_anti")
    while True:
        each = tables.put(each)
        if each.isEmpty():
            break
        first = each.groupBy("_k").agg(F.min("_o").alias("_first"))
        kept = each.join(first, "_k").groupBy("_o").agg(F.bool_and(F.col("_o") == F.col("_first")).alias("_all")).where("_all").select("_o")
        taken = each.join(kept, "_o", "left_semi").select("_k").distinct()
        gone = each.join(taken, "_k", "left_semi").select("_o").distinct().join(kept, "_o", "left_anti")
        out = gone if out is None else out.unionByName(gone)
        each = each.join(kept.unionByName(gone), "_o", "left_anti")
    return new if out is None else new.join(out.distinct(), F.col(order) == F.col("_o"), "left_anti")


def evidence_edges(events: DataFrame, keys: dict[str, Column], row_id: str, block: list[str]) -> DataFrame:
    """a, b, reason: each row linked to the smallest row of its block with the same key; null keys link nothing."""
    out, tables = None, Rounds(events.sparkSession)
    for reason, key in keys.items():
        rows = events.select(F.col(row_id).alias("b"), *block, key.alias("_key")).where(F.col("_key").isNotNull())
        # written, so that both sides of the join are shuffled for it and the rows of a hot key can be split
        first = tables.put(rows.groupBy(*block, "_key").agg(F.min("b").alias("a"), F.count("*").alias("_n")).where("_n > 1").drop("_n"))
        e = rows.join(first, [*block, "_key"]).where("a < b").select("a", "b", F.lit(reason).alias("reason"))
        out = e if out is None else out.unionByName(e)
    return out


def _folded(events: DataFrame, row_id: str) -> DataFrame:
    """id, at (start), org (organizer's key), key (of the text), nth and url of the rows."""
    body = F.coalesce(F.nullif(F.col("description"), F.lit("")), F.col("title"), F.lit(""))
    url = T.canonical_url_strict(F.col("url")) if "url" in events.columns else F.lit(None).cast("string")
    return events.select(F.col(row_id).alias("id"), F.coalesce("starts_at", F.lit("")).alias("at"), T.dedup_key(F.col("organizer")).alias("org"), T.dedup_key(body).alias("key"), T.event_ordinal(body).alias("nth"), url.alias("url"))


def _keys(events: DataFrame, row_id: str) -> DataFrame:
    """_folded of the rows that have an organizer."""
    return _folded(events, row_id).where("org <> ''")


def _key_table(events: DataFrame, row_id: str) -> DataFrame:
    """_keys as a table. Python functions fold the texts, so rows are dealt to all cores first: a table of some megabytes is one file, and one task would fold all."""
    spark = events.sparkSession
    # the organizers are looked at in the table, else they were folded before the rows are dealt
    dealt = events.repartition(spark.sparkContext.defaultParallelism, row_id)
    return Rounds(spark).put(_folded(dealt, row_id)).where("org <> ''")


_BY_ORDINAL = ["at", "org", "nth"]


def _similar_rows(keys: DataFrame, low: float, high: float) -> DataFrame:
    nth = F.col("nth").isNotNull()
    k = keys.withColumn("least", F.when(nth, F.lit(min(low, high))).otherwise(F.lit(high))).withColumn("carry", nth)
    return k.select(*_BY_ORDINAL, "id", "key", "least", "carry")


def _similar(pairs: DataFrame, low: float, *more: Column) -> DataFrame:
    s = F.col("s")
    ordinal = F.col("l_carry") & (s >= low)
    reason = F.when(ordinal, "same_organizer_same_start_ordinal").otherwise("same_organizer_same_start_high_similarity")
    sure = F.when(ordinal, F.least(F.lit(0.96), 0.80 + 0.25 * s)).otherwise(F.least(F.lit(0.94), 0.74 + 0.25 * s))
    return pairs.select(F.col("l").alias("a"), F.col("r").alias("b"), reason.alias("reason"), F.bround(sure, 4).alias("confidence"), *more)


def similar_pairs(events: DataFrame, row_id: str = "id", low: float = 0.50, high: float = 0.75) -> DataFrame:
    """a, b, reason, confidence of pairs with the same start and organizer whose ordinals agree and whose texts are alike.

    events: starts_at, organizer, description, title and the id. Blocks have one start, organizer and ordinal; see
    `similarity` for how pairs are found in them. n copies of a text make n (n - 1) / 2 pairs: see similar_classes.
    """
    return _similar(similarity.alike_pairs(_similar_rows(_keys(events, row_id), low, high), _BY_ORDINAL), low)


def similar_classes(events: DataFrame, row_id: str = "id", low: float = 0.50, high: float = 0.75) -> DataFrame:
    """The same as similar_pairs without a row for each pair of copies: a, b, reason, confidence, copy. Every row is one of its pairs.

    copy: b has a's text (in its block), and a is the smallest id that has. Else a and b stand for all rows with their texts: each
    pair of these in which the one with a's text has the smaller id is alike by just as much (see similarity.alike_classes).
    """
    links, members = similarity.alike_classes(_similar_rows(_keys(events, row_id), low, high), _BY_ORDINAL)
    copies = members.select(F.col("first").alias("l"), F.col("id").alias("r"), F.lit(1.0).alias("s"), F.col("carry").alias("l_carry"))
    return _similar(links, low, F.lit(False).alias("copy")).unionByName(_similar(copies, low, F.lit(True).alias("copy")))


def similar_counts(events: DataFrame, row_id: str = "id", low: float = 0.50, high: float = 0.75) -> DataFrame:
    """id, class_id, n_links of the rows that have an organizer: in how many of similar_pairs' pairs a row is, copies counted.

    class_id: the smallest id with the row's text in its block. The result has a row an id, where texts that are all alike make as many
    pairs, or links of classes, as the square of their number (see similarity.alike_counts).
    """
    none = F.lit(None).cast("string")
    rows = _similar_rows(_key_table(events, row_id), low, high)
    return similarity.alike_counts(rows.select(*_BY_ORDINAL, "id", "key", "least", none.cast("double").alias("below"), none.alias("kind"), none.alias("apart")), _BY_ORDINAL)


def _ambiguous_rows(events: DataFrame, row_id: str, least: float) -> DataFrame:
    return _keys(events, row_id).select("at", "org", "id", "key", F.lit(least).alias("least"), F.struct("nth", "url").alias("carry"))


def _ambiguous(pairs: DataFrame, low: float, high: float, *more: Column) -> DataFrame:
    p = pairs.where(~F.coalesce(F.col("l_carry.url") == F.col("r_carry.url"), F.lit(False)))
    same = F.col("l_carry.nth").eqNullSafe(F.col("r_carry.nth")) & ((F.col("l_carry.nth").isNotNull() & (F.col("s") >= low)) | (F.col("s") >= high))
    return p.where(~same).select(F.col("l").alias("a"), F.col("r").alias("b"), F.bround("s", 4).alias("similarity"), *more)


def ambiguous_pairs(events: DataFrame, row_id: str = "id", least: float = 0.45, low: float = 0.50, high: float = 0.75) -> DataFrame:
    """a, b, similarity of pairs with the same start and organizer that are alike but by no rule the same: for a person to decide.

    events: as for similar_pairs, and url; pairs with one address are the same. low and high: as there. Copies of two
    ambiguous texts make a pair each: see ambiguous_classes.
    """
    return _ambiguous(similarity.alike_pairs(_ambiguous_rows(events, row_id, least), ["at", "org"]), low, high)


def ambiguous_classes(events: DataFrame, row_id: str = "id", least: float = 0.45, low: float = 0.50, high: float = 0.75) -> DataFrame:
    """The same as ambiguous_pairs, and a person sees each two texts once: a, b, similarity, copy (high: at most 1).

    copy false: a and b stand for all rows with their text, ordinal and address: each pair of these in which the one of a's class has
    the smaller id is as ambiguous. copy true: b is such a copy of a, the smallest id of its class (no ambiguous pair).
    """
    links, members = similarity.alike_classes(_ambiguous_rows(events, row_id, least), ["at", "org"])
    copies = members.select(F.col("first").alias("a"), F.col("id").alias("b"), F.lit(1.0).alias("similarity"), F.lit(True).alias("copy"))
    return _ambiguous(links, low, high, F.lit(False).alias("copy")).unionByName(copies)


def ambiguous_counts(events: DataFrame, row_id: str = "id", least: float = 0.45, low: float = 0.50, high: float = 0.75) -> DataFrame:
    """id, class_id, n_links of the rows that have an organizer: in how many of ambiguous_pairs' pairs a row is.

    class_id: the smallest id with the row's text, ordinal and address in its block. For the size of the result see similar_counts.
    """
    rows = _key_table(events, row_id)
    below = F.when(F.col("nth").isNotNull(), F.lit(min(low, high))).otherwise(F.lit(high))
    return similarity.alike_counts(rows.select("at", "org", "id", "key", F.lit(least).alias("least"), below.alias("below"), F.col("nth").cast("string").alias("kind"), F.col("url").alias("apart")), ["at", "org"])


def connected_components(edges: DataFrame) -> DataFrame:
    """v, component (the smallest vertex reachable).

    Each round vertices draw lots: each steps to the least of itself and its neighbours, jumps on from there once, and the
    edges are contracted to those between different places. The lots are hashes, drawn anew from the third round on, so
    whatever the order of the ids no long descending chains are left: the number of vertices falls by a constant share each
    round, and a hub meets all its leaves in the first two. A round writes the steps of the vertices that are left; these are
    followed from the last round back, so all rounds together cost a few times the first.
    """
    return _components(edges)[0]


def _components(edges: DataFrame) -> tuple[DataFrame, int]:
    """The components and the number of rounds."""
    tables = Rounds(edges.sparkSession)
    rest = tables.put(edges.select("a", "b").where("a is not null and b is not null").distinct())
    vertices = rest.select(F.col("a").alias("v")).union(rest.select(F.col("b").alias("v"))).distinct()
    first, steps = rest, []
    rest = rest.where("a <> b")
    while not rest.isEmpty():
        lot = lambda c: F.xxhash64(F.lit(max(0, len(steps) - 1)), c)  # noqa: B023, E731
        both = rest.select(F.col("b").alias("v"), F.col("a").alias("p")).union(rest.select(F.col("a").alias("v"), F.col("b").alias("p")))
        least = both.groupBy("v").agg(F.min(F.struct(lot(F.col("p")).alias("lot"), F.col("p").alias("p"))).alias("m"))
        near = tables.put(least.select("v", F.when(F.struct(lot(F.col("v")).alias("lot"), F.col("v").alias("p")) < F.col("m"), F.col("v")).otherwise(F.col("m.p")).alias("p")))
        step = tables.put(near.join(near.select(F.col("v").alias("p"), F.col("p").alias("hop")), "p").select("v", F.col("hop").alias("p")))
        tables.drop(near)
        for end in ("a", "b"):
            rest = rest.join(step.select(F.col("v").alias(end), F.col("p").alias("_p")), end).drop(end).withColumnRenamed("_p", end)
        rest = tables.put(rest.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
        if steps:
            tables.drop(last)
        last = rest
        steps.append(step)
    root = None
    for step in reversed(steps):
        if root is not None:
            step = step.join(root.select(F.col("v").alias("p"), F.col("root").alias("_r")), "p", "left").select("v", F.coalesce("_r", "p").alias("p"))
        root = tables.put(step.withColumnRenamed("p", "root"))
    if root is None:
        return vertices.withColumn("component", F.col("v")), 0
    tables.drop(*steps)
    whole = tables.put(vertices.join(root, "v", "left").select("v", F.coalesce("root", "v").alias("root")))
    least = tables.put(whole.groupBy("root").agg(F.min("v").alias("component")))
    tables.drop(first)
    return whole.join(least, "root").select("v", "component"), len(steps)


#: Fixed: which source speaks first.
SOURCE_PRIORITY = {"repository_manual_events": 50, "vrchat_calendar_discovery": 45, "external_calendar_events": 40, "x_curated_events": 30, "yahoo_realtime_events": 20}


def representative_order(columns: list[str]) -> list[Column]:
    """Greatest first: source priority, filled fields, confidence, fetched_at, record id."""
    priority = F.lit(0)
    for name, p in SOURCE_PRIORITY.items():
        priority = F.when(F.col("source") == name, p).otherwise(priority)
    fields = [c for c in ("organizer", "location", "description", "url", "image_url", "primary_action_url", "official_x_url", "official_website_url") if c in columns]
    filled = F.lit(0)
    for c in fields:
        filled = filled + F.when(F.coalesce(F.col(c).cast("string"), F.lit("")) != "", 1).otherwise(0)
    return [priority, filled, F.coalesce(F.col("confidence").cast("double"), F.lit(0.0)), F.coalesce(F.col("fetched_at").cast("string"), F.lit("")), F.col("source_record_id")]


def merge_members(rows: DataFrame, group: str, order: list[Column], scalars: list[str], arrays: list[str], provenance: list[str]) -> DataFrame:
    """One row a group: scalars from the best row that has them, arrays united and sorted, provenance of every member."""
    ranked = rows.withColumn("_o", F.struct(*order))
    filled = [F.max_by(c, F.when(F.coalesce(F.col(c).cast("string"), F.lit("")) != "", F.col("_o"))).alias(c) for c in scalars]
    united = [F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))).alias(c) for c in arrays]
    return ranked.groupBy(group).agg(*filled, *united, F.array_sort(F.collect_set(F.struct(*provenance))).alias("provenance"), F.count("*").alias("merged_source_count"))


#: What a member says of where it comes from.
PROVENANCE = ("source_record_id", "event_id", "source", "source_id", "url", "organizer", "fetched_at")
#: Fields that the representative takes from the next in rank if it has none.
BACKFILLED = ("image_url", "image_kind", "primary_action_url", "primary_action_kind", "official_x_url", "official_website_url", "vrchat_group_url", "vrchat_group_image_url", "preferred_image_url", "preferred_image_kind")
LINK_FIELDS = ("official_links", "related_links")


def first_of_each(items: Column) -> Column:
    """Rows of an array of struct<key, place, row>, one for each key: the one of the least place. In order of the key."""
    ordered = F.array_sort(F.transform(items, lambda x: F.struct(x["key"].alias("key"), x["place"].alias("place"), x["row"].alias("row"))))
    kept = F.filter(ordered, lambda x, i: (i == 0) | (F.get(ordered, i - 1)["key"] != x["key"]))
    return F.transform(kept, lambda x: x["row"])


def _placed(rows: Column, place: Column, key) -> Column:
    """array<struct<key, place, row>> of an array of structs; place: of the member, then of the row in it."""
    return F.transform(rows, lambda r, i: F.struct(F.coalesce(F.nullif(key(r), F.lit("")), F.to_json(r)).alias("key"), F.struct(place.alias("member"), i.alias("at")).alias("place"), r.alias("row")))


def merged_clusters(members: DataFrame, matches: DataFrame, own: list[str]) -> DataFrame:
    """One row a cluster, as an ordered fold in one aggregate.

    members: cluster, place (the order of input), id, source_record_id, what representative_order and PROVENANCE name, and any of
    tags, provenance, BACKFILLED, LINK_FIELDS. matches: cluster, reason, confidence of the pairs that made it.

    own: fields that the representative gives as they are. BACKFILLED come from the first in rank that has one. Tags are
    united and sorted, blank ones left out. Of links with one canonical address and of provenance of one record the
    first by place counts, whatever its rank. merge_reason is the sorted union, merge_confidence the least (1 without matches).
    """
    has = members.columns
    rank = F.struct(*representative_order(has), -F.col("place"))
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = members.withColumn("_o", rank)
    shape = "array<struct<" + ",".join(f"{c}:string" for c in PROVENANCE) + ">>"
    itself = F.array(F.struct(*((F.col("id") if c == "event_id" else F.col(c)).cast("string").alias(c) for c in PROVENANCE)))
    said = F.concat(F.coalesce(F.col("provenance").cast(shape), F.array().cast(shape)), itself) if "provenance" in has else itself
    rows = rows.withColumn("_provenance", _placed(said, F.col("place"), lambda r: r["source_record_id"]))
    out = [F.max_by(c, "_o").alias(c) for c in own]
    out += [F.max_by(c, F.when(text(c) != "", F.col("_o"))).alias(c) for c in BACKFILLED if c in has and c not in own]
    out += [F.max_by("source_record_id", "_o").alias("source_record_id"), first_of_each(F.flatten(F.collect_list("_provenance"))).alias("provenance"), F.count("*").alias("members")]
    if "tags" in has:
        out.append(F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.filter("tags", lambda t: T.clean_text(t) != ""))))).alias("tags"))
    for c in LINK_FIELDS:
        if c in has:
            rows = rows.withColumn(f"_{c}", _placed(F.coalesce(c, F.array().cast(members.schema[c].dataType)), F.col("place"), lambda r: T.canonical_url_strict(r["url"])))
            out.append(first_of_each(F.flatten(F.collect_list(f"_{c}"))).alias(c))
    merged = rows.groupBy("cluster").agg(*out).withColumn("merged_source_count", F.size("provenance"))
    why = matches.groupBy("cluster").agg(F.array_sort(F.collect_set("reason")).alias("_why"), F.min("confidence").alias("_sure"))
    df = merged.join(why, "cluster", "left")
    return df.withColumns({"merge_reason": F.coalesce("_why", F.array().cast("array<string>")), "merge_confidence": F.coalesce("_sure", F.lit(1.0))}).drop("_why", "_sure")


def cluster_audit(members: DataFrame, matches: DataFrame) -> DataFrame:
    """A row for each cluster of several members: counts, ids, sources, reasons, least confidence, the representative's record."""
    best = F.struct(*representative_order(members.columns), -F.col("place"))
    sorted_of = lambda c: F.array_sort(F.collect_set(F.col(c).cast("string")))
    m = members.groupBy("cluster").agg(F.count("*").alias("member_count"), sorted_of("id").alias("member_ids"), sorted_of("source").alias("sources"), F.max_by("source_record_id", best).alias("representative")).where("member_count > 1")
    why = matches.groupBy("cluster").agg(sorted_of("reason").alias("reasons"), F.min("confidence").alias("confidence"))
    return m.join(why, "cluster", "left").withColumn("confidence", F.coalesce("confidence", F.lit(1.0)))


def audit_totals(members: DataFrame, audit: DataFrame, ambiguous: DataFrame) -> DataFrame:
    """One row: events before and after, clusters, occurrences dropped, their rate, clusters with equal records, pairs left for a person."""
    c = audit.agg(F.count("*").alias("clusters"), F.coalesce(F.sum(F.col("member_count") - 1), F.lit(0)).alias("dropped"), F.count_if(F.array_contains("reasons", "exact_source_record")).alias("exact_source"))
    rows = members.agg(F.count("*").alias("before")).crossJoin(c).crossJoin(ambiguous.agg(F.count("*").alias("ambiguous")))  # one row each
    return rows.select("before", (F.col("before") - F.col("dropped")).alias("after"), "clusters", "dropped", F.bround(F.coalesce(F.try_divide("dropped", "before"), F.lit(0.0)), 6).alias("rate"), "exact_source", "ambiguous")


def negative_samples(members: DataFrame, count: int = 10) -> DataFrame:
    """The first pairs (left_id, right_id, starts_at, similarity) of one start that aren't one cluster: starts in the order they
    come up, pairs by the places of their rows.

    members: cluster, place, id, starts_at, description, title. Of a start the first `count` rows of each of its first
    count + 1 clusters are enough: any other pair has that many before it.
    """
    by = members.select("cluster", "place", "id", F.coalesce("starts_at", F.lit("")).alias("at"), T.dedup_key(F.coalesce(F.nullif("description", F.lit("")), F.col("title"))).alias("key"))
    clusters = by.groupBy("at", "cluster").agg(F.min("place").alias("first"))
    starts = clusters.groupBy("at").agg(F.min("first").alias("begin"), F.count("*").alias("n")).where("n > 1").orderBy("begin").limit(count)
    early = clusters.join(F.broadcast(starts.select("at", "begin")), "at")
    early = early.withColumn("_c", F.row_number().over(Window.partitionBy("at").orderBy("first"))).where(F.col("_c") <= count + 1)
    rows = by.join(F.broadcast(early.select("at", "cluster", "begin")), ["at", "cluster"])  # (count + 1) clusters of `count` starts
    rows = rows.withColumn("_r", F.row_number().over(Window.partitionBy("at", "cluster").orderBy("place"))).where(F.col("_r") <= count)
    right = rows.select("at", *(F.col(c).alias(f"r_{c}") for c in ("cluster", "place", "id", "key")))
    pairs = rows.join(right, "at").where("place < r_place and cluster <> r_cluster").orderBy("begin", "place", "r_place").limit(count)
    return pairs.select(F.col("id").alias("left_id"), F.col("r_id").alias("right_id"), F.col("at").alias("starts_at"), F.bround(T.ratcliff("key", "r_key"), 4).alias("similarity"))
