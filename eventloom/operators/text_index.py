"""A substring index: postings of trigrams in a partitioned table, exact verification against the texts.

Each character of a lower-cased text begins a gram of three characters; two end marks follow the text, so the last ones have one
too. Postings are (gram, id), dealt to folders by a hash of the gram and sorted by gram in them: a search of a term
of three characters or more reads the folders of its grams only, and in these the row groups that can have them. The ids that
have all grams are verified with `contains` against the indexed texts, which lie in folders by a hash of the id.

Terms of one or two characters are the begin of a gram: all folders are searched, row groups are still skipped. Terms of up to
three characters need no verification: their gram says it all. Terms that are looked up together are verified together, so the
texts are read and shuffled once for all of them. The empty term is in every text that isn't null. Null texts are in no answer. Ids that repeat are answered once if any of their
texts has the term.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from ..functions import times

#: What follows a text in the index, twice.
END = "\x03"
SIZE = 3
#: Files of a folder of postings, at most, for each write.
PARTS = 8
#: Texts of a batch that are Python objects at one time.
STEP = 64


@F.arrow_udf(ArrayType(StringType()))
def _grams(texts: pa.Array) -> pa.Array:
    def of(text: str | None) -> list[str] | None:
        if text is None:
            return None
        text += END * (SIZE - 1)
        return list(set(map("".join, zip(*(text[k:] for k in range(SIZE)), strict=False))))

    parts = [pa.array([of(t) for t in texts.slice(k, STEP).to_pylist()], pa.list_(pa.string())) for k in range(0, len(texts), STEP)]
    return pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.string()))


def grams(text: Column) -> Column:
    """The different grams of a text, one from each character on."""
    return _grams(F.lower(text))


def runs(text: Column, size: int) -> Column:
    """Every run of so many characters of a text that has as many; the text is split once, so time is linear in its length."""
    at = lambda c, i: F.concat(*(F.get(c, i + k) for k in range(size)))
    return times.let(F.filter(F.split(text, ""), lambda c: c != ""), lambda c: F.transform(F.sequence(F.lit(0), F.size(c) - size), lambda i: at(c, i)))


def folder(gram: Column, folders: int) -> Column:
    return F.pmod(F.xxhash64(gram), F.lit(folders)).cast("int")


def write_index(texts: DataFrame, row_id: str, text: str, path: str, folders: int = 64) -> None:
    """Writes postings and texts under path. Work and disk grow with the characters of the texts."""
    rows = texts.select(F.col(row_id).alias("id"), F.lower(F.col(text)).alias("text")).where("text is not null")
    postings = rows.where("text <> ''").select(F.explode(grams(F.col("text"))).alias("gram"), "id").withColumn("folder", folder(F.col("gram"), folders))
    # by id too, not by folder only: a common gram's postings lie in several files. By a hash: ranges would make the grams twice
    dealt = postings.repartition("folder", F.pmod(F.xxhash64("id"), F.lit(PARTS)))
    dealt.sortWithinPartitions("folder", "gram", "id").write.mode("overwrite").partitionBy("folder").parquet(f"{path}/postings")
    rows.withColumn("folder", folder(F.col("id"), folders)).repartition("folder").sortWithinPartitions("folder", "id").write.mode("overwrite").partitionBy("folder").parquet(f"{path}/texts")


class TextIndex:
    """An index written by write_index."""

    def __init__(self, spark: SparkSession, path: str, folders: int = 64):
        self.spark, self.folders = spark, folders
        self.postings, self.texts = spark.read.parquet(f"{path}/postings"), spark.read.parquet(f"{path}/texts")

    def candidates(self, term: str) -> DataFrame:
        """id of the texts that have all grams of a term that isn't empty, and of others if their ids repeat; repeated ids come up again."""
        low = term.lower()
        if len(low) < SIZE:
            return self.postings.where(F.startswith("gram", F.lit(low))).select("id")
        own = sorted({low[i : i + SIZE] for i in range(len(low) - SIZE + 1)})
        at = [folder(F.lit(g), self.folders) for g in own]  # constants, which the optimizer works out: folders are pruned
        found = self.postings.where(F.col("folder").isin(*at) & F.col("gram").isin(own))
        if len(own) == 1:
            return found.select("id")
        return found.groupBy("id").agg(F.count("*").alias("n")).where(F.col("n") >= len(own)).select("id")

    def search(self, term: str) -> DataFrame:
        """id of the texts that contain the term, whatever the case."""
        return self.search_each([term]).select("id")

    def search_each(self, terms: list[str]) -> DataFrame:
        """term, id: which texts contain which of the terms, whatever the case. A term that is given twice counts once."""
        parts, asked = [self.texts.select(F.lit("").alias("term"), "id").limit(0)], None
        for t in dict.fromkeys(terms):
            low = t.lower()
            if not low:
                parts.append(self.texts.select(F.lit(t).alias("term"), "id"))
            elif len(low) <= SIZE and END not in low:  # an end mark in a term may be one that isn't of the text
                parts.append(self.candidates(low).select(F.lit(t).alias("term"), "id"))
            else:
                rows = self.candidates(low).select("id", F.struct(F.lit(t).alias("term"), F.lit(low).alias("low")).alias("t"))
                asked = rows if asked is None else asked.unionByName(rows)
        if asked is not None:
            asked = asked.groupBy("id").agg(F.collect_set("t").alias("asked")).withColumn("folder", folder(F.col("id"), self.folders))
            found = self.texts.join(asked, ["folder", "id"]).select("id", F.explode(F.filter("asked", lambda t: F.contains(F.col("text"), t["low"]))).alias("t"))
            parts.append(found.select("t.term", "id"))
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out.distinct()

    def search_any(self, terms: list[str]) -> DataFrame:
        """id of the texts that contain one of the terms: a name and its aliases. No term: no text."""
        return self.search_each([t.lower() for t in terms]).select("id").distinct()
