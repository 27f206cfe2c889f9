"""The corpus pipeline: toxicity, near duplicates, benchmark decontamination, personal data, piece ids.

Each stage takes (spark, docs, sf_dir) and works on all that the one before has kept; run() writes each stage's result
as Parquet in the shared folder and reads it back for the next. All stages but the last return the documents' columns.
Rows with a null text pass the filters (no word is toxic, copied or contaminated) and are encoded as empty; an empty
table gives an empty result. Rows without a doc_id are filtered like others but count as no one's copy. Rows that repeat
id and text count once after the second stage; different texts under one id are judged each on its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.llm import common, decontaminate, jaccard_join, pii, piece_codec, toxicity

#: No SQL can express the learned scores, the automata and the encoder; tests compare with plain versions instead.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose learned toxicity score is under 0.5."""
    return toxicity.without_toxic(docs, toxicity.learned(docs, common.table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of each component of links at Jaccard similarity 0.8; texts without a set and rows without an id stay."""
    return jaccard_join.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents less than a twentieth of whose words lie in occurrences of 13-word benchmark windows."""
    return decontaminate.remove_contaminated(docs, common.table(spark, sf_dir, "benchmark"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind in brackets, n_chars counted anew."""
    out = pii.redacted(docs)
    return out.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text").cast("long")).otherwise(F.col("n_chars"))) if "n_chars" in docs.columns else out


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids and the digest of the text decoded from them."""
    out = piece_codec.encode(docs)
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("personal_data", mask_personal_data),
    ("encoding", encode_pieces),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = common.Durable(spark, "pipeline")
    docs = common.table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = store.put(stage(spark, docs, sf_dir), replaces=store.path if i else None)
    return docs
