"""Small tables with every awkward case: nulls, empty and very long texts, repeated rows, clashing extra columns."""

import random

import pytest

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def awkward(spark):
    rng = random.Random(11)
    words = ["the", "and", "idiot", "tion", "Été", "naïve", "字", "😀", "cc", "by", "a@b.co", "4111111111111111", "1.2.3.4", "+1 (555) 123-4567", "\n", "  ", "\t", "|", "###", "x" * 30]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.choice([0, 1, 3, 8, 60]))), rng.choice(["en", "de", None]), rng.choice(["s0", "s0", "s1", None]), 0) for i in range(120)]
    rows += [(200, None, None, None, None), (201, "", "en", "s0", 0), (202, " \n\t ", "en", "s0", 4), (203, "word " * 30_000, "en", "s0", 150_000), (204, "y" * 50_000, "de", "s1", 50_000)]
    rows += [rows[5], rows[5]]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    from pyspark.sql import functions as F

    return df.withColumns({"n_words": F.lit("clash"), "score": F.lit(-1), "label": F.lit(None).cast("string"), "set_key": F.lit(0)}).cache()


@pytest.fixture(scope="session")
def texts(awkward):
    return [(r.doc_id, r.text) for r in awkward.select("doc_id", "text").collect()]


@pytest.fixture(scope="session")
def documents(spark):
    import os

    if not os.path.isdir(DATA):
        pytest.skip("no tables")
    return spark.read.parquet(f"{DATA}/documents.parquet").cache()
