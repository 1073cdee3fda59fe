"""The corpus pipeline: five operators of ``propensa.llm`` in a row.

Each stage takes (spark, docs, sf_dir) and all its predecessor kept; all but
the last return the columns of ``documents``.

Cases: a null or empty text is scored as padding, and if that is not rejected
one row of all such is kept and packed as its end id; of repeated rows one is
kept; rows without doc_id are kept like others (of a class with ids, the lowest
id); very long texts are scored, compared and cut whole; further columns,
whatever their names, come along to the last stage; without labels all rows
score 0.5 and stay; an empty table gives no rows, and an empty benchmark removes
none.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from propensa.llm import byte_cnn, decontaminate, near_dedup, packing, repeats
from propensa.llm.queries import WORD_BPE
from propensa.session import written

#: Least probability of good quality that keeps a document.
QUALITY = 0.3


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the byte-level network does not reject."""
    model = byte_cnn.fit_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return byte_cnn.keep(docs, model, QUALITY)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return near_dedup.one_of_each(docs)


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the strings that occur elsewhere; n_chars follows."""
    cut = repeats.remove_repeats(docs)
    return cut.withColumn("n_chars", F.length("text").cast("bigint")) if "n_chars" in docs.columns else cut


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a twentieth of their words in benchmark windows."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of the documents' token pieces in training sequences."""
    return packing.pack(docs, public_tokenizers.path(WORD_BPE), end_id=0, size=2048)


STAGES = [
    ("quality", good_quality),
    ("near_duplicates", near_duplicates),
    ("repeats", repeated_strings),
    ("decontamination", decontaminated),
    ("packing", packed),
]

#: Trained and sampled stages: SQL cannot express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
