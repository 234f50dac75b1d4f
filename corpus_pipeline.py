"""Documents to packed sequences: filter, one of each near-duplicate group, passages, mix, pack.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and
read again as the next one's ``docs``; all but the last return the columns of documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.llm import jaccard, mixing, packing, quality, substring, tokens
from corvane.llm._storage import shared_folder


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    kept = quality.judge(docs, carry=tuple(docs.columns)).filter("kept")
    return kept.select(*(F.col(f"carry_{i}").alias(c) for i, c in enumerate(docs.columns)))


def jaccard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return jaccard.keep_one(docs)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without their repeated passages; what keeps no word goes. Untouched texts stay as they are."""
    others = [c for c in docs.columns if c != "text"]
    done = substring.remove_repeats(docs, carry=tuple(others), with_text=True).filter("n_words > n_removed or n_removed = 0")
    new = {c: F.col("kept_text") if c == "text" else F.col(f"carry_{others.index(c)}") for c in docs.columns}
    if "n_chars" in new:
        new["n_chars"] = F.when(F.col("n_removed") > 0, F.char_length("kept_text").cast(docs.schema["n_chars"].dataType)).otherwise(new["n_chars"])
    return done.select(*(x.alias(c) for c, x in new.items()))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target takes it."""
    return mixing.apply_mix(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token ids and their places in sequences."""
    return packing.pack(docs, tokens.public_path(), with_ids=True).withColumnRenamed("id", "doc_id")


STAGES = [
    ("quality rules", quality_stage),
    ("jaccard join", jaccard_stage),
    ("substring dedup", substring_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: Expectation-maximisation, tokenizers and packing are beyond SQL; the tests hold run() against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. Each stage's files go when the next one has been written."""
    shared_folder(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{i}")
        docs = spark.read.parquet(f"{folder}/{i}")
        if i:
            path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{i - 1}")
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return docs
