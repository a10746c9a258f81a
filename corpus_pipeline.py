"""A training corpus in five stages, each a DataFrame job over all that the
stage before it kept.

Every stage's rows are written as Parquet and read again as the next one's
input: to the folder that ``spark.checkpoint.dir`` names, which all executors
share, so a lost executor repeats work of one stage at most.  A stage's folder
is deleted once the next stage's rows are written; the last one stays.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ratelens.llm import bpe, lines, simhash, toxicity, winnow
from ratelens.llm.queries import tokenizer
from ratelens.session import checkpoint_dir
from ratelens.sources.tables import read_table


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model doesn't reject."""
    return toxicity.drop_toxic(docs, read_table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the boilerplate lines of their source;
    ``n_chars`` follows the text."""
    return lines.drop_boilerplate(docs, length_col="n_chars")


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each near-duplicate group."""
    return simhash.keep_representatives(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no window with the benchmark."""
    return winnow.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def byte_level_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every remaining document, and the digests of the ids and of
    the bytes decoded from them."""
    return bpe.digests(bpe.round_trip(docs.select("doc_id", "text"), *tokenizer()))


STAGES = [
    ("toxicity", toxicity_filter),
    ("line dedup", line_dedup),
    ("SimHash near-dedup", simhash_near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("byte-level BPE", byte_level_bpe),
]

#: The toxicity model and the tokenizer can't be expressed in SQL; the stages
#: are tested against brute force in tests/llm/test_pipeline.py.
ORACLE_SQL = None


def _delete(spark: SparkSession, path: str) -> None:
    """Remove a folder of the shared file system."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last stage's rows."""
    folder = f"{checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = read_table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{i}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if i:
            _delete(spark, f"{folder}/{i - 1}")  # its rows are in the next stage's folder
    return docs
