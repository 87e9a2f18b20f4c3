"""Corpus preparation: documents in, encoded documents out.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read
again as the next stage's documents. All but the last keep the columns of ``documents``:

1. ``quality``: ordinal classifier; documents with P(grade >= 1) < 0.5 go.
2. ``toxicity``: class-conditional Kneser-Ney models; documents that score 0.3 or more go.
3. ``near_duplicates``: SimHash; of each component the document with the smallest doc_id stays.
4. ``decontaminate``: documents with any benchmark window go.
5. ``encode``: token ids by BPE and their decoded text, as digests.

The classifiers are fitted on the labelled documents among the stage's own input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from roadstats.llm.bpe import default_vocabulary, round_trip
from roadstats.llm.decontaminate import clean_documents
from roadstats.llm.quality import select_documents
from roadstats.llm.simhash import one_of_each
from roadstats.llm.toxicity import without_toxic
from roadstats.session import new_work_dir


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return select_documents(docs, _table(spark, sf_dir, "labels"))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_toxic(docs, _table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return clean_documents(docs, _table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return round_trip(docs, default_vocabulary())


STAGES = [
    ("quality", quality),
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("encode", encode),
]

#: Fitted models and byte-pair merges are not expressible in SQL; tests compare by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each returns is written to the shared folder."""
    root = new_work_dir(spark, "pipeline")
    docs = _table(spark, sf_dir, "documents")
    for n, (name, stage) in enumerate(STAGES):
        path = f"{root}/{n}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
