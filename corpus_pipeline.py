"""A corpus pipeline: five stages over ``documents``, each on all that its predecessor kept.

1. toxicity: documents that the classifier rejects go. It learns from ``labels`` as ``op9_toxicity`` does.
2. exact_dedup: of equal texts one document stays.
3. near_dedup: of every group of near copies (five-word shingles, Jaccard similarity of 0.8 or more) one stays.
4. decontaminate: passages of ten or more words of ``benchmark`` are cut out of the texts, documents that consist
   of them for the most part go.
5. mix: the rest in the order of a schedule that holds every source to its target weight.

All stages but the last return the columns of ``documents``. ``n_chars`` follows the text where a stage cuts it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lanemart.llm import decontaminate, exact_dedup, mixing, simhash, toxicity
from lanemart.llm.common import forget, remainder, remove, shared_folder, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), remainder("doc_id", 5) != 0)
    scored = toxicity.score(docs, model, name="__toxic")
    return scored.filter(F.col("__toxic") < 0.5).drop("__toxic")


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.deduplicate(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.deduplicate(docs)


def cut_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cleaned = decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))
    return cleaned.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs).orderBy("slot", "offset")


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("decontaminate", cut_benchmark),
    ("mix", mix_sources),
]

#: The classifier, the fingerprints and the automaton have no SQL; tests compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; what a stage returns is written as Parquet and read by the next one.

    A stage's files go when the next stage has been written; those of the last one are the result's.
    """
    docs, before = table(spark, sf_dir, "documents"), None
    folder = f"{shared_folder(spark)}/corpus-{uuid.uuid4().hex}"
    for n, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{n}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            remove(spark, before)
        before = path
        forget(spark)
    return docs
