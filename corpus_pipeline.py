"""A training-corpus pipeline over ``documents``: five stages, each an operator of ``tidemark.llm``.

1. toxicity: rows whose text is scored toxic (0.5 or more) go
2. near_duplicates: one row of each SimHash component stays, the smallest doc_id
3. decontamination: rows whose text holds a benchmark item go
4. pseudonyms: personal data in ``text`` becomes format-preserving pseudonyms (``n_chars`` follows the new text)
5. packing: the texts are tokenised and packed; one row per piece

Every stage takes the rows that the one before it wrote. Null texts count as empty: they are not toxic, have the
fingerprint 0, leak nothing and pack as the end id alone. An empty table gives an empty result at every stage. Stages 1 to 4
carry all columns of their input, whatever their names.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontamination, near_dedup, packing, pseudonyms, toxicity
from tidemark.llm.common import table
from tidemark.session import configure, scratch_path

PSEUDONYM_KEY = "tidemark-demo-key"  # production keys come from a secret store
TOXIC = 0.5


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return docs.where(toxicity.score_column(model) < TOXIC)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.keep_one_each(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    fresh = pseudonyms.pseudonymise(docs, PSEUDONYM_KEY)
    return fresh.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else fresh


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    packed = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))
    return packed.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_leaks),
    ("pseudonyms", replace_personal_data),
    ("packing", pack_sequences),
]

#: Training, connected components and tokenisation are not SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's rows are written as Parquet in the shared folder and read again."""
    docs = table(configure(spark), sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
