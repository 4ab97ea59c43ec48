"""Corpus cleaning: toxicity, near duplicates, contamination, personal data, token ids.

``STAGES`` lists ``(name, function)``; each function takes ``(spark, docs, sf_dir)`` and
returns a DataFrame, which is written as Parquet and read again as the next one's ``docs``.
All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkrank.llm.common import cut, free, prepare, table, without_rows
from sparkrank.llm.decontam import contaminated, contamination
from sparkrank.llm.pieces import encoded_documents
from sparkrank.llm.pii import redact_pii
from sparkrank.llm.simhash import one_of_each
from sparkrank.llm.toxicity import THRESHOLD, score, train_on_open_fold


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is below the threshold."""
    prepare(spark)
    model = train_on_open_fold(docs, table(spark, sf_dir, "labels"))
    p = free(docs, "_toxicity")
    return score(docs, model, out=p).where(F.col(p) < THRESHOLD).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component: the one with the smallest id."""
    prepare(spark)
    return one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the benchmark's windows do not contaminate."""
    prepare(spark)
    found = contamination(docs, table(spark, sf_dir, "benchmark"))
    return without_rows(docs, cut(found.where(contaminated()).select("doc_id", "h"), "contaminated"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind; ``n_chars`` is that of the new text."""
    prepare(spark)
    clean = redact_pii(docs)
    return clean.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars"))).select(*docs.columns)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and the digest of the text they decode to."""
    prepare(spark)
    return encoded_documents(docs, public_tokenizers.path("piece_bpe_32k.model"), cache_parts=80_000)  # beside four other stages' memory


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("pieces", pieces),
]

#: The models, hashes and tokenizer of the stages cannot be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, in order, over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = cut(docs, f"stage-{name}")
    return docs
