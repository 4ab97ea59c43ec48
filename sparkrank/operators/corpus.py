"""Coverage-guaranteed corpus preparation.

The reference streams the collection once, always writing judged-relevant documents and
writing others while fewer than ``target`` documents are written. For unique ids that is
exactly: the first ``target`` documents in input order, plus every relevant document — a
distributed "first n" (no single-task sort) unioned with a semi-join. The result may exceed
``target``; that is kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..session import broadcast_if_small, written
from .ordering import first_n_by

# Coverage grade thresholds.
EXCELLENT = 0.95
GOOD = 0.80


def relevant_docs(qrels: DataFrame) -> DataFrame:
    """Distinct ``doc_id`` judged relevant (``rel > 0``)."""
    return qrels.filter(F.col("rel") > 0).select("doc_id").distinct()


def covered_corpus(docs: DataFrame, qrels: DataFrame, target: int, order: str = "doc_id") -> DataFrame:
    """First ``target`` documents by ``order`` plus every relevant document (unique ids).

    Works on ids only (first-n positions over the id column, union with the relevant ids,
    distinct), then streams the corpus through one semi-join with the kept ids (broadcast
    after a size check), so document text is never shuffled."""
    rel = relevant_docs(qrels)
    first_ids = first_n_by(docs.select(order), target, order).select(F.col(order).alias("doc_id"))
    keep = first_ids.unionByName(rel).distinct()
    return docs.join(broadcast_if_small(keep), "doc_id", "left_semi")


def missing_relevant(covered: DataFrame, qrels: DataFrame) -> DataFrame:
    """Relevant documents absent from the prepared corpus."""
    return relevant_docs(qrels).join(covered.select("doc_id"), "doc_id", "left_anti")


def coverage(covered: DataFrame, qrels: DataFrame, queries: DataFrame) -> DataFrame:
    """P4 + P5: one row of counts, the coverage ratio and its grade."""
    rel = relevant_docs(qrels).withColumn("__rel", F.lit(True))
    c = covered.select("doc_id").join(rel, "doc_id", "left").agg(
        F.count(F.lit(1)).alias("n_corpus"),
        F.count(F.when(F.col("__rel"), 1)).alias("n_relevant_written"),
    )
    n_rel = relevant_docs(qrels).agg(F.count(F.lit(1)).alias("n")).select("n").scalar()
    n_qrels = qrels.agg(F.count(F.lit(1)).alias("n")).select("n").scalar()
    n_queries = queries.agg(F.count(F.lit(1)).alias("n")).select("n").scalar()
    return c.select(*_summary(F.col("n_corpus"), F.col("n_relevant_written"), n_rel, n_queries, n_qrels))


def _summary(n_corpus: Column, n_written: Column, n_rel: Column, n_queries: Column, n_qrels: Column) -> list[Column]:
    ratio = F.when(n_rel > 0, n_written / n_rel).otherwise(F.lit(0.0))
    return [
        n_corpus.alias("n_corpus"),
        n_written.alias("n_relevant_written"),
        (n_corpus - n_written).alias("n_sampled"),
        n_rel.alias("n_relevant"),
        n_queries.alias("n_queries"),
        n_qrels.alias("n_qrels"),
        F.round(ratio, 6).alias("coverage"),
        F.when(ratio >= EXCELLENT, "excellent").when(ratio >= GOOD, "good").otherwise("poor").alias("grade"),
    ]


def prepare_corpus(docs: DataFrame, qrels: DataFrame, queries: DataFrame, target: int, path: str, order: str = "doc_id") -> DataFrame:
    """P2, P4 and P5 together: write the covered corpus below ``path``, return its summary row.

    The judgments are read once, the corpus once for its ids and once for the rows written; the
    counts are observed by the very jobs that write (in their last stages, where a task retried
    counts once), so nothing written is read again for them. The columns are those of ``docs``,
    which are not renamed or added to; the summary is that of ``coverage``.
    """
    spark = docs.sparkSession
    judged, judgments = Observation(), qrels.groupBy("doc_id").agg(F.max(F.coalesce(F.col("rel") > 0, F.lit(False))).alias("rel"), F.count("*").alias("n"))
    judgments = judgments.observe(judged, F.coalesce(F.sum("n"), F.lit(0)).alias("n_qrels"), F.count_if("rel").alias("n_relevant"))
    relevant = written(judgments, "judged").where("rel").select("doc_id", "rel")
    first = first_n_by(docs.select(order), target, order).select(F.col(order).alias("doc_id"), F.lit(False).alias("rel"))
    flag = "__relevant"
    while flag in docs.columns:
        flag += "_"
    keep = written(first.unionByName(relevant).groupBy("doc_id").agg(F.max("rel").alias(flag)), "kept-ids")
    kept = Observation()
    rows = docs.join(broadcast_if_small(keep), "doc_id").observe(kept, F.count("*").alias("n_corpus"), F.count_if(flag).alias("n_relevant_written"))
    rows.select(*docs.columns).write.parquet(path)
    counts = {**judged.get, **kept.get, "n_queries": queries.count()}
    lit = lambda c: F.lit(counts[c]).cast("long")
    return spark.range(1).select(*_summary(*map(lit, ("n_corpus", "n_relevant_written", "n_relevant", "n_queries", "n_qrels"))))
