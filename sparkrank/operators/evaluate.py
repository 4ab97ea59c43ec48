"""Evaluation of run tables against judgments.

A *run* is ``(system, qid, doc_id, score, rank)`` with 1-based ranks; any number of systems
(or parameter settings, as extra grouping columns) are evaluated in one pass. Judgments are
``qrels(qid, doc_id, rel)``; relevance is binary (``rel > 0``), as in the reference.

* nDCG@k: DCG = sum over hits of ``1 / log2(rank + 1)``; the ideal DCG re-sorts the
  *retrieved* gains (``ideal="retrieved"``, the reference's behaviour: documents never
  retrieved cost nothing), or uses ``min(|relevant|, k)`` ideal hits (``ideal="judged"``).
* MRR@k: ``1 / rank`` of the first hit within k, else 0.
* Recall@k: hits within k / all judged-relevant documents (including ones not in the corpus).
* Macro means over *judged* queries only; a judged query with no retrieved rows counts 0,
  which is a sum over the run divided by the number of judged queries (no cross product of
  queries and systems is ever built).

Plan: the run (top-k per query, small) is joined with the relevant pairs on (qid, doc_id),
then one hash aggregation per (system, qid) and one per system.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_K_NDCG = 10
DEFAULT_K_MRR = 10
DEFAULT_K_RECALL = 100


def retrieval_depth(k_ndcg: int = DEFAULT_K_NDCG, k_mrr: int = DEFAULT_K_MRR, k_recall: int = DEFAULT_K_RECALL) -> int:
    """E5: how deep each system must retrieve for all three metrics."""
    return max(k_ndcg, k_mrr, k_recall)


def relevant_pairs(qrels: DataFrame) -> DataFrame:
    return qrels.filter(F.col("rel") > 0).select("qid", "doc_id").distinct()


def judged_queries(qrels: DataFrame, queries: DataFrame | None = None) -> DataFrame:
    """``(qid, n_rel)`` for queries with at least one relevant document (and in ``queries``)."""
    j = relevant_pairs(qrels).groupBy("qid").agg(F.count(F.lit(1)).alias("n_rel"))
    if queries is not None:
        j = j.join(queries.select("qid"), "qid", "left_semi")
    return j


def ideal_dcg(h) -> "F.Column":
    """Sum of ``1 / log2(j + 1)`` for j = 1..h (0 when h = 0)."""
    return F.when(
        h > 0,
        F.aggregate(F.sequence(F.lit(1), F.greatest(h, F.lit(1))), F.lit(0.0), lambda acc, j: acc + F.lit(1.0) / F.log2(j + 1)),
    ).otherwise(F.lit(0.0))


def per_query(
    run: DataFrame,
    qrels: DataFrame,
    queries: DataFrame | None = None,
    by: Sequence[str] = ("system",),
    k_ndcg: int = DEFAULT_K_NDCG,
    k_mrr: int = DEFAULT_K_MRR,
    k_recall: int = DEFAULT_K_RECALL,
    ideal: str = "retrieved",
) -> DataFrame:
    """E1-E3 per (by..., qid) for judged queries that have retrieved rows."""
    if ideal not in ("retrieved", "judged"):
        raise ValueError(f"ideal must be 'retrieved' or 'judged', got {ideal!r}")
    by = list(by)
    judged = judged_queries(qrels, queries)
    rel = relevant_pairs(qrels).withColumn("__hit", F.lit(True))
    r = run.join(judged, "qid").join(rel, ["qid", "doc_id"], "left")
    hit = F.coalesce(F.col("__hit"), F.lit(False))
    rank = F.col("rank")
    agg = r.groupBy(*by, "qid", "n_rel").agg(
        F.sum(F.when(hit & (rank <= k_ndcg), F.lit(1.0) / F.log2(rank + 1)).otherwise(F.lit(0.0))).alias("__dcg"),
        F.count(F.when(hit & (rank <= k_ndcg), 1)).alias("__h"),
        F.min(F.when(hit & (rank <= k_mrr), rank)).alias("__first"),
        F.count(F.when(hit & (rank <= k_recall), 1)).alias("__rh"),
    )
    h = F.col("__h") if ideal == "retrieved" else F.least(F.col("n_rel"), F.lit(k_ndcg))
    idcg = ideal_dcg(h)
    return agg.select(
        *by,
        "qid",
        F.when(idcg > 0, F.col("__dcg") / idcg).otherwise(F.lit(0.0)).alias("ndcg"),
        F.coalesce(F.lit(1.0) / F.col("__first"), F.lit(0.0)).alias("mrr"),
        (F.col("__rh") / F.col("n_rel")).alias("recall"),
    )


def macro(
    run: DataFrame,
    qrels: DataFrame,
    queries: DataFrame | None = None,
    by: Sequence[str] = ("system",),
    k_ndcg: int = DEFAULT_K_NDCG,
    k_mrr: int = DEFAULT_K_MRR,
    k_recall: int = DEFAULT_K_RECALL,
    ideal: str = "retrieved",
    systems: DataFrame | None = None,
) -> DataFrame:
    """Macro means per system over judged queries: ``(by..., ndcg, mrr, recall, n_queries)``.

    Every system has a row: one that retrieved nothing for any judged query scores 0.0, as does
    every system when no query is judged. ``systems (by...)`` names them where a run may be empty;
    without it they are those that occur in the run.
    """
    by = list(by)
    pq = per_query(run, qrels, queries, by, k_ndcg, k_mrr, k_recall, ideal)
    n = judged_queries(qrels, queries).agg(F.count(F.lit(1)).alias("n")).select("n").scalar()
    nz = F.when(n > 0, n)
    sums = pq.groupBy(*by).agg(
        F.sum("ndcg").alias("__ndcg"), F.sum("mrr").alias("__mrr"), F.sum("recall").alias("__recall")
    )
    every = (run if systems is None else systems).select(*by).distinct()
    same = [every[c].eqNullSafe(sums[c]) for c in by]
    return every.join(sums, same, "left").select(
        *(every[c] for c in by),
        F.coalesce(F.col("__ndcg") / nz, F.lit(0.0)).alias("ndcg"),
        F.coalesce(F.col("__mrr") / nz, F.lit(0.0)).alias("mrr"),
        F.coalesce(F.col("__recall") / nz, F.lit(0.0)).alias("recall"),
        n.alias("n_queries"),
    )
