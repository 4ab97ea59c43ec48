"""Fusion of ranked lists.

Inputs are run tables ``(qid, doc_id, score | distance, rank)`` (rank 1-based). Fusion is one
union of the two (or more) runs plus one hash aggregation on (qid, doc_id) — no join — and a
canonical top-k. Min-max statistics are windows partitioned by qid over top-k lists (small).

* F1 min-max: ``(s - min) / (max - min)``; distances are inverted ``(max - s) / (max - min)``;
  when ``max == min`` every document of the list gets 1.0.
* F2 reciprocal rank: ``1 / (rank0 + 60)`` with the 0-based rank (the best gets 1/60).
* F3 candidate union; a document missing from one side gets 0.0 from it.
* F4 ``alpha * lexical + (1 - alpha) * dense`` with ``method`` "rrf" (default) or "min_max".
* F5 unweighted RRF: ``sum over systems of 1 / (rank0 + rrf_k)`` over any number of runs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import rank_key
from .ordering import top_k

# Fixed value: the reciprocal-rank constant.
RRF_K = 60
METHODS = ("rrf", "min_max")


def min_max(run: DataFrame, score: str = "score", invert: bool = False, by: Sequence[str] = ("qid",)) -> DataFrame:
    """F1 over each list; uses the quantised score so ties are decided the same everywhere."""
    w = Window.partitionBy(*by)
    s = rank_key(score)
    lo, hi = F.min(s).over(w), F.max(s).over(w)
    num = (hi - s) if invert else (s - lo)
    return run.withColumn("norm", F.when(hi == lo, F.lit(1.0)).otherwise(num / (hi - lo)))


def reciprocal_rank(run: DataFrame, rrf_k: int = RRF_K) -> DataFrame:
    """``1 / (rank - 1 + rrf_k)``."""
    return run.withColumn("norm", F.lit(1.0) / (F.col("rank") - 1 + F.lit(rrf_k)))


def hybrid(
    lexical: DataFrame,
    dense: DataFrame,
    alpha: float = 0.5,
    k: int = 10,
    method: str = "rrf",
    lexical_score: str = "score",
    dense_score: str = "distance",
    dense_is_distance: bool = True,
) -> DataFrame:
    """F3 + F4: fused top-k ``(qid, doc_id, score, rank)``."""
    if method not in METHODS:
        raise ValueError(f"unknown fusion method {method!r}; expected one of {METHODS}")
    if method == "rrf":
        a, b = reciprocal_rank(lexical), reciprocal_rank(dense)
    else:
        a = min_max(lexical, lexical_score, invert=False)
        b = min_max(dense, dense_score, invert=dense_is_distance)
    both = a.select("qid", "doc_id", F.col("norm").alias("__lex"), F.lit(None).cast("double").alias("__den")).unionByName(
        b.select("qid", "doc_id", F.lit(None).cast("double").alias("__lex"), F.col("norm").alias("__den"))
    )
    fused = both.groupBy("qid", "doc_id").agg(
        (
            F.lit(float(alpha)) * F.coalesce(F.max("__lex"), F.lit(0.0))
            + F.lit(1.0 - float(alpha)) * F.coalesce(F.max("__den"), F.lit(0.0))
        ).alias("score")
    )
    return top_k(fused, k).select("qid", "doc_id", rank_key("score").alias("score"), "rank")


def hybrid_sweep(
    lexical: DataFrame,
    dense: DataFrame,
    alphas: Sequence[float],
    k: int = 10,
    method: str = "rrf",
    dense_is_distance: bool = True,
) -> DataFrame:
    """F4 for many alphas from ONE pair of runs: the normalised candidates are computed once,
    then each candidate row is expanded over the alpha list (a generator, not a join) and
    ranked per (alpha, qid). Output ``(alpha, qid, doc_id, score, rank)``."""
    if method not in METHODS:
        raise ValueError(f"unknown fusion method {method!r}; expected one of {METHODS}")
    if method == "rrf":
        a, b = reciprocal_rank(lexical), reciprocal_rank(dense)
    else:
        a, b = min_max(lexical, "score"), min_max(dense, "distance", invert=dense_is_distance)
    both = a.select("qid", "doc_id", F.col("norm").alias("__lex"), F.lit(None).cast("double").alias("__den")).unionByName(
        b.select("qid", "doc_id", F.lit(None).cast("double").alias("__lex"), F.col("norm").alias("__den"))
    )
    cand = both.groupBy("qid", "doc_id").agg(
        F.coalesce(F.max("__lex"), F.lit(0.0)).alias("__lex"), F.coalesce(F.max("__den"), F.lit(0.0)).alias("__den")
    )
    grid = cand.withColumn("alpha", F.explode(F.array(*[F.lit(float(x)) for x in alphas])))
    fused = grid.withColumn("score", F.col("alpha") * F.col("__lex") + (F.lit(1.0) - F.col("alpha")) * F.col("__den"))
    return top_k(fused, k, by=("alpha", "qid")).select("alpha", "qid", "doc_id", rank_key("score").alias("score"), "rank")


def rrf(runs: Sequence[DataFrame], k: int = 10, rrf_k: int = RRF_K) -> DataFrame:
    """unweighted reciprocal-rank fusion of any number of runs."""
    parts = [reciprocal_rank(r.select("qid", "doc_id", "rank"), rrf_k).select("qid", "doc_id", "norm") for r in runs]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    fused = u.groupBy("qid", "doc_id").agg(F.sum("norm").alias("score"))
    return top_k(fused, k).select("qid", "doc_id", rank_key("score").alias("score"), "rank")
