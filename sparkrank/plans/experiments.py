"""Experiments and result assembly.

The reference re-runs retrieval once per parameter value (11 alphas) and rebuilds its index
once per (k1, b) pair. Here retrieval runs once: the alpha sweep expands the fused candidate
rows over the alpha list, and the BM25 grid computes every (k1, b) score of a matched
posting in the same aggregation, so the grid costs one shuffle of matched pairs, not twelve.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import join_first_ids, out_score, rank_key
from ..operators import evaluate as E
from ..operators import fusion as FU
from ..operators.lexical import LexicalIndex, bm25_term_score
from ..operators.ordering import best_in_tasks, exact_percentiles, first_n_by, top_k

# The reference's parameter grids.
ALPHAS = [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]
K1_VALUES = [0.9, 1.2, 1.5, 2.0]
B_VALUES = [0.6, 0.75, 0.85]
FAILURE_QUERIES = 200
DISAGREEMENT_TOP = 5
# Disagreement labels and descriptions of the search response.
DISAGREEMENTS = [
    ("BM25-only", "Found by BM25 but not Dense (lexical matches)"),
    ("Dense-only", "Found by Dense but not BM25 (semantic matches)"),
    ("Hybrid-resolved", "Hybrid selected from disagreed results"),
]


def _metrics_cols():
    return [out_score(c).alias(c) for c in ("ndcg", "mrr", "recall")]


def runs_union(runs: dict[str, DataFrame]) -> DataFrame:
    out = None
    for name, r in runs.items():
        part = r.select(F.lit(name).alias("system"), "qid", "doc_id", "rank")
        out = part if out is None else out.unionByName(part)
    return out


def baseline(runs: dict[str, DataFrame], qrels: DataFrame, queries: DataFrame) -> DataFrame:
    """Every system's macro metrics in one pass: ``(system, ndcg, mrr, recall)``."""
    named = queries.sparkSession.createDataFrame([(name,) for name in runs], "system string")
    return E.macro(runs_union(runs), qrels, queries, systems=named).select("system", *_metrics_cols())


def mark_best(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """``is_best`` = highest unrounded nDCG (to 9 places); the first in ``order`` wins ties. The
    metrics are rounded only afterwards, for the output.

    ``df`` has one row per parameter setting; it is persisted so the best-row subquery and
    the rows themselves come from one evaluation of the sweep."""
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    best = df.orderBy(F.round("ndcg", 9).desc(), *[F.col(c).asc() for c in order]).limit(1)
    best_key = best.select(F.struct(*order).alias("k")).scalar()
    return df.select(*order, *_metrics_cols(), (F.struct(*order) == best_key).alias("is_best"))


def alpha_sweep(
    lexical: DataFrame,
    dense: DataFrame,
    qrels: DataFrame,
    queries: DataFrame,
    alphas: Sequence[float] = ALPHAS,
    k: int = E.DEFAULT_K_RECALL,
    method: str = "rrf",
) -> DataFrame:
    """``(alpha, ndcg, mrr, recall, is_best)`` from one pair of runs."""
    fused = FU.hybrid_sweep(lexical, dense, alphas, k=k, method=method)
    named = queries.sparkSession.createDataFrame([(float(a),) for a in alphas], "alpha double")
    return mark_best(E.macro(fused, qrels, queries, by=("alpha",), systems=named), ["alpha"])


def bm25_grid(
    index: LexicalIndex,
    qrels: DataFrame,
    queries: DataFrame,
    k1_values: Sequence[float] = K1_VALUES,
    b_values: Sequence[float] = B_VALUES,
    k: int = E.DEFAULT_K_RECALL,
) -> DataFrame:
    """``(k1, b, ndcg, mrr, recall, is_best)``; postings matched once, all pairs scored in
    one aggregation; what no pair ranks among a task's k best is dropped, the rest expanded and
    ranked per (k1, b, qid)."""
    grid = [(float(k1), float(b)) for k1 in k1_values for b in b_values]
    avgdl = index.scalar("avgdl")
    m = index.matched(queries)
    sums = [
        F.sum(bm25_term_score(F.col("idf"), F.col("tf"), F.col("dl"), avgdl, F.lit(k1), F.lit(b))).alias(f"__s{i}")
        for i, (k1, b) in enumerate(grid)
    ]
    scored = best_in_tasks(m.groupBy("qid", "doc_id").agg(*sums), k, [f"__s{i}" for i in range(len(grid))])
    expanded = scored.select(
        "qid",
        "doc_id",
        F.inline_outer(
            F.array(*[F.struct(F.lit(k1).alias("k1"), F.lit(b).alias("b"), F.col(f"__s{i}").alias("score")) for i, (k1, b) in enumerate(grid)])
        ),
    )
    ranked = top_k(expanded, k, by=("k1", "b", "qid")).select("k1", "b", "qid", "doc_id", rank_key("score").alias("score"), "rank")
    named = queries.sparkSession.createDataFrame(grid, "k1 double, b double")
    return mark_best(E.macro(ranked, qrels, queries, by=("k1", "b"), systems=named), ["k1", "b"])


def latency_summary(latency: DataFrame) -> DataFrame:
    """Per system mean, median, p95, p99 (linear interpolation) and ``qps = 1000 / mean``.

    Exact percentiles without gathering a system's values in one task (see ordering)."""
    pct = exact_percentiles(latency, "ms", {"median_ms": 0.5, "p95_ms": 0.95, "p99_ms": 0.99}, ["system"])
    mean = latency.filter(F.col("ms").isNotNull()).groupBy("system").agg(F.avg("ms").alias("mean_ms"))
    return mean.join(pct, "system").select(
        "system",
        out_score("mean_ms").alias("mean_ms"),
        out_score("median_ms").alias("median_ms"),
        out_score("p95_ms").alias("p95_ms"),
        out_score("p99_ms").alias("p99_ms"),
        out_score(F.lit(1000.0) / F.col("mean_ms")).alias("qps"),
    )


def _hits(run: DataFrame, rel: DataFrame, name: str) -> DataFrame:
    return run.join(rel, ["qid", "doc_id"], "inner").groupBy("qid").agg(F.collect_set("doc_id").alias(name))


def failure_analysis(
    runs: dict[str, DataFrame], qrels: DataFrame, queries: DataFrame, n_queries: int = FAILURE_QUERIES
) -> DataFrame:
    """``(category, qid, query, relevant_found)`` over the first ``n_queries`` queries (by
    qid) that have judgments. ``runs`` has "bm25", "dense", "hybrid" top-k runs. Categories
    overlap: bm25_only, dense_only, both_fail, hybrid_wins; ``relevant_found`` lists up to 3
    relevant ids found (first two categories)."""
    rel = E.relevant_pairs(qrels)
    first = first_n_by(queries.select("qid", "text"), n_queries, "qid").join(rel.select("qid").distinct(), "qid", "left_semi")
    per_q = first
    for name in ("bm25", "dense", "hybrid"):
        per_q = per_q.join(_hits(runs[name].select("qid", "doc_id"), rel, f"__{name}"), "qid", "left")
    def hit(name):
        return F.coalesce(F.size(F.col(f"__{name}")) > 0, F.lit(False))
    b, d, h = hit("bm25"), hit("dense"), hit("hybrid")
    empty = F.lit("")
    cats = F.array(
        F.when(b & ~d, F.struct(F.lit("bm25_only").alias("category"), join_first_ids(F.col("__bm25")).alias("relevant_found"))),
        F.when(d & ~b, F.struct(F.lit("dense_only").alias("category"), join_first_ids(F.col("__dense")).alias("relevant_found"))),
        F.when(~b & ~d, F.struct(F.lit("both_fail").alias("category"), empty.alias("relevant_found"))),
        F.when(h & (~b | ~d), F.struct(F.lit("hybrid_wins").alias("category"), empty.alias("relevant_found"))),
    )
    return (
        per_q.select("qid", F.col("text").alias("query"), F.inline_outer(F.filter(cats, lambda x: x.isNotNull())))
        .filter(F.col("category").isNotNull())
        .select("category", "qid", "query", "relevant_found")
    )


FAILURE_CATEGORIES = ("bm25_only", "dense_only", "both_fail", "hybrid_wins")


def failure_counts(failures: DataFrame) -> DataFrame:
    """``(category, n_queries)`` for every category, 0 where none failed that way."""
    every = failures.sparkSession.range(1).select(F.explode(F.array(*map(F.lit, FAILURE_CATEGORIES))).alias("category"))
    found = failures.groupBy("category").agg(F.count("*").alias("n_queries"))
    return every.join(found, "category", "left").select("category", F.coalesce("n_queries", F.lit(0).cast("long")).alias("n_queries"))


def disagreements(bm25: DataFrame, dense: DataFrame, hybrid: DataFrame, top: int = DISAGREEMENT_TOP) -> DataFrame:
    """``(qid, type, docs, description)`` from the top ``top`` of each list, non-empty only."""
    def tops(run, name):
        return run.filter(F.col("rank") <= top).select("qid", "doc_id", F.lit(name).alias("__s"))

    u = tops(bm25, "b").unionByName(tops(dense, "d")).unionByName(tops(hybrid, "h"))
    sets = u.groupBy("qid").agg(
        *[F.collect_set(F.when(F.col("__s") == s, F.col("doc_id"))).alias(s) for s in ("b", "d", "h")]
    )
    bu = F.array_except("b", "d")
    du = F.array_except("d", "b")
    resolved = F.array_intersect("h", F.array_union(bu, du))
    rows = F.array(*[
        F.struct(F.lit(t).alias("type"), arr.alias("__ids"), F.lit(desc).alias("description"))
        for (t, desc), arr in zip(DISAGREEMENTS, (bu, du, resolved))
    ])
    return (
        sets.select("qid", F.inline_outer(rows))
        .filter(F.col("type").isNotNull() & (F.size("__ids") > 0))
        .select("qid", "type", join_first_ids(F.col("__ids")).alias("docs"), "description")
    )


def report_summary(baseline_df: DataFrame, sweep_df: DataFrame, latency_df: DataFrame) -> DataFrame:
    """One long table ``(experiment, system, metric, value)``."""
    base = baseline_df.select(
        F.lit("baseline").alias("experiment"),
        "system",
        F.inline_outer(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in ("ndcg", "mrr", "recall")])),
    )
    best = sweep_df.filter("is_best").select(
        F.lit("alpha_sweep").alias("experiment"),
        F.lit("hybrid").alias("system"),
        F.inline_outer(F.array(F.struct(F.lit("best_alpha").alias("metric"), F.col("alpha").cast("double").alias("value")),
                               F.struct(F.lit("best_ndcg").alias("metric"), F.col("ndcg").cast("double").alias("value")))),
    )
    lat = latency_df.select(
        F.lit("latency").alias("experiment"),
        "system",
        F.inline_outer(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in ("mean_ms", "p95_ms", "qps")])),
    )
    return base.unionByName(best).unionByName(lat)
