"""Properties from SURVEY §5 on the driver's small tables."""

from pyspark.sql import functions as F

from sparkrank.operators import evaluate as E
from sparkrank.operators import fusion as FU
from sparkrank.plans import catalog
from sparkrank.plans import experiments as X
from sparkrank.sources import collections as C

SF = "/root/testdata/sf0.001"


def test_grid_at_default_parameters_equals_plain_bm25(spark):
    idx = catalog.lexical_index(spark, SF)
    qrels, qs = catalog.text_qrels(spark, SF, idx), C.queries(spark, SF)
    grid = X.bm25_grid(idx, qrels, qs, k1_values=[1.2], b_values=[0.75], k=100).first()
    plain = E.macro(catalog.bm25_run(spark, SF, 100, idx).withColumn("system", F.lit("bm25")), qrels, qs).first()
    assert (grid.ndcg, grid.mrr, grid.recall) == (round(plain.ndcg, 6), round(plain.mrr, 6), round(plain.recall, 6))


def test_failure_categories_relations(spark):
    rows = catalog.q_failure_analysis(spark, SF).collect()
    cats = {}
    for r in rows:
        cats.setdefault(r.category, set()).add(r.qid)
    hybrid_wins, both_fail = cats.get("hybrid_wins", set()), cats.get("both_fail", set())
    assert hybrid_wins <= cats.get("bm25_only", set()) | cats.get("dense_only", set())
    assert not (hybrid_wins & both_fail)


def test_metrics_in_unit_interval_and_hybrid_within_union(spark):
    for r in catalog.q_eval_per_query(spark, SF).collect():
        assert 0.0 <= r.ndcg <= 1.0 and 0.0 <= r.mrr <= 1.0 and 0.0 <= r.recall <= 1.0
    bm25 = catalog.bm25_run(spark, SF, 10)
    dense = catalog.dense_text_run(spark, SF, 10)
    hyb = FU.hybrid(bm25, dense, alpha=0.5, k=10)
    union = bm25.select("qid", "doc_id").union(dense.select("qid", "doc_id"))
    assert hyb.select("qid", "doc_id").subtract(union).count() == 0


def test_persisted_in_plan_index_scores_without_exchange(spark):
    idx = catalog.lexical_index(spark, SF)
    res = idx.search(C.queries(spark, SF), k=10)
    res.collect()
    final = res._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    # The only runtime shuffles of the search: the local top-k rows (by qid). The per-(qid,
    # doc_id) sum reads the doc-clustered cache directly.
    agg_line = [line for line in final.splitlines() if "HashAggregate(keys=[qid" in line]
    assert agg_line
    below = final.split(agg_line[0], 1)[1].splitlines()[:3]
    assert not any("Exchange hashpartitioning(qid" in line for line in below)
