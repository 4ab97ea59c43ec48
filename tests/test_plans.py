"""Plan-shape checks: top-k is limited before the shuffle, no unpartitioned windows, the
doc-bucketed index needs no exchange for scoring, and text stays out of scoring stages."""

import re

from sparkrank.operators.lexical import LexicalIndex
from sparkrank.session import scratch_path
from sparkrank.sources import collections as C
from sparkrank.sources import index_store as IS

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_bm25_search_limits_before_shuffle_and_has_partitioned_windows(spark):
    res = LexicalIndex.build(C.corpus(spark, SF)).search(C.queries(spark, SF), k=10)
    p = plan(res)
    assert "WindowGroupLimit" in p
    specs = re.findall(r"windowspecdefinition\((.*?) (?:ASC|DESC)", p)
    assert specs and all(s.startswith("qid#") and "," in s for s in specs)  # partition keys come first


def test_bucketed_index_scores_without_exchange(spark):
    path = scratch_path(spark, "plan-idx")
    IS.save_lexical(LexicalIndex.build(C.corpus(spark, SF)), path, buckets=4)
    idx = IS.load_lexical(spark, path)
    q = C.queries(spark, SF)
    res = idx.search(q, k=10)
    res.collect()
    final = res._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    # exactly one shuffle: the local top-k rows going to the per-qid final limit
    assert final.count("Exchange hashpartitioning") == 1
    assert "Bucketed: true" in idx.postings._jdf.queryExecution().executedPlan().toString() or "bucket" in final.lower()


def test_text_is_not_read_by_the_scoring_scan(spark):
    idx = LexicalIndex.build(C.corpus(spark, SF))
    path = scratch_path(spark, "plan-idx2")
    IS.save_lexical(idx, path, buckets=2)
    res = IS.load_lexical(spark, path).search(C.queries(spark, SF), k=5)
    p = res._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in p.splitlines() if "postings" in line.lower() and "FileScan" in line]
    assert scans and all("text" not in s for s in scans)


def test_clustered_index_shuffles_terms_and_not_text(spark):
    built = LexicalIndex.build(C.corpus(spark, SF), persist=True)
    exchanges = [line for line in built.per_doc._jdf.queryExecution().withCachedData().toString().splitlines() if "Exchange" in line or "Repartition" in line]
    inner = plan(LexicalIndex.build(C.corpus(spark, SF)).per_doc.repartition(4, "doc_id"))
    assert "Exchange hashpartitioning(doc_id" in inner
    above = inner.split("Exchange hashpartitioning(doc_id")[0]
    assert "text#" not in above and all("text#" not in e for e in exchanges)
    built.per_doc.unpersist()
