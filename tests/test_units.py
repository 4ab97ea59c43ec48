"""Hand-computed edge cases (FIXTURES.md) and independent re-statements of the formulas."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkrank.functions.text import snippet, tokenize
from sparkrank.operators import evaluate as E
from sparkrank.operators import fusion as FU
from sparkrank.operators.lexical import LexicalIndex
from sparkrank.operators.ordering import exact_percentiles


def test_tokenize_unicode_and_punctuation(spark):
    df = spark.createDataFrame([("Héllo wörld_1 ß, señor 42!",), ("?!.,",), ("",)], "t string")
    out = [r[0] for r in df.select(tokenize("t")).collect()]
    assert out == [["héllo", "wörld_1", "ß", "señor", "42"], [], []]


def _index(spark, docs):
    return LexicalIndex.build(spark.createDataFrame(docs, "doc_id long, text string"))


def test_empty_document_counts_in_stats_but_has_no_postings(spark):
    idx = _index(spark, [(1, "a b c"), (2, "..."), (3, "a")])
    n, total, avgdl = idx.corpus_stats.select("n", "total_dl", "avgdl").first()
    assert (n, total) == (3, 4) and avgdl == pytest.approx(4 / 3)
    assert sorted(r[0] for r in idx.postings.select("doc_id").distinct().collect()) == [1, 3]


def _bm25_python(docs, query, k1=1.2, b=0.75):
    import re

    toks = {d: re.findall(r"\w+", t.lower()) for d, t in docs}
    n = len(toks)
    avgdl = sum(map(len, toks.values())) / n
    df = {}
    for ts in toks.values():
        for w in set(ts):
            df[w] = df.get(w, 0) + 1
    scores = {}
    for w in set(re.findall(r"\w+", query.lower())):
        if w not in df:
            continue
        idf = math.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5))
        for d, ts in toks.items():
            tf = ts.count(w)
            if tf:
                scores[d] = scores.get(d, 0.0) + idf * tf * (k1 + 1) / (tf + k1 * (1 - b + b * len(ts) / avgdl))
    return scores


def test_bm25_matches_python_restatement_and_repeated_terms_count_once(spark):
    docs = [(1, "the cat sat on the mat"), (2, "the dog"), (3, "cat cat cat dog"), (4, "")]
    idx = _index(spark, docs)
    q = spark.createDataFrame([(1, "cat the"), (2, "cat cat the the"), (3, "   "), (4, "zzz")], "qid long, text string")
    got = {(r.qid, r.doc_id): r.score for r in idx.search(q, k=10).collect()}
    want = _bm25_python(docs, "cat the")
    for d, s in want.items():
        assert got[(1, d)] == pytest.approx(s, abs=1e-6)
        assert got[(2, d)] == pytest.approx(s, abs=1e-6)  # repeated query terms count once
    assert not any(q in (3, 4) for q, _ in got)  # blank / unknown query: no rows


def test_snippet_rules(spark):
    long_nospace = "x" * 201
    spaced = ("word " * 60).strip()
    df = spark.createDataFrame([(long_nospace,), (spaced,), ("short",)], "t string")
    out = [r[0] for r in df.select(snippet("t")).collect()]
    assert out[0] == "x" * 200 + "..."
    assert out[1] == spaced[:200].rsplit(" ", 1)[0] + "..."
    assert out[2] == "short"


def test_min_max_constant_single_and_one_sided_fusion(spark):
    lex = spark.createDataFrame([(1, 10, 2.0, 1), (1, 11, 2.0, 2), (2, 20, 5.0, 1)], "qid long, doc_id long, score double, rank int")
    norm = {(r.qid, r.doc_id): r.norm for r in FU.min_max(lex).collect()}
    assert norm == {(1, 10): 1.0, (1, 11): 1.0, (2, 20): 1.0}
    dense = spark.createDataFrame([], "qid long, doc_id long, distance double, rank int")
    fused = FU.hybrid(lex, dense, alpha=0.5, k=10, method="min_max").collect()
    assert sorted((r.qid, r.doc_id, r.score) for r in fused) == [(1, 10, 0.5), (1, 11, 0.5), (2, 20, 0.5)]


def test_rrf_rank_is_zero_based(spark):
    a = spark.createDataFrame([(1, 7, 3.0, 1)], "qid long, doc_id long, score double, rank int")
    out = FU.rrf([a], k=10).first()
    assert out.score == pytest.approx(1 / 60)


def test_weighted_rrf_alpha_extremes_keep_list_order(spark):
    lex = spark.createDataFrame([(1, d, 10.0 - r, r) for r, d in enumerate([5, 3, 9], start=1)], "qid long, doc_id long, score double, rank int")
    den = spark.createDataFrame([(1, d, float(r), r) for r, d in enumerate([8, 5, 1], start=1)], "qid long, doc_id long, distance double, rank int")
    a1 = [r.doc_id for r in FU.hybrid(lex, den, alpha=1.0, k=10).orderBy("rank").collect()]
    a0 = [r.doc_id for r in FU.hybrid(lex, den, alpha=0.0, k=10).orderBy("rank").collect()]
    assert a1[:3] == [5, 3, 9] and a0[:3] == [8, 5, 1]


def _run(spark, rows):
    return spark.createDataFrame(rows, "system string, qid long, doc_id long, rank int")


def test_ndcg_ideal_from_retrieved_and_mrr_recall(spark):
    run = _run(spark, [("s", 1, 1, 1), ("s", 1, 2, 2), ("s", 1, 3, 3)])
    qrels = spark.createDataFrame([(1, d, 1) for d in (1, 3, 100, 101, 102)], "qid long, doc_id long, rel int")
    r = E.per_query(run, qrels, k_ndcg=3).first()
    assert r.ndcg == pytest.approx((1 + 1 / 2) / (1 + 1 / math.log2(3)), abs=1e-6)  # 0.919721
    assert r.mrr == 1.0
    assert r.recall == pytest.approx(2 / 5)  # judged docs outside the corpus stay in the denominator
    j = E.per_query(run, qrels, k_ndcg=3, ideal="judged").first()
    assert j.ndcg == pytest.approx((1 + 1 / 2) / (1 + 1 / math.log2(3) + 1 / 2), abs=1e-6)


def test_mrr_first_hit_beyond_k_is_zero_and_unretrieved_judged_query_counts_zero(spark):
    run = _run(spark, [("s", 1, d, d) for d in range(1, 12)])
    qrels = spark.createDataFrame([(1, 11, 1), (2, 5, 1), (3, 6, 0)], "qid long, doc_id long, rel int")
    m = E.macro(run, qrels).first()
    assert m.mrr == 0.0 and m.n_queries == 2  # qid 3 has no relevant doc: skipped
    assert m.recall == pytest.approx(0.5)  # qid 1 recall 1 (rank 11 <= 100), qid 2 unretrieved: 0


def test_exact_percentiles_match_numpy_with_hot_group(spark):
    rng = np.random.default_rng(0)
    hot = rng.normal(50, 10, 3000).round(2)
    cold = rng.exponential(5, 200).round(2)
    rows = [("hot", float(v)) for v in hot] + [("cold", float(v)) for v in cold]
    df = spark.createDataFrame(rows, "system string, ms double")
    got = {r.system: r for r in exact_percentiles(df, "ms", {"p50": 0.5, "p95": 0.95, "p99": 0.99}, ["system"]).collect()}
    for name, vals in (("hot", hot), ("cold", cold)):
        for col, p in (("p50", 50), ("p95", 95), ("p99", 99)):
            assert getattr(got[name], col) == pytest.approx(float(np.percentile(vals, p)), abs=1e-9)


def test_incremental_add_equals_rebuild_and_rejects_known_ids(spark):
    docs = [(i, f"w{i % 7} w{i % 3} common") for i in range(30)]
    full = _index(spark, docs)
    part = _index(spark, docs[:10])
    added, rejected = part.add_documents(spark.createDataFrame(docs[5:], "doc_id long, text string"))
    assert sorted(r[0] for r in rejected.collect()) == list(range(5, 10))
    key = lambda df: sorted(map(tuple, df.collect()))
    assert key(added.term_stats) == key(full.term_stats)
    assert key(added.corpus_stats.select("n", "total_dl")) == key(full.corpus_stats.select("n", "total_dl"))


def test_text_qrels_matches_brute_force_including_passages_without_whole_tokens(spark):
    from sparkrank.sources import collections as C

    docs = [(1, "hello world, again"), (2, "xxabcxx yy"), (3, "the cat sat on the mat"), (4, ""), (5, "wait... what")]
    queries = [(10, "lo wo"), (11, "abc"), (12, "cat sat on"), (13, "t sat o"), (14, "nothing here"), (15, "...")]
    corpus = spark.createDataFrame(docs, "doc_id long, text string")
    qs = spark.createDataFrame(queries, "qid long, text string")
    idx = LexicalIndex.build(corpus)
    got = sorted((r.qid, r.doc_id) for r in C.text_qrels(corpus, qs, idx.postings, idx.term_stats).collect())
    want = sorted((q, d) for q, qt in queries for d, dt in docs if qt in dt)
    assert (15, 5) in want and got == want
