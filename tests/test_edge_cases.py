"""Small inputs on which rounding, types, empty batches or shared prefixes matter."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sparkrank.operators import dense as D
from sparkrank.operators import evaluate as E
from sparkrank.operators import fusion as FU
from sparkrank.operators.ivf import IVFIndex
from sparkrank.operators.lexical import LexicalIndex
from sparkrank.operators.ordering import first_n_by, prefix_positions
from sparkrank.plans import experiments as X
from sparkrank.plans import search as S
from sparkrank.session import scratch_path
from sparkrank.streaming.indexing import StreamingIndexer


def test_positions_of_ids_that_share_a_long_prefix(spark):
    n = 100_000
    ids = spark.range(n).select(F.format_string("https://example.org/%09d", "id").alias("v"))
    pos = prefix_positions(ids.withColumn("g", F.lit(0)), "v", None, ["g"], buckets=16)
    got = pos.select("__start", F.substring("v", -9, 9).cast("long").alias("want"))
    assert got.where("__start != want").count() == 0 and got.count() == n
    spread = ids.repartitionByRange(16, "v").groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(spread) == 16 and max(r["count"] for r in spread) < n / 8
    assert sorted(r.v for r in first_n_by(ids, 3, "v").collect()) == [f"https://example.org/{i:09d}" for i in range(3)]


def test_knn_with_string_ids_and_bad_query_vectors(spark):
    vectors = spark.createDataFrame([("b", [0.0, 1.0]), ("a", [0.0, 1.0]), ("c", [1.0, 0.0]), ("bad", None), ("long", [1.0, 2.0, 3.0])], "doc_id string, embedding array<double>").coalesce(1)
    queries = spark.createDataFrame([("q1", [0.0, 1.0]), ("q2", [1.0, 2.0, 3.0]), ("q3", None)], "qid string, embedding array<double>")
    got = [(r.qid, r.doc_id, r.distance, r["rank"]) for r in D.knn(vectors, queries, k=2).orderBy("rank").collect()]
    assert got == [("q1", "a", 0.0, 1), ("q1", "b", 0.0, 2)]
    assert D.knn(vectors.limit(0), queries, k=2).count() == 0


def test_running_topk_equals_plain_search(spark, monkeypatch):
    monkeypatch.setattr(D, "MAX_BLOCK_CELLS", 40)
    rng = np.random.default_rng(0)
    rows, asks = rng.normal(size=(90, 4)), rng.normal(size=(25, 4))
    top = D._TopK(3, asks, pa.array(range(25)))
    for a in range(0, 90, 30):
        norms = np.linalg.norm(rows[a : a + 30], axis=1)
        top.add(rows[a : a + 30], np.arange(a, a + 30), norms.min(), norms.max())
    want = np.argsort(((rows[None] - asks[:, None]) ** 2).sum(2), axis=1, kind="stable")[:, :3]
    assert (top.i.reshape(25, 3) == want).all()
    far = top.i.copy()
    top.add(np.full((5, 4), np.nan), np.arange(5), 1e6, 1e7)  # skipped by its norms, so never looked at
    assert (top.i == far).all()


def test_ivf_saved_and_loaded_reads_only_probed_cells(spark):
    rng = np.random.default_rng(3)
    rows = [(i, v) for i, v in enumerate(rng.normal(size=(200, 8)).tolist())] + [(900, None), (901, [1.0])]
    vectors = spark.createDataFrame(rows, "doc_id long, embedding array<double>")
    queries = spark.createDataFrame([(i, v) for i, v in rows[:10]], "qid long, embedding array<double>")
    built = IVFIndex.build(vectors)
    path = scratch_path(spark, "t-ivf")
    built.save(path)
    loaded = IVFIndex.load(spark, path)
    key = lambda df: sorted((r.qid, r.doc_id, r["rank"]) for r in df.collect())
    assert key(loaded.search(queries, 5, nprobe=2)) == key(built.search(queries, 5, nprobe=2))
    assert key(loaded.search(queries, 5, nprobe=loaded.nlist)) == key(D.knn(vectors, queries, 5))
    plan = loaded.vectors.filter(F.col("cell_id").isin([1, 2]))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "cell_id" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_min_max_keeps_differences_below_output_precision(spark):
    lex = spark.createDataFrame([(1, 1, 10.0000004, 1), (1, 2, 10.0000001, 2)], "qid long, doc_id long, score double, rank int")
    assert [r.norm for r in FU.min_max(lex).orderBy("rank").collect()] == [1.0, 0.0]
    docs = spark.createDataFrame([(i, "a " * i + "b") for i in range(1, 6)], "doc_id long, text string")
    scores = [r.score for r in LexicalIndex.build(docs).search(spark.createDataFrame([(1, "a")], "qid long, text string")).collect()]
    assert any(round(s, 6) != s for s in scores)


def test_best_is_chosen_on_the_raw_metric(spark):
    rows = [(0.2, 0.8800001, 0.5, 0.5), (0.3, 0.8800004, 0.5, 0.5)]
    best = X.mark_best(spark.createDataFrame(rows, "alpha double, ndcg double, mrr double, recall double"), ["alpha"])
    assert {r.alpha: r.is_best for r in best.collect()} == {0.2: False, 0.3: True}


def test_system_without_hits_scores_zero(spark):
    run = spark.createDataFrame([("s", 9, 1, 1), ("t", 1, 1, 1)], "system string, qid long, doc_id long, rank int")
    qrels = spark.createDataFrame([(1, 1, 1)], "qid long, doc_id long, rel int")
    got = {r.system: (r.ndcg, r.mrr, r.recall, r.n_queries) for r in E.macro(run, qrels).collect()}
    assert got == {"s": (0.0, 0.0, 0.0, 1), "t": (1.0, 1.0, 1.0, 1)}
    none = E.macro(run, qrels.where("rel > 1"))
    assert {(r.ndcg, r.mrr, r.recall, r.n_queries) for r in none.collect()} == {(0.0, 0.0, 0.0, 0)}


def test_failure_counts_name_every_category(spark):
    failures = spark.createDataFrame([("both_fail", 1, "q", "")], "category string, qid long, query string, relevant_found string")
    assert {r.category: r.n_queries for r in X.failure_counts(failures).collect()} == {"bm25_only": 0, "dense_only": 0, "both_fail": 1, "hybrid_wins": 0}


@pytest.mark.parametrize("first", [[], [(1, "..."), (2, "")]])
def test_stream_index_starts_empty_or_without_tokens(spark, first):
    docs = lambda rows: spark.createDataFrame(rows, "doc_id long, text string")
    indexer = StreamingIndexer(spark, scratch_path(spark, "t-first"))
    indexer.process(docs(first), 0)
    indexer.process(docs([(3, "b text"), (3, "a text"), (1, "again")]), 1)
    index = indexer.index()
    assert {r.doc_id: r.dl for r in index.doc_stats.collect()} == {**{i: 0 for i, _ in first}, 3: 2, **({} if first else {1: 1})}
    assert sorted(r.term for r in index.postings.where("doc_id = 3").collect()) == ["a", "text"]
    assert [r.doc_id for r in indexer.rejected().collect()] == ([1] if first else [])


def test_response_lists_are_empty_not_null(spark):
    docs = spark.createDataFrame([(1, "some words here"), (2, "other things")], "doc_id long, text string")
    queries = spark.createDataFrame([(1, "zzz"), (2, "words"), (3, " ")], "qid long, text string")
    built = S.build(docs)
    resp, rejected = S.search_response(queries, docs, built.lexical, built.vectors, k=2)
    got = {r.qid: r for r in resp.collect()}
    assert sorted(got) == [1, 2] and got[1].bm25_results == [] and len(got[1].dense_results) == 2
    assert [e.doc_id for e in got[2].bm25_results] == [1] and [r.qid for r in rejected.collect()] == [3]


def test_ivf_recall_on_clustered_vectors_with_few_cells_read(spark, monkeypatch):
    """Centroids learned on a sample; a tenth of the cells gives nine neighbours in ten."""
    from sparkrank.operators import ivf

    monkeypatch.setattr(ivf, "SAMPLE_PER_CELL", 20)
    monkeypatch.setattr(ivf, "ROWS_PER_FILE", 50)
    rng = np.random.default_rng(11)
    m = rng.normal(size=(40, 16))[rng.integers(0, 40, 4000)] + 0.15 * rng.normal(size=(4000, 16))
    vectors = spark.createDataFrame([(i, v) for i, v in enumerate(m.tolist())], "doc_id long, embedding array<double>")
    queries = vectors.where("doc_id % 50 = 0").withColumnRenamed("doc_id", "qid")
    path = scratch_path(spark, "t-ivf-recall")
    IVFIndex.build(vectors).save(path)
    index = IVFIndex.load(spark, path)
    assert index.vectors.count() == 4000
    nprobe = index.nlist // 10
    found = {(r.qid, r.doc_id) for r in index.search(queries, 10, nprobe=nprobe).collect()}
    exact = {(r.qid, r.doc_id) for r in D.knn(vectors, queries, 10).collect()}
    assert len(exact) == 800 and len(found & exact) >= 720
    sizes = {r.cell_id: r["count"] for r in index.vectors.groupBy("cell_id").count().collect()}
    scored = [sum(sizes.get(c, 0) for c in r.probes) for r in index.probes(queries, nprobe).collect()]
    assert np.mean(scored) <= 0.2 * 4000
