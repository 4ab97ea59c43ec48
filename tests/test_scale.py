"""What must not grow with the input: copies of query vectors, tasks of an index build, driver-fixed files."""

import numpy as np
import pyarrow as pa

from pyspark.sql import functions as F

from sparkrank.operators import dense as D
from sparkrank.operators import lexical as L
from sparkrank.operators.ivf import IVFIndex
from sparkrank.plans import catalog
from sparkrank.plans.catalog import arriving
from sparkrank.sources import index_store as IS
from sparkrank.sources import segment_store as SS
from sparkrank.streaming.indexing import stream_segments


def test_probing_queries_are_packed_once_and_answered_right(spark, monkeypatch):
    """A query's vector is in one block however many cells it probes; both joins give the same."""
    rng = np.random.default_rng(8)
    m = rng.normal(size=(300, 5))
    vectors = spark.createDataFrame([(i, v) for i, v in enumerate(m.tolist())] + [(900, None), (901, [1.0])], "doc_id long, embedding array<double>")
    queries = spark.createDataFrame([(i, m[i].tolist()) for i in range(0, 300, 4)] + [(950, None), (951, [2.0])], "qid long, embedding array<double>")
    ivf = IVFIndex.build(vectors, nlist=12)
    probes = ivf.probes(queries, 7)
    rows = [(r.qid, r.embedding, r.probes) for r in probes.collect()]
    assert {len(p) for q, _, p in rows if q < 900} == {7} and [p for q, _, p in rows if q >= 950] == [[], []]
    asked = pa.record_batch([pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows]), pa.array([r[2] for r in rows], pa.list_(pa.int32()))], ["i", "e", "p"])
    blocks = list(D._probing_packer(5)(iter([asked])))
    assert sum(len(b.column("qids")[0]) for b in blocks) == 75
    assert sum(len(b.column("qmatrix")[0].as_py()) for b in blocks) == 75 * 5 * 8
    assert sum(bin(int.from_bytes(b.column("asked")[0].as_py())).count("1") for b in blocks) == 75 * 7
    cell = {r.doc_id: r.cell_id for r in ivf.vectors.collect()}
    want = {}
    for q, v, p in rows:
        near = sorted((round(float(((m[i] - np.array(v)) ** 2).sum()), 9), i) for i in cell if cell[i] in p) if p else []
        want |= {q: [i for _, i in near[:6]]} if near else {}
    monkeypatch.setattr(D, "BLOCK_BYTES", 5 * 8 * 9)  # nine rows a block
    for limit in (0, 1 << 20):
        cand = D.knn_candidates(ivf.vectors, probes, 6, probe_col="cell_id", query_probe_col="probes", max_query_bytes=limit)
        got = {}
        for r in D.top_k(cand, 6, score="distance", ascending=True).orderBy("qid", "rank").collect():
            got.setdefault(r.qid, []).append(r.doc_id)
        assert got == want


def test_hash_encoder_equals_the_column_functions(spark, monkeypatch):
    """Few tokens at a time and a small term memory change nothing; null, empty and odd texts too."""
    texts = [(1, "a b b \u00e9t\u00e9 " * 30), (2, None), (3, ""), (4, "x_1 x_2 ?! 42"), (5, "solo"), (6, "b a " * 400)]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    monkeypatch.setattr(D, "TOKENS_AT_ONCE", 50)
    monkeypatch.setattr(D, "MAX_KNOWN_TERMS", 3)
    got = {r.doc_id: np.array(r.embedding) for r in D.hash_encode(df, dim=16).collect()}
    sums = {i: np.zeros(16) for i, _ in texts}
    terms = df.select("doc_id", F.explode(D.tokenize("text")).alias("t")).select("doc_id", D.term_bucket("t", 16).alias("b"), D.term_sign("t").alias("s"))
    for r in terms.collect():
        sums[r.doc_id][r.b] += r.s
    for i, v in sums.items():
        norm = np.sqrt((v * v).sum())
        assert (got[i] == (v / norm if norm else v)).all()


def docs_of(spark, n):
    return spark.createDataFrame([(i, " ".join(f"w{(i * j) % 37}" for j in range(1, 30))) for i in range(n)], "doc_id long, text string")


def test_a_segment_is_written_by_as_many_tasks_as_it_has_parts(spark, tmp_path, monkeypatch):
    """One task once wrote sixteen buckets whole, 320,000 documents; now one part of their terms."""
    store = SS.SegmentStore.create(spark, f"file://{tmp_path}/index", parts=4, docs_per_bucket=10)
    monkeypatch.setattr(SS, "BUCKETS_PER_FILE", 2)
    rows = L.postings_of(L.per_document(docs_of(spark, 80))).withColumn("part", SS._part("term", 4))
    dealt = store._together(rows, 8).withColumn("task", F.spark_partition_id())
    assert dealt.rdd.getNumPartitions() == 4 * 4
    groups = dealt.groupBy("run", "part").agg(F.countDistinct("task").alias("tasks"), F.countDistinct("bucket").alias("buckets")).collect()
    assert len(groups) == 16 and {g.tasks for g in groups} == {1} and max(g.buckets for g in groups) == 2
    store, _ = store.add(docs_of(spark, 80))
    want = L.postings_of(L.per_document(docs_of(spark, 80)))
    assert sorted(map(tuple, store.postings().collect())) == sorted(map(tuple, want.collect()))


def test_buckets_and_stream_files_grow_with_the_documents(spark, tmp_path, monkeypatch):
    assert [IS.buckets_for(n, 8) for n in (0, 80_000, 80_001, 3_000_000)] == [8, 8, 9, 300]
    monkeypatch.setattr("sparkrank.plans.catalog.DOCS_PER_FILE", 10)
    docs = docs_of(spark, 75)
    each = arriving(docs, f"file://{tmp_path}/in", 4)
    assert each == 2 and len(list((tmp_path / "in").glob("part-*"))) == 8
    store = stream_segments(spark, f"file://{tmp_path}/in", "doc_id bigint, text string", f"file://{tmp_path}/index", f"file://{tmp_path}/ckpt", max_segments=9, files_per_batch=each)
    assert len(store.segments) == 4 and store.n == 75


def test_adding_documents_counts_no_partitions_of_a_shuffle(spark, monkeypatch):
    """Counting them ran the shuffle of the texts once more."""
    first = L.LexicalIndex.build(docs_of(spark, 5))
    monkeypatch.setattr(L, "spread", lambda df: (_ for _ in ()).throw(AssertionError("the partitions were counted")))
    index, _ = first.add_documents(docs_of(spark, 9))
    assert index.doc_stats.count() == 9


def test_grid_thins_its_scores_in_their_tasks(spark, monkeypatch):
    """What a task's k best rule out, by every score, is neither expanded nor sorted; ties and nulls stay exact."""
    from sparkrank.operators import ordering as O

    rows = spark.range(0, 40_000, 1, 4).select(
        F.when(F.col("id") % 5 > 0, F.col("id") % 5).alias("qid"),
        F.when(F.col("id") >= 5, F.col("id")).alias("doc_id"),
        (F.xxhash64("id") % 50 / 7).alias("a"),
        F.when(F.col("id") % 9999 > 0, F.sin("id")).alias("b"),
    ).where("doc_id is not null or qid is null")
    kept = O.best_in_tasks(rows, 3, ["a", "b"])
    few = O._keeper("qid", ["a", "b"], "doc_id", 3)
    monkeypatch.setattr(O, "HELD_ROWS", 64)
    monkeypatch.setattr(O, "MAX_HELD_ROWS", 40)
    batches = rows.toArrow().to_batches(max_chunksize=500)
    bounded = list(few(iter(batches)))
    assert sum(b.num_rows for b in bounded) < 4_000
    for some in (kept, spark.createDataFrame(pa.Table.from_batches(bounded))):
        for score in ("a", "b"):
            assert sorted(O.top_k(some, 3, score=score).collect(), key=repr) == sorted(O.top_k(rows, 3, score=score).collect(), key=repr)


def test_grid_expands_few_rows(spark):
    """The 12 settings are laid out for rows that a task's best left, behind the aggregation."""
    from sparkrank.operators.lexical import LexicalIndex
    from sparkrank.plans import experiments as X

    docs = spark.createDataFrame([(i, f"alpha w{i % 7} w{i % 11}") for i in range(60)], "doc_id long, text string")
    queries = spark.createDataFrame([(1, "alpha w3"), (2, "w5 w10")], "qid long, text string")
    qrels = spark.createDataFrame([(1, 3, 1), (2, 5, 1)], "qid long, doc_id long, rel int")
    calls, real = [], X.best_in_tasks
    X.best_in_tasks = lambda df, k, scores: calls.append(scores) or real(df, k, scores)
    try:
        got = X.bm25_grid(LexicalIndex.build(docs), qrels, queries, k=5).collect()
    finally:
        X.best_in_tasks = real
    assert len(got) == 12 and len(calls) == 1 and len(calls[0]) == 12


def test_search_scores_blocks_and_ranks_as_all_pairs_do(spark, monkeypatch):
    """Repeated and null ids, queries that come twice, ties and several blocks of either side: the
    rows that scoring every (query, document) pair gives, without making a row of each pair."""
    words = ["alpha", "beta", "gamma", "delta", "straße", "x_1", "zeta"]
    docs = [(i % 37 if i % 11 else None, " ".join(words[(i * j + j) % (3 + i % 5)] for j in range(1 + i % 9))) for i in range(150)]
    docs += [(1000 + i, "alpha beta alpha") for i in range(40)] + [(2000, ""), (2001, None)]
    queries = [(i % 9 if i else None, " ".join(words[i % 7 :: 2] + ["unknown"])) for i in range(12)] + [(20, ""), (21, "unknown")]
    docs, queries = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(queries, "qid long, text string")
    monkeypatch.setattr(L, "TERMS_PER_QUERY_BLOCK", 7)
    for index in (L.LexicalIndex.build(docs, persist=True), L.LexicalIndex.build(docs)):
        for k in (1, 5, 100):
            found = index.search(queries, k)
            plain = L.top_k(index.score_all(queries), k)
            rows = lambda df: sorted((str(r.qid), r.rank, str(r.doc_id), round(r.score, 9)) for r in df.collect())
            assert rows(found) == rows(plain) and rows(found)
    monkeypatch.setattr(L.LexicalIndex, "score_all", None)  # that makes a row of each pair
    assert index.search(queries, 3).count()


def test_packed_documents_are_bounded_and_whole(monkeypatch):
    import pyarrow as pa

    from sparkrank.operators import blocks as B

    monkeypatch.setattr(B, "BLOCK_DOCS", 4)
    ids, terms = pa.array(range(11)), pa.array([["a", "b"][: 1 + i % 2] for i in range(11)])
    weights = pa.array([[float(i), 0.5][: 1 + i % 2] for i in range(11)])
    got = list(B.packer(iter(pa.RecordBatch.from_arrays([ids, terms, weights], names=["doc_id", "terms", "weights"]).slice(a, 3) for a in range(0, 11, 3))))
    assert all(len(b.column("ids")[0]) <= 4 for b in got)
    assert [i for b in got for i in b.column("ids")[0].as_py()] == list(range(11))


def test_fusion_and_snippets_cache_nothing(spark, tmp_path):
    """The index of a search is written in buckets: no part of the corpus stays in executors, its
    postings are summed by document without an exchange, and Arrow batches are bounded."""
    docs = [(i, f"alpha beta{i % 7} gamma" * (1 + i % 3) + f" w{i}") for i in range(60)] + [(90, ""), (91, None), (None, "alpha"), (3, "alpha again")]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "alpha beta3"), (2, "w5 w9"), (3, " "), (4, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.catalog.clearCache()
    before = set(spark.sparkContext._jsc.getPersistentRDDs())
    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    found = {n: catalog.QUERIES[n](spark, str(tmp_path)).collect() for n in ("snippets", "fuse_rrf_weighted")}
    assert set(spark.sparkContext._jsc.getPersistentRDDs()) == before
    assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")) == 8 << 20
    cached = catalog.lexical_index(spark, str(tmp_path))
    queries = catalog.C.queries(spark, str(tmp_path))
    want = {(r.qid, r.doc_id, r["rank"], r.score) for r in cached.search(queries, k=10, decimals=4).collect() if r.doc_id is not None}
    assert {(r.qid, r.doc_id, r["rank"], r.display_score) for r in found["snippets"] if r.doc_id is not None} == want and len(want) > 10
    assert len(found["fuse_rrf_weighted"]) >= 20
    index = catalog.block_index(spark, str(tmp_path))
    plan = index.postings.groupBy("doc_id").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    spark.catalog.clearCache()
