"""Streaming index maintenance and query answering equal their batch twins."""

from sparkrank.operators.lexical import LexicalIndex
from sparkrank.session import scratch_path
from sparkrank.sources import collections as C
from sparkrank.operators import dense as D
from sparkrank.plans import search as S
from sparkrank.sources.segment_store import SegmentStore
from sparkrank.streaming.indexing import stream_index, stream_responses, stream_search

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted(map(tuple, df.select("qid", "doc_id", "score", "rank").collect()))


def test_stream_index_equals_batch_build_and_replay_is_idempotent(spark):
    base = scratch_path(spark, "t-stream")
    C.corpus(spark, SF).repartition(3).write.parquet(f"{base}/in")
    indexer = stream_index(spark, f"{base}/in", "doc_id bigint, text string", f"{base}/idx", f"{base}/ck")
    batch = LexicalIndex.build(C.corpus(spark, SF))
    q = C.queries(spark, SF)
    assert rows(indexer.index().search(q, k=10)) == rows(batch.search(q, k=10))
    # Replaying the last micro-batch id rewrites only its own partition.
    last = spark.read.parquet(f"{base}/idx/doc_stats").agg({"batch_id": "max"}).first()[0]
    again = spark.read.parquet(f"{base}/in").limit(0)
    indexer.process(spark.read.parquet(f"{base}/in").join(
        spark.read.parquet(f"{base}/idx/doc_stats").filter(f"batch_id = {last}").select("doc_id"), "doc_id", "left_semi"), last)
    assert rows(indexer.index().search(q, k=10)) == rows(batch.search(q, k=10))
    assert again.count() == 0


def test_stream_search_equals_batch(spark):
    base = scratch_path(spark, "t-ssearch")
    C.queries(spark, SF).repartition(2).write.parquet(f"{base}/in")
    idx = LexicalIndex.build(C.corpus(spark, SF))
    out = stream_search(spark, idx, f"{base}/in", "qid bigint, text string", f"{base}/out", f"{base}/ck", k=10)
    assert rows(out) == rows(idx.search(C.queries(spark, SF), k=10))


def test_stream_responses_rejects_replays_and_sees_new_versions(spark):
    base = scratch_path(spark, "t-sresp")
    docs = [(1, "red fox runs"), (2, "blue whale swims"), (3, "red whale")]
    corpus = lambda: spark.createDataFrame(now, "doc_id long, text string")
    ask = lambda rows: spark.createDataFrame(rows, "qid long, text string").coalesce(1).write.mode("append").parquet(f"{base}/in")

    def answer():
        vectors = lambda: D.hash_encode(corpus(), "doc_id")
        return stream_responses(spark, f"{base}/index", corpus, vectors, f"{base}/in", "qid long, text string", f"{base}/out", f"{base}/ck", k=2)

    def batch(rows):
        store = SegmentStore.open(spark, f"{base}/index")
        return S.search_response(spark.createDataFrame(rows, "qid long, text string"), corpus(), store, D.hash_encode(corpus(), "doc_id"), k=2)

    taken = lambda t: sorted(map(str, t.collect()))
    now = docs[:2]
    SegmentStore.create(spark, f"{base}/index").add(corpus())
    ask([(10, "red whale"), (11, "  "), (12, None)])
    found, rejected = answer()
    first = [taken(t) for t in batch([(10, "red whale"), (11, "  "), (12, None)])]
    assert [taken(found), taken(rejected)] == first and [r.qid for r in found.collect()] == [10]
    now = docs
    SegmentStore.open(spark, f"{base}/index").add(corpus())  # known ids are rejected, the third document is new
    ask([(20, "red whale")])
    found, rejected = answer()
    assert taken(rejected) == first[1]
    assert taken(found.where("qid = 10")) == first[0]  # answered once, by the version of its batch
    assert taken(found.where("qid = 20")) == taken(batch([(20, "red whale")])[0])
    assert 3 in [e.doc_id for e in found.where("qid = 20").first().bm25_results]
