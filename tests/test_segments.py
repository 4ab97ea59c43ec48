"""The segmented index: equal to a full build after any sequence of changes, pruned reads, versions."""

import os
import random
import re

import pytest

from sparkrank.operators import blocks as BL
from sparkrank.operators.lexical import LexicalIndex
from sparkrank.sources.segment_store import SegmentStore


def corpus(seed, ids):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(60)]
    return [(i, " ".join(rng.choices(words, weights=[1 / (1 + k) for k in range(60)], k=rng.randrange(0, 40)))) for i in ids]


QUERIES = [(1, "w0 w1 w2 w50"), (2, "w59"), (3, ""), (4, "unknown"), (5, "w0 w0 w1 w3 w9 w20 w33 w41 w58"), (6, None)]


def rows(df):
    return sorted((r.qid, r.rank, r.doc_id, round(r.score, 7)) for r in df.collect())


def table(spark, docs):
    return spark.createDataFrame(docs, "doc_id long, text string")


@pytest.fixture(scope="module")
def queries(spark):
    return spark.createDataFrame(QUERIES, "qid long, text string")


def check(spark, store, docs, queries, k=5, **how):
    want = LexicalIndex.build(table(spark, docs)).search(queries, k=k, **how)
    assert rows(store.search(queries, k=k, **how)) == rows(want)


def test_changes_equal_a_full_build(spark, queries, tmp_path):
    path = f"file://{tmp_path}/index"
    store = SegmentStore.create(spark, path, parts=4, docs_per_bucket=40)
    assert store.search(queries).collect() == []
    a, b, c = corpus(1, range(150)), corpus(2, range(100, 220)), corpus(3, range(300, 330)) + [(500, None), (501, "?!")]
    store, rejected = store.add(table(spark, a))
    assert rejected.collect() == []
    first = store
    check(spark, store, a, queries)
    store, rejected = store.add(table(spark, b))
    assert sorted(r[0] for r in rejected.collect()) == list(range(100, 150))
    now = a + [x for x in b if x[0] >= 150]
    check(spark, store, now, queries)
    gone = [3, 7, 120, 151, 152, 9999]
    store = store.delete(spark.createDataFrame([(i,) for i in gone], "doc_id long"))
    now = [x for x in now if x[0] not in gone]
    check(spark, store, now, queries)
    store, _ = store.add(table(spark, c + [(3, "w59 again")]))
    now = now + c + [(3, "w59 again")]
    check(spark, store, now, queries)
    check(spark, store, now, queries, k=3, k1=0.9, b=0.4)
    merged = store.merge(all_of_them=True)
    assert len(merged.segments) == 1 and merged.n == len(now)
    check(spark, merged, now, queries)
    check(spark, first, a, queries)  # an older snapshot still reads its own files
    again = SegmentStore.open(spark, path)
    assert again == merged and SegmentStore.open(spark, path, first.version) == first
    assert len(merged.vacuum()) == 4
    check(spark, again, now, queries)


def test_concurrent_writers_do_not_lose_each_other(spark, tmp_path):
    path = f"file://{tmp_path}/index"
    store = SegmentStore.create(spark, path, parts=2)
    store.add(table(spark, [(1, "a b")]))
    with pytest.raises(Exception, match="(?i)already exist"):
        store.add(table(spark, [(2, "a c")]))
    assert [r.doc_id for r in SegmentStore.open(spark, path).docs().collect()] == [1]
    with pytest.raises(Exception, match="(?i)already exist"):
        SegmentStore.create(spark, path)


def test_many_small_batches_stay_bounded(spark, queries, tmp_path):
    store = SegmentStore.create(spark, f"file://{tmp_path}/index", parts=1, docs_per_bucket=1000)
    docs = corpus(4, range(48))
    for k in range(0, 48, 4):
        store, _ = store.add(table(spark, docs[k : k + 4]))
        store = store.merge(max_segments=3)
        assert len(store.segments) <= 3
    check(spark, store, docs, queries)


def test_string_ids_ties_and_refused_ids(spark, queries, tmp_path):
    store = SegmentStore.create(spark, f"file://{tmp_path}/index", id_type="string", parts=2, docs_per_bucket=3)
    docs = [(f"d{k:02d}", "w59 w0") for k in range(20)] + [("d05", "w59 w0")]
    store, _ = store.add(spark.createDataFrame(docs, "doc_id string, text string"))
    got = [r.doc_id for r in store.search(queries.where("qid = 2"), k=7).orderBy("rank").collect()]
    assert got == [f"d{k:02d}" for k in range(7)]
    with pytest.raises(Exception, match="without an id"):
        store.add(spark.createDataFrame([(None, "x")], "doc_id string, text string"))


def test_one_term_reads_few_bytes(spark, sf_index):
    """Only the term's partition is read, and the term is pushed to Parquet inside it."""
    store, base = sf_index
    term = store.term_stats().orderBy("df", "term").first().term
    one = spark.createDataFrame([(1, term)], "qid long, text string")
    plan = store.candidates(one, 10)._jdf.queryExecution().executedPlan().toString()
    part = spark.createDataFrame([(term,)], "t string").selectExpr(f"cast(pmod(xxhash64(t), {store.parts}) as int) p").first().p
    scan = next(x for x in plan.splitlines() if "FileScan" in x and "part#" in x)
    assert re.search(rf"PartitionFilters: \[[^]]*part#\d+ = {part}\)", scan), scan
    assert f"EqualTo(term,{term})" in scan
    size = lambda p: sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(p) for f in fs if f.endswith(".parquet"))
    assert size(f"{base}/blocks/part={part}") < 0.08 * size(f"{base}/blocks")
    assert store.search(one).count() >= 1


@pytest.fixture(scope="module")
def sf_index(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("segments")
    store = SegmentStore.create(spark, f"file://{base}/index", parts=32, docs_per_bucket=100)
    store, _ = store.add(spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text"))
    return store, f"{base}/index/{store.segments[0]['name']}"


def test_skipping_never_changes_the_best():
    import numpy as np

    rng = np.random.default_rng(1)
    for trial in range(200):
        n, k = int(rng.integers(1, 60)), int(rng.integers(1, 8))
        blocks = []
        for _ in range(int(rng.integers(1, 30))):
            at = np.sort(rng.choice(n, size=int(rng.integers(0, n + 1)), replace=False))
            add = rng.random(len(at)) * rng.choice([0.01, 0.1, 5.0])
            blocks.append((add.max() if len(add) else 0.0, at, add))
        plain = np.zeros(n)
        for _, at, add in blocks:
            plain[at] += add
        got = BL.accumulate(blocks, n, k)
        assert BL.best(got, k).tolist() == BL.best(plain, k).tolist()
        assert np.allclose(got[BL.best(got, k)], plain[BL.best(plain, k)])


def test_stream_of_batches_and_replay(spark, queries, tmp_path):
    from sparkrank.streaming.indexing import stream_segments

    docs = corpus(6, range(60))
    table(spark, docs).repartition(5).write.parquet(f"file://{tmp_path}/in")
    run = lambda n: stream_segments(spark, f"file://{tmp_path}/in", "doc_id long, text string", f"file://{tmp_path}/index", f"file://{tmp_path}/ckpt{n}", max_segments=2)
    store = run(1)
    assert len(store.segments) <= 2
    check(spark, store, docs, queries)
    # Every batch once more, as after a crash behind the version's write: nothing is added.
    assert run(2).version == store.version
