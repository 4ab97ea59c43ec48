import hashlib
import random
import re

from sparkrank.llm import decontam as D

def run(spark, docs_of, docs, items):
    bench = spark.createDataFrame([(i, t, 1, "x") for i, t in items], "item_id long, text string, tok int, win_id string")
    found = D.contamination(docs_of(docs), bench)
    rows = [(r.doc_id, r.n_words, r.n_hit, len(r.items), hashlib.sha256(",".join(r.items).encode()).hexdigest(), bool(r.n_hit) and 20 * r.n_hit >= r.n_words) for r in found.collect()]
    return sorted(rows, key=str)


def test_random_texts_over_few_words(spark, docs_of, brute):
    plain = brute[0]
    r = random.Random(3)
    make = lambda n: " ".join(r.choice(["a", "b", "C", "é", "the-x", "7"]) for _ in range(n))
    items = [(i, make(r.choice([1, 2, 3, 5, 12, 13, 14, 30]))) for i in range(14)]
    docs = [(i, make(r.randint(0, 60))) for i in range(60)]
    docs += [(100 + k, make(9) + " " + t + "! " + make(9) + t) for k, (_, t) in enumerate(items)]
    assert run(spark, docs_of, docs, items) == plain(docs, items)


def test_edges(spark, docs_of, brute):
    plain = brute[0]
    passage = " ".join(f"w{i}" for i in range(40))
    items = [(10, passage), (9, passage.upper()), (None, passage), (3, None), (4, ""), (5, "?!"), (6, "solo"), (6, "duo words")]
    docs = [(1, None), (2, ""), (3, "... !"), (None, passage), (None, "other"), (4, passage[:60]), (5, " ".join(passage.split()[3:16])), (6, " ".join(passage.split()[3:15]))]
    docs += [(7, "x solo y duo words solo"), (7, "x solo y duo words solo"), (8, "filler " * 30_000 + passage), (9, passage + " " + passage)]
    got = run(spark, docs_of, docs, items)
    assert got == plain(docs, items)
    assert run(spark, docs_of, [], items) == [] and run(spark, docs_of, docs, []) == plain(docs, [])


def test_shuffled_when_the_benchmark_is_large(spark, docs_of, brute, monkeypatch):
    plain = brute[0]
    monkeypatch.setattr(D, "MAX_BROADCAST_BYTES", 0)
    items = [(1, " ".join(f"v{i}" for i in range(20)))]
    docs = [(1, "before " + items[0][1] + " after"), (2, "nothing")]
    assert run(spark, docs_of, docs, items) == plain(docs, items)


def test_native_plan_and_query(spark, sf, brute):
    plain = brute[0]
    df = D.q_op9_decontamination(spark, sf)
    assert not re.search("Python|Pandas|Arrow|CartesianProduct|NestedLoop", df._jdf.queryExecution().executedPlan().toString())
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    short = sorted(docs)[:60]
    want = {r[0]: r for r in plain(short, items)}
    got = {r.doc_id: tuple(r) for r in df.collect()}
    assert len(got) == len(docs) and all(got[i] == w for i, w in want.items())
