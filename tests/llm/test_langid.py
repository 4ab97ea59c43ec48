import math
import zlib
from collections import Counter, defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from sparkrank.llm import langid as L


def plain_tree(texts):
    """Counts by context (bytes) for orders 0 to 3."""
    counts = defaultdict(Counter)
    for t in texts:
        b = b"\n\n\n" + t
        for i in range(3, len(b)):
            for k in range(4):
                counts[b[i - k : i]][b[i]] += 1
    return counts


def plain_bits(counts, text):
    b, total = b"\n\n\n" + text, 0.0
    for i in range(3, len(b)):
        gone = set()
        for k in range(3, -1, -1):
            here = {s: n for s, n in counts.get(b[i - k : i], {}).items() if s not in gone}
            if not here:
                continue
            whole = sum(here.values()) + len(here)
            if b[i] in here:
                total -= math.log2(here[b[i]] / whole)
                break
            total -= math.log2(len(here) / whole)
            gone |= set(here)
        else:
            total += math.log2(256 - len(gone))
    return total


def tree_of(texts):
    code, n = np.unique(L.strings(texts)[0], return_counts=True)
    pairs = []
    for k in range(4):
        c, at = np.unique(code & np.uint32((1 << 8 * (k + 1)) - 1), return_inverse=True)
        pairs.append((c, np.bincount(at, n)))
    return L.Tree(*zip(*pairs))


TEXT = st.text(alphabet="abc é\n", max_size=30).map(str.encode)


@settings(max_examples=400, deadline=None)
@given(st.lists(TEXT.filter(bool), min_size=1, max_size=5), st.lists(TEXT, min_size=1, max_size=4))
def test_code_lengths_equal_plain_ppm(train, ask):
    got = L.code_lengths(ask, [tree_of(train)])[:, 0]
    assert np.allclose(got, [plain_bits(plain_tree(train), t) for t in ask])


def test_training_counts_all_texts(spark, docs_of, monkeypatch):
    monkeypatch.setattr(L, "_CHUNK", 64)
    texts = ["the cat sat on the mat " * 40, "le chat noir dort", "the dog", None, ""]
    docs = spark.createDataFrame([("fr" if t and t.startswith("le") else "en", t) for t in texts] + [(None, "x y z")], "lang string, text string").coalesce(1)
    trees = L.train(docs)
    assert sorted(trees) == ["en", "fr"]
    want = tree_of([t.encode() for t in texts if t and not t.startswith("le")])
    for k in range(4):
        assert (trees["en"].code[k] == want.code[k]).all() and (trees["en"].n[k] == want.n[k]).all()


def test_pruned_model_is_bounded(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    trees = L.train(docs, max_strings=4000)
    assert all(len(c) <= 1000 for t in trees.values() for c in t.code)
    assert np.isfinite(L.code_lengths([b"any text"], list(trees.values()))).all()


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in L.q_op10_langid(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert len(got) == len(docs)
    held = [d for d in docs if zlib.crc32(str(d.doc_id).encode()) % 5 == 0]
    assert {d.doc_id for d in held} == {i for i, r in got.items() if r.held_out}
    assert sum(got[d.doc_id].lang_pred == d.lang for d in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in got.values())


def test_edges(spark, docs_of):
    trees = {"en": tree_of([b"the cat and the dog"]), "fr": tree_of([b"le chat et le chien"])}
    rows = [(1, None), (2, ""), (3, "123 456 !?"), (None, "the cat"), (4, "le chat"), (4, "le chat"), (5, "the dog " * 40_000)]
    got = L.predict(docs_of(rows), trees).select("doc_id", "lang_pred", "score", "lang").collect()
    assert [r.lang_pred for r in sorted(got, key=lambda r: r.doc_id or 3.5)] == ["und"] * 3 + ["en", "fr", "fr", "en"]
    assert all(r.score == 0 for r in got if r.lang_pred == "und")
    tie = L.predict(docs_of([(1, "abc")]), {"b": trees["en"], "a": trees["en"]}).first()
    assert tie.lang_pred == "a" and tie.score == 0.5
    assert L.predict(docs_of(rows), {}).where("lang_pred != 'und' or score != 0").count() == 0
    assert L.train(docs_of([])) == {} and L.predict(docs_of([]), trees).count() == 0


def test_no_string_is_dropped_and_passes_agree(spark, docs_of):
    """Junk labels and a small bound change nothing: all counts are kept, in as many passes as needed."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "lang", "text")
    every = L.count_strings(docs)
    assert sum(len(c) for t in L._trees(every).values() for c in t.code) == every.count() == sum(len(c) for t in L.train(docs).values() for c in t.code)
    parts = L.parts_of(every, 20_000)
    assert len(parts) > 2 and sorted((x, c) for p in parts for x, a, b in p for c in range(a, b + 1)) == sorted((x, c) for x in L._trees(every) for c in range(256))
    ask = docs.unionByName(docs_of([(1, None), (2, ""), (3, "12 !"), (None, "q\x01z le chat")]).select("doc_id", "lang", "text"))
    one, many = (sorted(((r.doc_id or 0, r.text or "", r.lang_pred, round(r.score, 9)) for r in L.identify(ask, every, max_strings=m).collect()), key=str) for m in (1 << 40, 20_000))
    assert one == many and len(one) == ask.count()
    # The query itself asks for the same, with a bound its strings do not fit.
    whole = sorted((r.doc_id, r.lang_pred, round(r.score, 9)) for r in L.q_op10_langid(spark, "/root/testdata/sf0.001").collect())
    kept = L.count_strings(docs.where(L.fold("doc_id", 5) != 0))
    assert whole == sorted((r.doc_id, r.lang_pred, round(r.score, 9)) for r in L.identify(docs, kept, max_strings=20_000).collect())
