import hashlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from sparkrank.llm import pieces as P

PATH = public_tokenizers.path("piece_bpe_32k.model")
MODEL = P.model_at(PATH)
SP = MODEL.processor


def ids(texts):
    return [np.frombuffer(x, np.int32).tolist() for x in MODEL.encode(texts)]


@settings(max_examples=1500, deadline=None)
@given(st.lists(st.text(alphabet="abeinorstth THE éèàñß.,'\"\n\t\x00▁　\U0010ffff\U0001f60012=#<s>/你", max_size=40), max_size=4))
def test_equals_the_library(texts):
    assert ids(texts) == SP.encode(texts)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text_round_trips(text):
    got = ids([text])[0]
    assert got == SP.encode(text)
    assert MODEL.decode(got) == SP.decode(got) == text.replace(P.MARK, " ")


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([p for p in MODEL.pieces[:4000]]), max_size=12))
def test_concatenated_pieces(parts):
    text = "".join(parts).replace(P.MARK, " ")
    assert ids([text]) == [SP.encode(text)]


def test_long_parts_cross_blocks(monkeypatch):
    texts = ["internationalization" * 300, "a" * 3000, " " * 100 + "x" + " " * 37, "é\U0001f600" * 500]
    want = SP.encode(texts)
    monkeypatch.setattr(P, "BLOCK", 97)
    MODEL.cache.clear()
    MODEL.older.clear()
    assert ids(texts) == want


def test_generations_forget_and_remember(monkeypatch):
    monkeypatch.setattr(MODEL, "cache_parts", 3)
    texts = ["one two three four.", "one two five!", "six seven, one", "one two", "eight: nine one"]
    assert [ids([t])[0] for t in texts] == SP.encode(texts)
    assert len(MODEL.cache) < 12


def test_registered_query(spark, sf):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = P.q_op5_pieces(spark, sf).collect()
    assert len(got) == len(texts)
    for r in got:
        assert r.ids == SP.encode(texts[r.doc_id]) and r.n_tokens == len(r.ids)
        assert r.round_trip and r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_edges(spark, docs_of):
    rows = [(1, None), (2, ""), (None, "null id"), (3, "twice"), (3, "twice"), (4, "word " * 60_000), (5, "mark ▁ text")]
    got = P.encoded_documents(docs_of(rows), PATH).collect()
    assert sorted((r.doc_id or -1, r.n_tokens) for r in got) == sorted((i or -1, len(SP.encode(t or ""))) for i, t in rows)
    assert all(r.round_trip for r in got)
    assert P.encode(docs_of(rows), PATH, out="w2").columns == [*docs_of(rows).columns, "w2"]
    assert P.encoded_documents(docs_of([]), PATH).count() == 0


def test_packed_suffixes_sort_like_strings():
    rng = np.random.default_rng(5)
    for letters in ([1, 2], [1, 98, 0x10FFFF, 0xE000], list(range(1, 900))):
        codes = np.concatenate([rng.choice([0, *letters], 700), np.zeros(17, dtype=np.int64)]).astype(np.uint32)
        windows = np.lib.stride_tricks.sliding_window_view(codes[: 700 + 16], 17)
        plain = sorted(range(700), key=lambda i: (windows[i].tolist(), i))
        assert P._suffix_order(codes[: 700 + 16], 700).tolist() == plain


def test_pairs_that_share_a_place_keep_their_answers(monkeypatch):
    monkeypatch.setattr(P, "RECENT_BITS", 2)
    model = P.Model(PATH)
    rng = np.random.default_rng(6)
    pairs = rng.integers(0, 300, 400) * (model.dead + 1) + rng.integers(0, 300, 400)
    pairs = np.concatenate([pairs, pairs[::-1], pairs])
    at = lambda x: model.pieces[x]
    want = [model.merge(at(a) + at(b)) == [at(a), at(b)] for a, b in (divmod(x, model.dead + 1) for x in pairs.tolist())]
    for part in (slice(0, 5), slice(5, 700), slice(0, None)):
        assert model._compatible(pairs[part]).tolist() == want[part]


def test_known_pairs_and_parts_are_not_searched_again(monkeypatch):
    model = P.Model(PATH)
    first = model.encode(["one two three, two. one  two"])
    monkeypatch.setattr(model, "_stays", lambda pairs: (_ for _ in ()).throw(AssertionError("searched again")))
    model.cache, model.older = {}, {}
    assert model.encode(["one two three, two. one  two"]) == first
