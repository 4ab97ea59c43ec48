import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sparkrank.llm import records as R
from sparkrank.session import scratch_path

PATH = public_tokenizers.path("word_bpe_49k.json")
TOKENIZER = Tokenizer.from_file(PATH)
ENCODER = R.PieceEncoder(PATH, 2, True)


def whole(text):
    return TOKENIZER.encode(text, add_special_tokens=False).ids


@settings(max_examples=1500, deadline=None)
@given(st.lists(st.text(alphabet="aAbJtTsSé.,!'\"3 \n\t\x0b\x0c\x1c\x85\xa0 ̌ÉİΣſK<|>\U0001f600你é", max_size=24), max_size=4))
def test_pieces_equal_whole_texts(texts):
    got = ENCODER([t.encode() for t in texts])
    assert [np.frombuffer(x, "<u2").tolist() for x in got] == [whole(t) for t in texts]


def test_special_tokens_and_words():
    for t in ("x <|endoftext|> y", "<|startoftext|>a", "The dog's bone, isn't it? WE'LL see... J̌"):
        assert np.frombuffer(ENCODER([t.encode()])[0], "<u2").tolist() == whole(t)


def test_a_known_piece_is_looked_up_once():
    class Counted(dict):
        asked = 0

        def get(self, key):
            Counted.asked += 1
            return dict.get(self, key)

        def __getitem__(self, key):
            Counted.asked += 1
            return dict.__getitem__(self, key)

        def __iter__(self):
            raise AssertionError("all that is remembered was gone through")

    encoder, text = R.PieceEncoder(PATH, 2, True), "one two three, two one"
    encoder([text.encode()])
    encoder.known = Counted(encoder.known)
    assert np.frombuffer(encoder([text.encode()])[0], "<u2").tolist() == whole(text)
    assert Counted.asked == len(R._pieces(text.encode())) == 6
    assert np.frombuffer(encoder([(text + " four").encode()])[0], "<u2").tolist() == whole(text + " four")
    assert Counted.asked == 6 + 7 + 1  # the new piece once more


@settings(max_examples=500, deadline=None)
@given(st.lists(st.text(alphabet="abcmzJÀÉÞàéñöøÿßæ", min_size=1, max_size=12), min_size=1, max_size=600))
def test_words_encoded_together_equal_words_alone(words):
    assert all(R._WORD.fullmatch(w.lower()) for w in words)
    assert ENCODER._encode_words(words) == ENCODER._encode(words)


def test_new_words_are_given_to_the_library_together(monkeypatch):
    alone, encoder = [], R.PieceEncoder(PATH, 2, True)
    encode = encoder._encode
    monkeypatch.setattr(encoder, "_encode", lambda texts: alone.extend(texts) or encode(texts))
    text = "Überaus viele neue Wörter, zusammen 3 a1 x##"
    assert np.frombuffer(encoder([text.encode()])[0], "<u2").tolist() == whole(text)
    assert sorted(alone) == [",", "3", "a1", "x##"]


def test_every_plain_letter_is_one_word():
    letters = [chr(c) for c in range(256) if R._WORD.fullmatch(chr(c))]
    assert [np.frombuffer(x, "<u2").tolist() for x in ENCODER._encode_words(letters)] == [whole(c) for c in letters]


@settings(max_examples=500, deadline=None)
@given(st.text(alphabet="ab1.,!? \n\t-", max_size=24))
def test_tails_are_those_behind_letters(text):
    behind = re.sub(r"(?<=[a-z])[.,;:!?]+(?=[\x20\t-\r]|\Z)", r" \g<0>", text)
    assert R._TAIL.sub(rb" \g<0>", text.encode()) == behind.encode()


def test_generations_forget_and_remember(monkeypatch):
    monkeypatch.setattr(R, "CACHE_PIECES", 2)
    for t in ("one two three", "one two four", "five six one", "one two three"):
        assert np.frombuffer(ENCODER([t.encode()])[0], "<u2").tolist() == whole(t)


def test_frames_detect_damage():
    record = R.frame(b"abcdef")
    assert R.unframe(record) == b"abcdef" and R.unframe(R.frame(b"")) == b""
    for k in range(len(record)):
        with pytest.raises(ValueError):
            R.unframe(record[:k] + bytes([record[k] ^ 1]) + record[k + 1 :])
    with pytest.raises(ValueError):
        R.unframe(record[:-1])


def check(rows, texts):
    """Rows of the query against whole-text encodings in ascending id order."""
    at = 0
    for r, t in zip(rows, texts):
        ids = whole(t or "") + [2]
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    assert len(rows) == len(texts)


def test_registered_query(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect()
    check(sorted(R.q_op3_token_records(spark, sf).collect(), key=lambda r: r.start), [d.text for d in docs])


@pytest.mark.parametrize("vocabulary", [1 << 16, 1 << 17])
def test_edges_and_shuffled_reads(spark, docs_of, vocabulary):
    rows = [(3, "three three"), (None, "none"), (1, None), (2, ""), (5, "long text " * 50_000), (3, "three three"), (-4, "minus")]
    root = scratch_path(spark, "records-test")
    R.write_records(docs_of(rows), root, PATH, 2, vocabulary=vocabulary)
    index = R.read_index(spark, root)
    got = R.read_records(index.orderBy(F.rand(1)), root).select("*", F.crc32("ids").alias("ids_crc32")).collect()
    want = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    check(sorted(got, key=lambda r: r.start), [t for _, t in want])
    assert [r.doc_id for r in sorted(got, key=lambda r: r.start)] == [i for i, _ in want]


def test_empty_table(spark, docs_of):
    root = scratch_path(spark, "records-empty")
    R.write_records(docs_of([]), root, PATH, 2)
    assert R.read_records(R.read_index(spark, root), root).count() == 0


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_any_tokenizer_gives_the_library_s_ids(spark, docs_of, name):
    """A tokenizer that keeps case and leading spaces is given whole texts."""
    path = public_tokenizers.path(name)
    texts = ["Hello World, hello  world!", "", "a\n\nb <|endoftext|> C", "你好 Ünï", " lead"]
    root = scratch_path(spark, "records-any")
    R.write_records(docs_of(list(enumerate(texts))), root, path, 2)
    got = sorted(R.read_records(R.read_index(spark, root), root).collect(), key=lambda r: r.doc_id)
    plain = Tokenizer.from_file(path)
    assert [np.frombuffer(r.ids, "<u4").tolist() for r in got] == [plain.encode(t, add_special_tokens=False).ids + [2] for t in texts]
    assert R.PieceEncoder(path, 2, True).by_piece == (name == "word_bpe_49k.json")


def test_width_follows_the_largest_id(spark, docs_of):
    """The width follows the ids the file holds, also beyond two bytes."""
    root = scratch_path(spark, "records-wide")
    R.write_records(docs_of([(1, "a b")]), root, PATH, end_id=70_000)
    (row,) = R.read_records(R.read_index(spark, root), root).collect()
    assert row.width == 4 and np.frombuffer(row.ids, "<u4").tolist() == whole("a b") + [70_000]
