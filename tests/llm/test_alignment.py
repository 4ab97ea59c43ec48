"""Token alignment against whole-text encodings by the libraries and all-pairs overlaps."""

import hashlib
from collections import Counter

import public_tokenizers
import sentencepiece
from tokenizers import Tokenizer

from sparkrank.llm import alignment as A

PATHS = [public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model")]


def brute(rows):
    """Result rows by comparing every A token with every B token of a document."""
    a = Tokenizer.from_file(PATHS[0])
    a.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    byte_of = A._byte_alphabet()
    docs = []
    for i, t in rows:
        found = ([], [], [], [])
        if t:
            x = a.encode(" " + t, add_special_tokens=False)
            y = sp.encode(t)
            xb = [bytes(byte_of[c] for c in a.id_to_token(k)) for k in x.ids]
            yb = [bytes([int(sp.id_to_piece(k)[3:5], 16)]) if sp.is_byte(k) else sp.id_to_piece(k).replace("▁", " ").encode() for k in y]
            if b"".join(xb) == b"".join(yb) == (" " + t).encode():
                found = (x.ids, y, xb, yb)
        docs.append((i, *found))
    out, seen = [], Counter()
    for i, x, y, xb, yb in docs:
        spans = []
        for parts in (xb, yb):
            at, some = 0, []
            for p in parts:
                some.append((at, at + len(p)))
                at += len(p)
            spans.append(some)
        links = [(x[m], y[n]) for m, (s, e) in enumerate(spans[0]) for n, (u, v) in enumerate(spans[1]) if s < v and u < e]
        both = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
        groups, before = [], 0
        for e in both:
            inside = [",".join(str(k) for k, (s, f) in zip(ids, sp_) if s >= before and f <= e) for ids, sp_ in zip((x, y), spans)]
            groups.append("|".join(inside))
            before = e
        seen.update(set(links))
        out.append((i, len(x), len(y), groups, links))
    best = {}
    for (p, _), n in seen.items():
        best[p] = max(best.get(p, 0), n)
    return [
        (i, na, nb, len(g), len(ls), sum(seen[x] == best[x[0]] for x in ls), sum(seen[x] for x in ls), hashlib.sha256(";".join(g).encode()).hexdigest() if na else "")
        for i, na, nb, g, ls in out
    ]


EDGES = [
    (1, None), (2, ""), (3, " "), (4, "   two  spaces   "), (5, "tab\tnew\n line \n\n  x"), (6, "a▁b"), (7, "naïve 東京 🙂🙃 é"),
    (8, "<|endoftext|> <s> </s> <0x41>"), (9, "don't it's I'll 123456 ... !!"), (10, "dup text"), (10, "dup text"), (None, "dup text"),
    (11, "x" * 3000 + " " + "ab1 " * 500), (12, "    x 　 y\r\n"), (13, "\x00\x01 \x7f"),
]


def test_edges_equal_brute_force(docs_of):
    got = A.aligned(docs_of(EDGES), *PATHS)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(brute(EDGES), key=str)


def test_empty_and_all_null(docs_of):
    assert A.aligned(docs_of([]), *PATHS).collect() == []
    assert list(map(tuple, A.aligned(docs_of([(1, None)]), *PATHS).collect())) == [(1, 0, 0, 0, 0, 0, 0, "")]


def test_several_lookups_and_small_memory_agree(docs_of, monkeypatch):
    whole = sorted(map(tuple, A.aligned(docs_of(EDGES), *PATHS).collect()), key=str)
    assert sorted(map(tuple, A.aligned(docs_of(EDGES), *PATHS, max_pairs=40).collect()), key=str) == whole
    monkeypatch.setattr(A, "CACHE_PARTS", 3)
    small = A.Aligner(*PATHS)
    for _ in range(3):
        flat, stops = small.documents([t for _, t in EDGES])
        good = A._sums(small.rows[flat, A._BAD], stops) == 0
        assert (A._sums(small.rows[flat, 0], stops) * good).tolist() == [r[1] for r in brute(EDGES)]


def test_parts_never_change_either_side():
    """Random mixtures of spaces, other white space, letters and marks: parts equal whole texts."""
    import random

    rng = random.Random(5)
    texts = ["".join(rng.choice(["a", "b ", " ", "\n", "\t ", "'s", "1", ",", "é", "\u3000", " x", ". "]) for _ in range(rng.randrange(1, 14))) for _ in range(4000)]
    x = A.Aligner(*PATHS)
    flat, stops = x.documents(texts)
    for t, i, j in zip(texts, stops[:-1], stops[1:]):
        a_ids = x.a.encode(" " + t, add_special_tokens=False).ids
        got = b";".join(x.spelled[k] for k in flat[i:j]).decode().split(";")
        assert ",".join(g.split("|")[0] for g in got) == ",".join(map(str, a_ids)), t
        assert ",".join(g.split("|")[1] for g in got) == ",".join(map(str, x.b.encode(t))), t


def test_query_equals_brute_force(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    rows = sorted(rows, key=lambda r: len(r[1] or ""))
    got = {r.doc_id: tuple(r) for r in A.q_op11_alignment(spark, sf).collect()}
    assert len(got) == len(rows)
    want = brute_counts_only(rows)
    for i, row in want.items():
        assert got[i] == row


def brute_counts_only(rows):
    """As ``brute``, with overlaps found by walking both sides, for whole tables."""
    a = Tokenizer.from_file(PATHS[0])
    a.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    byte_of = A._byte_alphabet()
    seen, kept = Counter(), {}
    for i, t in rows:
        x, y = (a.encode(" " + t, add_special_tokens=False).ids, sp.encode(t)) if t else ([], [])
        xl = [len(a.id_to_token(k)) for k in x]
        yl = [1 if sp.is_byte(k) else len(sp.id_to_piece(k).replace("▁", " ").encode()) for k in y]
        assert all(c in byte_of for k in x for c in a.id_to_token(k))
        if sum(xl) != sum(yl):
            x = y = xl = yl = []
        links, groups, m, n, p, q, g0, h0 = [], [], 0, 0, 0, 0, 0, 0
        while m < len(x) and n < len(y):
            links.append((x[m], y[n]))
            e, f = p + xl[m], q + yl[n]
            if e == f:
                groups.append(",".join(map(str, x[g0 : m + 1])) + "|" + ",".join(map(str, y[h0 : n + 1])))
                g0, h0 = m + 1, n + 1
            m, p = (m + 1, e) if e <= f else (m, p)
            n, q = (n + 1, f) if f <= e else (n, q)
        seen.update(set(links))
        kept[i] = (len(x), len(y), groups, links)
    best = {}
    for (p, _), c in seen.items():
        best[p] = max(best.get(p, 0), c)
    return {
        i: (i, na, nb, len(g), len(ls), sum(seen[z] == best[z[0]] for z in ls), sum(seen[z] for z in ls), hashlib.sha256(";".join(g).encode()).hexdigest() if na else "")
        for i, (na, nb, g, ls) in kept.items()
    }
