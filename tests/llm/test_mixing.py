"""Mixing against a plain version: shares by rounds, draws from md5, rows emitted."""

import hashlib
import re
from collections import Counter, defaultdict
from fractions import Fraction

import pytest

from sparkrank.llm import mixing as M


def size_of(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def plain_targets(sizes, weights=(3, 1, 2), share=Fraction(3, 2), most=2):
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    target, open_ = {}, set(names)
    while open_:
        left = share * sum(sizes.values()) - sum(target.values())
        unit = left / sum(weight[s] for s in open_)
        above = {s for s in open_ if unit * weight[s] > most * sizes[s]}
        if not above:
            target |= {s: unit * weight[s] for s in open_}
            break
        target |= {s: Fraction(most * sizes[s]) for s in above}
        open_ -= above
    return target


def plain_mix(rows):
    sizes = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += size_of(t)
    target = plain_targets(sizes)
    out = []
    for i, t, s in rows:
        rate = float(target[s]) / sizes[s] if sizes[s] else 0.0
        h = hashlib.md5((t or "").encode()).hexdigest()
        u = int(hashlib.md5(f"42:{'' if i is None else i}:{h}".encode()).hexdigest()[:13], 16) / 16**13
        out.append((i, size_of(t), sizes[s], float(target[s]), size_of(t) * (int(rate) + (u < rate - int(rate)))))
    return out


ROWS = [
    (1, None, "a"), (2, "", None), (3, "one two\tthree\x0bfour", "a"), (None, "x y", "b"), (None, "x y", "b"), (4, "x y", "b"), (5, "w " * 40_000, "c"),
    (6, "tiny", "ä"), (7, "no  break space", "Z"), (8, "", "empty"), (9, None, "empty"), (10, "n n n", None), (11, "later row", "\U0001f600"), (12, "k", "￮"),
] + [(100 + k, "word " * (k % 7), "hot") for k in range(60)]


def table(spark, rows):
    schema = "doc_id long, text string, source string, h string, n int, of string, rate double, size long, place int, weight string, target string"
    return spark.createDataFrame([(*r, "x", 7, "y", 0.5, -1, 3, "w", "t") for r in rows], schema)


def test_equals_plain_version(spark):
    got = M.mixed(table(spark, ROWS)).select("doc_id", "size", "source_size", "target", "taken").collect()
    want = plain_mix(ROWS)
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert all(r.taken <= 2 * r.size for r in got)


def test_emitted_rows_are_the_copies(spark):
    docs = table(spark, ROWS)
    out = M.emitted(docs)
    assert out.columns == docs.columns and out.schema.simpleString() == docs.schema.simpleString()
    copies = Counter()
    for r in M.mixed(docs).collect():
        copies[(r.doc_id, r.source, r.size)] += r.copies
    assert Counter((r.doc_id, r.source, size_of(r.text)) for r in out.collect()) == +copies


def test_empty_tables(spark):
    for rows in ([], [(1, None, None), (2, "", "a")]):
        docs = table(spark, rows)
        assert [tuple(r) for r in M.mixed(docs).select("size", "target", "taken").collect()] == [(0, 0.0, 0)] * len(rows)
        assert M.emitted(docs).count() == 0


def test_targets_of_many_sources_and_parameters(spark):
    sizes = {f"s{k:03d}": (k * k * 37) % 1001 for k in range(200)} | {None: 12345}
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long").repartition(7)
    for how in ({}, {"weights": (1, 5, 2, 9), "share": Fraction(4, 5), "most": 1}):
        got = {r.source: r.target for r in M.targets(df, **how).collect()}
        want = plain_targets(sizes, **how)
        assert {s: pytest.approx(float(t), rel=1e-12) for s, t in want.items()} == got
    with pytest.raises(ValueError):
        M.targets(df, share=Fraction(3), most=2)


def test_targets_of_large_sources(spark):
    # As many words as 6 GB of text: what the open sources share fits an int, its product with a weight does not.
    sizes = {"s00": 587_000_000} | {f"s{k:02d}": 54_000_000 + 10_007 * k for k in range(1, 20)}
    for scale in (1, 50_000):
        df = spark.createDataFrame([(s, n * scale) for s, n in sizes.items()], "source string, source_size long")
        got = {r.source: r.target for r in M.targets(df).collect()}
        assert {s: pytest.approx(float(t), rel=1e-12) for s, t in plain_targets({s: n * scale for s, n in sizes.items()}).items()} == got


def test_sources_come_near_their_targets(spark):
    rows = [(k, "w " * (1 + k % 50), "abc"[k % 3] if k % 4 else "big") for k in range(20_000)]
    got = M.mixed(table(spark, rows)).groupBy("source").agg({"taken": "sum", "target": "max"}).collect()
    assert all(abs(r[1] / r[2] - 1) < 0.03 or abs(r[2] / r[1] - 1) < 0.03 for r in got)
