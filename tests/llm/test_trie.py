"""The conversation trie against a plain trie of nested dictionaries."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from sparkrank.llm import trie as T


def rebuilt(rows):
    """Turn sequences per conversation, as the contract rebuilds them."""
    own = ordered(rows)
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = own.get(c - c % 100, [])[:h] + turns[h:]
    return out


def ordered(rows):
    own = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            own[c].append((t is not None, t or 0, r or "", x or ""))
    return {c: [v[2:] for v in sorted(turns, key=lambda v: v[:2])] for c, turns in own.items()}


def plain(seqs):
    """Rows of all nodes, deepest last, by walking every prefix."""
    members = defaultdict(list)
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            members[tuple(s[:d])].append(c)
    kids = defaultdict(list)
    for p in members:
        if p:
            kids[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[k] for k in kids[p]) if kids[p] else 1
        saved[p] = (len(members[p]) - 1) * (len(p[-1][1]) if p else 0) + sum(saved[k] for k in kids[p])
    return sorted(
        (
            min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(kids[p]), leaves[p], saved[p],
            hashlib.sha256(",".join(str(c) for c in sorted(m) if len(seqs[c]) == len(p)).encode()).hexdigest(),
        )
        for p, m in members.items()
    )


def table(spark, rows):
    schema = "conv_id long, turn int, role string, text string, m string, depth string, node long, pos long, parent long"
    return spark.createDataFrame([(*r, "x", "y", 1, 2, 3) for r in rows], schema)


def made(seed, n, long=0):
    """Conversations that share heads, and some texts, at many depths."""
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        base = [("user", f"t{rng.randrange(3)}") for _ in range(rng.randrange(9))]
        for k, (r, x) in enumerate(base):
            rows.append((c * 7 % 1000, k if rng.random() > 0.02 else None, rng.choice([r, "user", None]), rng.choice([x, x, "", None, "é🙂"])))
    for k in range(long):
        rows += [(5000, k, "u", "deep"), (5001, k, "u", "deep" if k < long - 3 else "other")]
    rng.shuffle(rows)
    return rows


def unique_turns(rows):
    """Only one row for each turn of a conversation, so that its order is given."""
    seen = {}
    for r in rows:
        seen.setdefault(r[:2], r)
    return list(seen.values())


def result(df):
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("how", [{}, {"band": 2, "members": 3, "queue": 4, "run_ids": 2}, {"band": 1, "members": 1, "queue": 2, "run_ids": 1}])
def test_equals_plain_trie(spark, how):
    rows = unique_turns(made(1, 150, 40)) + [(None, 0, "u", "nobody"), (8000, None, None, None)]
    assert result(T.conversation_trie(table(spark, rows), **how)) == plain(ordered(rows))


def test_repeated_rows_are_turns(spark):
    rows = [(1, 0, "u", "a"), (1, 0, "u", "a"), (2, 0, "u", "a"), (2, 1, "u", "a"), (3, None, None, "a" * 100_000)]
    assert result(T.conversation_trie(table(spark, rows))) == plain(ordered(rows))


def test_shared_heads_and_turnless(spark):
    rows = unique_turns(made(2, 300)) + [(100000 + 3, k, "u", "own") for k in range(2)] + [(-7, k, "u", f"n{k}") for k in range(6)]
    want = rebuilt([r for r in rows if r[0] >= 0])
    turns = T.numbered_turns(table(spark, [r for r in rows if r[0] >= 0]))
    got = result(T.prefix_trie(T.with_shared_heads(turns), turns.select("conv_id").distinct(), band=3, members=4))
    assert got == plain(want)
    assert any(not s for s in want.values())
    assert T.numbered_turns(table(spark, rows)).where("conv_id = -7").count() == 6


def test_empty(spark):
    for rows in ([], [(None, 1, "u", "x")]):
        out = T.conversation_trie(table(spark, rows))
        assert out.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
        assert out.collect() == []


def test_query_equals_plain_trie(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert result(T.q_op12_trie(spark, sf)) == plain(rebuilt(rows))


def test_spilling_queue(tmp_path):
    rng = random.Random(3)
    q, want = T.SpillingQueue(str(tmp_path), limit=5, block=3), []
    for _ in range(2000):
        if want and rng.random() < 0.4:
            assert q.first() == min(want)
            got = q.pop()
            want.remove(got)
        else:
            item = (rng.randrange(-50, 50), rng.randrange(9), rng.randrange(1 << 40))
            q.push(item)
            want.append(item)
    assert [q.pop() for _ in range(len(want))] == sorted(want)
    assert q.first() is None and not list(tmp_path.iterdir())


def test_a_long_conversation_spreads_over_ranges(spark):
    rows = [(1, k, "u", f"t{k % 5}") for k in range(4000)] + [(c, 0, "u", "t0") for c in range(2, 60)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        turns = T.numbered_turns(table(spark, rows))
        got = turns.where("conv_id = 1").selectExpr("min(pos)", "max(pos)", "count(distinct pos)").first()
        assert tuple(got) == (1, 4000, 4000)
        assert result(T.conversation_trie(table(spark, rows), band=100)) == plain(ordered(rows))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
