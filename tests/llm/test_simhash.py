import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sparkrank.llm import simhash as S
from sparkrank.llm.components import components


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="abÉé \t\n\x0b\x0c\r\x1c\x85\xa0Z", max_size=60))
def test_fingerprint(brute, text):
    assert S.fingerprint(text.encode()) == brute[1](text)


def test_blocks(brute, monkeypatch):
    text = " ".join(f"w{i % 700}" for i in range(5000))
    monkeypatch.setattr(S, "_BLOCK", 64)
    assert S.fingerprint(text.encode()) == brute[1](text)


@pytest.mark.parametrize("bits", [0, 1, 2, 3])
def test_links_give_all_components(spark, brute, bits):
    import random

    r = random.Random(7)
    fps = [r.getrandbits(64) for _ in range(60)] + [0, (1 << 64) - 1, 1 << 63, 7, 15]
    for _ in range(340):  # chains and dense clouds around what is there
        x = r.choice(fps)
        for b in r.sample(range(64), r.randint(1, 4)):
            x ^= 1 << b
        fps.append(x)
    for _ in range(60):  # many that share a whole segment
        fps.append(fps[0] ^ (1 << r.randrange(32)) ^ (1 << r.randrange(32)))
    fps = sorted(set(fps))
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in fps]
    links = S.fingerprint_links(spark.createDataFrame(signed, "fp long"), bits)
    assert all(1 <= ((a ^ b) & (1 << 64) - 1).bit_count() <= bits for a, b in links.collect())
    label = {x.node & (1 << 64) - 1: x.component for x in components(links).collect()}
    want = brute[2](fps, bits)
    got = [label.get(f, s[0]) for f, s in zip(fps, signed)]
    assert len(set(zip(want, got))) == len(set(want)) == len(set(got))


def test_probes_are_not_broadcast(spark, tmp_path):
    # 2,000 fingerprints are a file of 16 KB, their probes 68,000 rows.
    spark.range(2000).selectExpr("xxhash64(id) as fp").write.parquet(f"{tmp_path}/fps")
    links = S.fingerprint_links(spark.read.parquet(f"{tmp_path}/fps"))
    plan = links._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastExchange" not in plan and plan.count("SortMergeJoin") == 2
    assert links.count() == 0


def test_components_merge_many_links(spark, monkeypatch):
    from sparkrank.llm import common

    pairs = [(i, i + 1) for i in range(0, 90)] + [(200, i) for i in range(201, 260)]
    links = spark.createDataFrame(pairs, "a long, b long")
    want = sorted(map(tuple, components(links).collect()))
    monkeypatch.setattr(common, "MAX_PLANNED_ROWS", 10)
    assert sorted(map(tuple, components(links).collect())) == want
    assert {c for _, c in want} == {0, 200}


def test_components_of_chains_and_hubs(spark):
    pairs = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(501, 700)] + [(3, 3), (None, 4), (9, 8), (8, 9), (700, 699)]
    got = {r.node: r.component for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {**{i: 100 for i in range(101, 161)}, **{i: 500 for i in range(501, 701)}, 9: 8} | {k: k for k in (100, 500, 8) if k in got}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


ROWS = [(5, None), (3, ""), (9, " \t"), (None, "alone in here with words"), (4, "one two"), (2, "one two"), (4, "one two"), (8, "ONE two")]
ROWS += [(20, "long text " * 40_000), (21, "long text " * 40_000), (None, ""), (30, "same id one text here"), (30, "same id another thing there")]


def test_edges(spark, docs_of):
    got = S.simhash_components(docs_of(ROWS)).collect()
    assert len(got) == len(ROWS)
    by = {}
    for r in got:
        by.setdefault((r.doc_id, r.fp), set()).add((r.component_id, r.kept))
    assert by[(5, 0)] == {(3, False)} and by[(3, 0)] == {(3, True)} and by[(None, 0)] == {(3, False)}
    assert {c for (i, _), v in by.items() if i in (4, 2, 8) for c, _ in v} == {2}
    assert S.simhash_components(docs_of([])).count() == 0
    left = S.one_of_each(docs_of(ROWS + [(2, "one two")]))
    assert left.columns == docs_of([]).columns
    kept = sorted((r.doc_id if r.doc_id is not None else -1, r.text) for r in left.collect())
    assert kept == sorted([(-1, ROWS[3][1]), (2, "one two"), (3, ""), (20, ROWS[8][1]), (30, ROWS[11][1]), (30, ROWS[12][1])])
    assert S.one_of_each(docs_of([])).count() == 0


def test_registered_query(spark, sf, brute):
    texts = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect())
    fps = [brute[1](t) for _, t in texts]
    want = [(i, f"{f:016x}", texts[r][0]) for (i, _), f, r in zip(texts, fps, brute[2](fps))]
    assert sorted(map(tuple, S.q_op7_simhash(spark, sf).collect())) == want
