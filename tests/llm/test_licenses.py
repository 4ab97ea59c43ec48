import hashlib
import re

from sparkrank.llm import licenses as L


def plain(text):
    """Canonical form of one text, by hand."""
    lines = [re.sub(r"(?:[^\w\n©]|_)+", " ", x).strip() for x in (text or "").lower().split("\n")]
    kept = [x for x in lines if x and not re.match(r"((copyright|c) |© ?)+[0-9]{4}\b|(copyright (c|©)|© ?copyright|c copyright)( |$)|all rights reserved", x)]
    return " ".join(L.EQUIVALENT.get(w, w) for w in " ".join(kept).replace("©", "").split())


MIT = L.TEXTS[0][1]
TEXTS = [
    (1, None),
    (2, ""),
    (3, " ... \n\n "),
    (4, MIT),
    (5, "Copyright (c) 2020 Someone\n© 2021 x\n(c) 1999 y\nAll rights reserved.\n\n" + MIT.replace(",", "").upper().replace("SUBLICENSE", "sublicence")),
    (6, "Some prose.\n\n" + MIT + "\n\nMore prose."),
    (7, "Text.\nReleased under the MIT licence.\nReleased under the MIT License!\nmore"),
    (None, "Licensed under CC BY-NC 4.0."),
    (8, "prose that says released under the MIT License inside a line"),
    (8, "word " * 60_000),
    (9, "MIT"),
]


def test_canonical(spark, docs_of):
    got = docs_of(TEXTS).select("text", L.canonical("text").alias("form")).collect()
    assert [r.form for r in got] == [plain(r.text) for r in got]
    forms = {plain(MIT), plain(TEXTS[4][1])}
    assert len(forms) == 1


def test_units(spark, docs_of):
    docs = docs_of(TEXTS + [(4, MIT)])
    found = sorted(((r.doc_id or 0, r.unit, r.license_id) for r in L.find_licenses(docs, L.known_licenses(spark)).collect()))
    whole = [(i, u, "MIT") for i in (4, 4, 5) for u in ("paragraph", "text")]
    notice = [(0, u, "CC-BY-NC-4.0") for u in ("line", "paragraph", "text")] + [(9, u, "MIT") for u in ("line", "paragraph", "text")]
    assert found == sorted(whole + [(6, "paragraph", "MIT"), (7, "line", "MIT"), (7, "line", "MIT")] + notice)
    digest = hashlib.sha256(plain(MIT).encode()).hexdigest()
    assert L.find_licenses(docs_of([(4, MIT)]), L.known_licenses(spark)).first().digest == digest
    assert L.find_licenses(docs_of([]), L.known_licenses(spark)).count() == 0
    nothing = spark.createDataFrame([], "license_id string, text string")
    assert L.find_licenses(docs, nothing).count() == 0


def test_query_finds_every_notice_line(spark):
    sf = "/root/testdata/sf0.01"
    df = L.q_op8_licenses(spark, sf)
    assert not re.search("Python|Pandas|Arrow|NestedLoop|Cartesian", df._jdf.queryExecution().executedPlan().toString())
    got = {(r.doc_id, r.unit, r.license_id): r.n for r in df.collect()}
    known = {}
    for k, t in L.known_rows():
        known.setdefault(plain(t), set()).add(k)
    want = {}
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        lines = r.text.split("\n")
        flat = "\n".join(re.sub(r"(?:[^\w\n©]|_)+", " ", x).strip() for x in lines)
        units = [("text", r.text)] + [("paragraph", p) for p in re.split("\n\n+", flat)] + [("line", x) for x in lines if x]
        for unit, t in units:
            for k in known.get(plain(t), ()):
                want[(r.doc_id, unit, k)] = want.get((r.doc_id, unit, k), 0) + 1
    assert got == want and got


def test_full_texts_and_runs_of_paragraphs(spark, docs_of):
    """Texts read from disk, not from the catalogue: a whole text, and texts between other paragraphs."""
    folder = "/usr/share/common-licenses"
    text = {k: open(f"{folder}/{k}").read() for k in ("Apache-2.0", "GPL-2", "GPL-3", "LGPL-3", "MPL-2.0", "CC0-1.0")}
    ids = {"Apache-2.0": "Apache-2.0", "GPL-2": "GPL-2.0-only", "GPL-3": "GPL-3.0-only", "LGPL-3": "LGPL-3.0-only", "MPL-2.0": "MPL-2.0", "CC0-1.0": "CC0-1.0"}
    rows, want = [], set()
    for n, (k, t) in enumerate(text.items()):
        rows += [(2 * n, t), (2 * n + 1, f"Some prose.\n\n{t}\n\n\nMore prose.")]
        want |= {(2 * n, "text", ids[k]), (2 * n + 1, "run", ids[k])}
    start = text["GPL-3"].index("    This program is free software: you can")
    notice = text["GPL-3"][start : text["GPL-3"].index("Also add information")]
    mit = "MIT License\n\nCopyright (c) 2020 Someone\n\n" + MIT.replace("conditions:\n", "conditions:\n\n").replace("Software.\nTHE", "Software.\n\nTHE")
    rows += [(100, f"# tool\n\n{notice}\nimport os\n"), (101, f"Readme\n\n{mit}\n\nEnd"), (102, "permission is\n\n" * 3000), (103, "Released under\n\nthe MIT License.\n\nx")]
    want |= {(100, "run", "GPL-3.0-or-later"), (101, "run", "MIT"), (103, "run", "MIT")}
    got = {(r.doc_id, r.unit, r.license_id) for r in L.find_licenses(docs_of(rows), L.known_licenses(spark)).collect()}
    assert want <= got
    assert not [r for r in got if r[0] == 102]


def test_many_licence_like_paragraphs_take_seconds(spark, docs_of):
    import time

    rows = [(1, "permission is hereby\n\n" * 40_000), (2, "permission is hereby granted free of software\n\n" * 20_000), (3, "redistribution and use\n\nsoftware\n\n" * 10_000)]
    start = time.time()
    assert L.find_licenses(docs_of(rows), L.known_licenses(spark)).count() == 0  # 0.9 MB each
    assert time.time() - start < 60


def test_runs_equal_brute_force(spark, docs_of):
    """Every run of paragraphs, tried one by one."""
    import random

    from pyspark.sql import functions as F

    rng = random.Random(5)
    known = [("A", "a b c d"), ("B", "a b e"), ("C", "b a b c d"), ("D", "one"), ("E", "a b a b"), ("F", "a b c e")]
    table = spark.createDataFrame([(k, t) for k, t in known], "license_id string, text string")
    docs = [(n, "\n\n".join(" ".join(rng.choices("abcde", [4, 4, 2, 2, 1], k=rng.randint(1, 3))) for _ in range(rng.randint(0, 14)))) for n in range(2000)]
    want = set()
    for n, t in docs:
        ps = [p for p in t.split("\n\n") if p]
        for i in range(len(ps)):
            for j in range(i + 2, len(ps) + 1):
                if (i, j) != (0, len(ps)):
                    want |= {(n, k) for k, known_text in known if " ".join(ps[i:j]) == known_text}
    found = L.find_licenses(docs_of(docs), table).where("unit = 'run'").select("doc_id", "license_id").distinct().collect()
    assert {tuple(r) for r in found} == want and len(want) > 50
    sums = spark.createDataFrame([([rng.randint(0, 5) for _ in range(k)],) for k in (0, 1, 2, 3, 10, 1000)], "n array<int>")
    for r in sums.select("n", L.running_sums(F.col("n")).alias("s")).collect():
        assert r.s == [sum(r.n[: i + 1]) for i in range(len(r.n))]
