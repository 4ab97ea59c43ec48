"""The pipeline against brute-force versions of its stages, and its guard."""

import hashlib
import subprocess
import sys

import public_tokenizers
import sentencepiece

import corpus_pipeline as P
from sparkrank.llm import pii, toxicity


def test_stages_in_order():
    assert [n for n, _ in P.STAGES] == ["toxicity", "near_duplicates", "decontamination", "personal_data", "pieces"]


def test_run_equals_brute_force(spark, sf, brute):
    contaminated_rows, fingerprint, groups = brute
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    model = toxicity.train_on_open_fold(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    left = sorted((r.doc_id, r.text) for r in docs.collect() if model.score(r.text) < toxicity.THRESHOLD)
    root = groups([fingerprint(t) for _, t in left])
    left = [x for k, x in enumerate(left) if root[k] == k]
    bad = {r[0] for r in contaminated_rows(left, items) if r[5]}
    left = [(i, pii.mask(t, pii.find(t))) for i, t in left if i not in bad]
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = [(i, len(sp.encode(t)), sp.encode(t), hashlib.sha256(t.encode()).hexdigest(), True) for i, t in left]
    assert sorted(map(tuple, P.run(spark, sf).collect())) == want


def test_stages_keep_columns_and_edges(spark, sf, docs_of):
    rows = [(1, None), (2, ""), (None, None), (None, "mail a@b.cd now"), (3, "dup text here"), (3, "dup text here"), (4, "dup text here"), (5, "long " * 50_000)]
    for table in (docs_of(rows), docs_of([])):
        docs = table
        for name, stage in P.STAGES[:-1]:
            out = stage(spark, docs, sf)
            assert out.columns == docs.columns, name
            assert out.schema.simpleString() == docs.schema.simpleString(), name
            docs = out
        got = docs.collect()
        if table.count():
            assert {(r.doc_id, r.text) for r in got} == {(None, "mail <EMAIL> now"), (1, None), (3, "dup text here"), (5, "long " * 50_000)}
            assert len(got) == 4
        assert P.STAGES[-1][1](spark, docs, sf).count() == len(got)


def test_clashing_columns(spark, sf, docs_of):
    rows = [(1, "first text of three words"), (2, "first text of three words"), (3, "mail a@b.cd")]
    docs = docs_of(rows).selectExpr("*", "7.5D as _toxicity", "'k' as _key_id", "9 as _key_h", "'t' as h_")
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.schema.simpleString() == docs.schema.simpleString(), name
        got = out.collect()
        assert {(r._toxicity, r._key_id, r._key_h, r.h_, r.spans) for r in got} == {(7.5, "k", 9, "t", "s")}, name
    assert {r.doc_id for r in P.near_duplicates(spark, docs, sf).collect()} == {1, 3}


def test_entry_works_without_the_subpackage(tmp_path):
    code = (
        "import sys\n"
        "class Gone:\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name.startswith('sparkrank.llm') or name == 'corpus_pipeline':\n"
        "            raise ModuleNotFoundError(name)\n"
        "sys.meta_path.insert(0, Gone())\n"
        "import __spark_entry__ as e\n"
        "assert 'bm25_topk' in e.queries() and 'pipeline' not in e.queries()\n"
    )
    import os

    root = os.path.dirname(os.path.abspath(P.__file__))
    done = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
