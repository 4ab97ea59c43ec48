"""Systems without results, and corpus lines without their fields."""

import pytest
from pyspark.sql import functions as F

from sparkrank.operators import evaluate as E
from sparkrank.plans import experiments as X
from sparkrank.sources import files as FS


def test_a_system_with_an_empty_run_scores_zero(spark):
    run = spark.createDataFrame([(1, 5, 1)], "qid long, doc_id long, rank int")
    qrels = spark.createDataFrame([(1, 5, 1), (2, 6, 1)], "qid long, doc_id long, rel int")
    queries = spark.createDataFrame([(1, "a"), (2, "b")], "qid long, text string")
    got = {r.system: (r.ndcg, r.mrr, r.recall) for r in X.baseline({"bm25": run, "dense": run.limit(0)}, qrels, queries).collect()}
    assert got == {"bm25": (0.5, 0.5, 0.5), "dense": (0.0, 0.0, 0.0)}
    systems = spark.createDataFrame([("x",)], "system string")
    none = run.limit(0).withColumn("system", F.lit("x"))
    assert [tuple(r)[:2] for r in E.macro(none, qrels, queries, systems=systems).collect()] == [("x", 0.0)]


@pytest.mark.parametrize("line", ['{"doc_id":"a"}', '{"text":"x"}', '{"doc_id":null,"text":"x"}'])
def test_a_corpus_line_without_a_field_raises(spark, tmp_path, line):
    (tmp_path / "c.jsonl").write_text('{"doc_id":"b","text":"y"}\n' + line + "\n")
    with pytest.raises(Exception, match="corpus line without"):
        FS.read_corpus_jsonl(spark, f"file://{tmp_path}/c.jsonl").collect()


def test_null_ids_and_infinite_vectors_are_left_out_of_knn(spark):
    from sparkrank.operators import dense as D

    big = 9007199254740993
    rows = [(big, [0.0, 1.0]), (None, [0.0, 1.0]), (5, [float("inf"), 0.0]), (6, [1.0, 0.0]), (7, [float("nan"), 1.0]), (8, None)]
    vectors = spark.createDataFrame(rows, "doc_id long, embedding array<double>")
    queries = spark.createDataFrame([(1, [0.0, 1.0]), (None, [1.0, 0.0]), (2, [float("inf"), 0.0])], "qid long, embedding array<double>")
    assert [(r.qid, r.doc_id, r.rank) for r in D.knn(vectors, queries, 5).orderBy("rank").collect()] == [(1, big, 1), (1, 6, 2)]
    assert [r.doc_id for r in D.valid_vectors(vectors, 2).collect()] == [big, None, 6]
