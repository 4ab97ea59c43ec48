"""Document store, declared collection formats, model encoder, one-pass corpus preparation."""

import contextlib
import io
import json

import numpy as np
import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from sparkrank.operators import corpus as P
from sparkrank.operators import dense as D
from sparkrank.session import scratch_path
from sparkrank.sources import formats as FM
from sparkrank.sources.document_store import DocumentStore
from sparkrank.sources.formats import Field, read_collection, write_lines

FAILS = (PySparkException, Py4JJavaError)
SF = "/root/testdata/sf0.01"


def plan_of(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def test_fetch_reads_few_shards_and_no_shuffled_text(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    store = DocumentStore.write(docs, scratch_path(spark, "store"), shards=40)
    ids = [3, 17, 400]
    wanted = spark.createDataFrame([(i, f"q{i}") for i in ids], "doc_id bigint, qid string")
    got = store.fetch(wanted)
    plan = plan_of(got)
    assert "dynamicpruningexpression" in plan.lower()
    assert "PushedFilters: [In(doc_id" in plan
    assert {(r.doc_id, r.text) for r in got.collect()} == {(r.doc_id, r.text) for r in docs.where(F.col("doc_id").isin(ids)).collect()}
    # What the shards of the wanted ids hold, against all text.
    shards = {r[0] for r in store.documents().where(F.col("doc_id").isin(ids)).select("shard").distinct().collect()}
    size = lambda df: df.agg(F.sum(F.length("text"))).first()[0]
    assert len(shards) <= 3
    assert size(store.documents().where(F.col("shard").isin(list(shards)))) < 0.2 * size(docs)


def test_fetch_of_repeats_unknown_and_null_ids(spark):
    docs = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", None), (None, "z"), ("c", "")], "doc_id string, text string")
    store = DocumentStore.write(docs, scratch_path(spark, "store"), shards=3)
    wanted = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2), ("nope", 3), (None, 4)], "doc_id string, n int")
    got = sorted((r.doc_id or "", r.n, r.text) for r in store.fetch(wanted, "body").withColumnRenamed("body", "text").collect())
    assert got == [("", 4, ""), ("a", 1, "y"), ("a", 1, "y"), ("b", 2, ""), ("nope", 3, "")]
    with pytest.raises(ValueError):
        store.fetch(wanted.withColumn("text", F.lit("")))


def test_fetch_of_more_ids_than_are_pushed_and_empty_store(spark):
    docs = spark.range(1000).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), F.col("id")).alias("text"))
    got = DocumentStore.write(docs, scratch_path(spark, "store"), shards=4).fetch(spark.range(1200).select(F.col("id").cast("int").alias("doc_id")))
    rows = got.collect()
    assert len(rows) == 1200 and all(r.text == (f"t{r.doc_id}" if r.doc_id < 1000 else "") for r in rows)
    empty = DocumentStore.write(docs.limit(0), scratch_path(spark, "store"))
    assert [r.text for r in empty.fetch(spark.createDataFrame([(1,)], "doc_id bigint")).collect()] == [""]


NASTY = ["plain", "tab\there", "line\nbreak\r\n", "back\\slash\\t \\\\n", '"quoted"', "", "ends in \\", "héllo \U0001f600"]


def test_lines_round_trip(spark):
    rows = spark.createDataFrame(list(enumerate(NASTY)), "n int, text string")
    path = scratch_path(spark, "lines")
    write_lines(rows, path)
    back = read_collection(spark, path, "tsv", {"n": Field(0, "int"), "text": Field(1)}, escaped=True)
    assert sorted(map(tuple, back.collect())) == list(enumerate(NASTY))
    plain = read_collection(spark, path, "text", {"n": Field(1, "int"), "line": Field(FM.LINE)}, pattern=r"^(\d+)\t")
    assert plain.count() == len(NASTY) and dict(map(tuple, plain.collect()))[0] == "0\tplain"


def write(tmp_path, name, text):
    (tmp_path / name).mkdir()
    (tmp_path / name / "part").write_text(text, encoding="utf-8")
    return str(tmp_path / name)


def test_formats_fail_on_what_the_mapping_does_not_hold(spark, tmp_path):
    two = {"doc_id": Field("meta.id", "bigint"), "text": Field("body")}
    good = write(tmp_path, "good", json.dumps({"meta": {"id": 1, "x": [2]}, "body": "b", "more": 1}) + "\n")
    assert [tuple(r) for r in read_collection(spark, good, "json", two).collect()] == [(1, "b")]
    for k, line in enumerate(['{"meta": {"id": 1}}', '{"meta": {"id": "x"}, "body": "b"}', "{broken", '{"body": "b"}']):
        with pytest.raises(FAILS):
            read_collection(spark, write(tmp_path, f"json{k}", line + "\n"), "json", two).collect()
    missing = {"doc_id": Field("meta.id", "bigint"), "text": Field("body", required=False)}
    assert [tuple(r) for r in read_collection(spark, write(tmp_path, "opt", '{"meta": {"id": 1}}\n'), "json", missing).collect()] == [(1, None)]
    tsv = {"doc_id": Field(0, "bigint"), "text": Field(1)}
    assert read_collection(spark, write(tmp_path, "t0", "1\ta\tb\n"), "tsv", tsv).first()["text"] == "a\tb"
    for k, line in enumerate(["1", "x\ta"]):
        with pytest.raises(FAILS):
            read_collection(spark, write(tmp_path, f"tsv{k}", line + "\n"), "tsv", tsv).collect()
    with pytest.raises(FAILS):
        read_collection(spark, write(tmp_path, "text0", "no digits\n"), "text", {"n": Field(1)}, pattern=r"^(\d+)").collect()
    with pytest.raises(ValueError):
        read_collection(spark, good, "text", {"n": Field(2)}, pattern=r"^(\d+)")
    with pytest.raises(ValueError):
        read_collection(spark, good, "xml", two)


def test_tsv_with_header_and_empty_files(spark, tmp_path):
    (tmp_path / "h").mkdir()
    for k in range(2):
        (tmp_path / "h" / f"p{k}").write_text(f"text\tid\trest\na{k}\t{k}\tz\n")
    got = read_collection(spark, str(tmp_path / "h"), "tsv", {"doc_id": Field("id", "bigint"), "text": Field("text")}, header=True)
    assert sorted(map(tuple, got.collect())) == [(0, "a0"), (1, "a1")]
    assert read_collection(spark, write(tmp_path, "e", ""), "tsv", {"doc_id": Field("id", "bigint")}, header=True).count() == 0


def test_json_reads_the_declared_columns_only(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = read_collection(spark, f"{SF}/documents.parquet", "parquet", {"doc_id": Field("doc_id", "bigint")})
    assert "ReadSchema: struct<doc_id:bigint>" in plan_of(got) and got.count() == docs.count()


def test_predict_encode(spark):
    def counting_model():  # nested: workers cannot import this module
        return lambda texts: np.array([[len(t), t.count("a"), 0.0] for t in texts], dtype=float)

    rows = spark.createDataFrame([(1, "aab"), (2, ""), (3, None), (4, "bb"), (1, "aab")], "doc_id bigint, text string")
    got = D.predict_encode(rows, counting_model, batch_size=2)
    assert got.schema["embedding"].dataType.simpleString() == "array<float>"
    found = sorted((r.doc_id, tuple(r.embedding)) for r in got.collect())
    unit = tuple(float(np.float32(x / np.sqrt(13.0))) for x in (3, 2, 0))
    assert found == [(1, unit), (1, unit), (2, (0.0, 0.0, 0.0)), (3, (0.0, 0.0, 0.0)), (4, (1.0, 0.0, 0.0))]
    assert D.predict_encode(rows.limit(0), counting_model).count() == 0
    near = D.knn(got.where("doc_id in (1, 4)").distinct(), got.where("doc_id = 4").withColumnRenamed("doc_id", "qid"), 1)
    assert [r.doc_id for r in near.collect()] == [4]


def test_prepared_corpus_equals_its_parts(spark):
    docs = spark.createDataFrame([(i, f"t{i}", i * 2, None) for i in range(50)], "doc_id bigint, text string, rel bigint, __relevant int")
    qrels = spark.createDataFrame([(1, i, i % 3 - 1) for i in range(40, 70)] + [(2, 44, 1), (2, 5, None)], "qid bigint, doc_id bigint, rel int")
    queries = spark.createDataFrame([(1, "a"), (2, "b")], "qid bigint, text string")
    path = scratch_path(spark, "prepared")
    summary = P.prepare_corpus(docs, qrels, queries, 10, path)
    wanted = P.covered_corpus(docs, qrels, 10)
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == sorted(map(tuple, wanted.collect()))
    assert summary.collect() == P.coverage(wanted, qrels, queries).collect()
    none = P.prepare_corpus(docs.limit(0), qrels.limit(0), queries.limit(0), 10, scratch_path(spark, "prepared"))
    assert [(r.n_corpus, r.coverage, r.grade) for r in none.collect()] == [(0, 0.0, "poor")]
