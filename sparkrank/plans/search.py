"""Query answering and index building as batch jobs.

``search_response`` answers a whole batch of queries in one plan: BM25 and dense top-k run
side by side, are fused, and only then is document text joined in (late materialisation:
the text of the top-k rows only) to make snippets. Each query becomes one row with three
ranked lists and its disagreements; blank queries go to a separate ``rejected`` table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import display_score, is_blank, snippet
from ..operators import dense as D
from ..operators import fusion as FU
from ..operators.lexical import LexicalIndex
from ..session import scratch_path, with_text
from .experiments import disagreements

REJECT_REASON = "Query cannot be empty"


@dataclass
class BuiltIndexes:
    lexical: LexicalIndex | None
    vectors: DataFrame | None


def build(corpus: DataFrame, lexical: bool = True, dense: bool = True, encoder=None) -> BuiltIndexes:
    """Build the lexical index, the vector table, or both (``encoder(texts, id_col)``
    defaults to the hashing encoder)."""
    if not (lexical or dense):
        raise ValueError("nothing to build: enable lexical and/or dense")
    enc = encoder or (lambda texts, id_col: D.hash_encode(texts, id_col))
    return BuiltIndexes(
        LexicalIndex.build(corpus) if lexical else None,
        enc(corpus, "doc_id") if dense else None,
    )


def _lists(runs: DataFrame, corpus: DataFrame, n_rows: int, names: tuple[str, ...]) -> DataFrame:
    """``qid`` and one array of entries per list, in rank order, from one long run table."""
    rows = with_text(runs, corpus, n_rows, 1).withColumn(
        "r", F.struct(F.col("rank"), F.col("doc_id"), F.col("score"), snippet("text").alias("snippet"))
    )
    gathered = rows.groupBy("qid").agg(*(F.array_sort(F.collect_list(F.when(F.col("list") == n, F.col("r")))).alias(n) for n in names))
    entry = lambda x: F.struct(x["doc_id"], x["score"], x["rank"], x["snippet"])
    return gathered.select("qid", *(F.transform(n, entry).alias(f"{n}_results") for n in names))


def search_response(
    queries: DataFrame,
    corpus: DataFrame,
    index: LexicalIndex,
    vectors: DataFrame,
    k: int = 10,
    alpha: float = 0.5,
    method: str = "rrf",
    encoder=None,
) -> tuple[DataFrame, DataFrame]:
    """``(responses, rejected)``.

    ``responses``: ``qid, query, bm25_results, dense_results, hybrid_results, disagreements``;
    a list without entries is empty, never null.
    """
    enc = encoder or (lambda texts, id_col: D.hash_encode(texts, id_col))
    rejected = queries.filter(is_blank("text")).select("qid", F.lit(REJECT_REASON).alias("reason"))
    ok = queries.filter(~is_blank("text"))
    n_q = ok.count()
    bm25 = index.search(ok, k=k)
    dense = D.knn(vectors, enc(ok, "qid"), k)
    as_list = lambda run, name, score: run.select(F.lit(name).alias("list"), "qid", "doc_id", F.col(score).alias("score"), F.col("rank").cast("int").alias("rank"))
    # The two retrievals are written once: fusion, disagreements and the lists read them back.
    spark = queries.sparkSession
    path = scratch_path(spark, "response-runs")
    as_list(bm25, "bm25", "score").unionByName(as_list(dense, "dense", "distance")).write.parquet(path)
    two = spark.read.parquet(path)
    bm25 = two.where("list = 'bm25'").drop("list")
    dense = two.where("list = 'dense'").drop("list").withColumnRenamed("score", "distance")
    hyb = FU.hybrid(bm25, dense, alpha=alpha, k=k, method=method)
    dis = disagreements(bm25, dense, hyb).groupBy("qid").agg(
        F.array_sort(F.collect_list(F.struct("type", "docs", "description"))).alias("disagreements")
    )
    runs = two.unionByName(as_list(hyb, "hybrid", "score")).withColumn("score", display_score("score"))
    names = ("bm25", "dense", "hybrid")
    found = _lists(runs, corpus, 3 * n_q * k, names)
    out = ok.select("qid", F.col("text").alias("query")).join(found, "qid", "left").join(dis, "qid", "left")
    kinds = {f.name: f.dataType for f in out.schema.fields}
    full = [F.coalesce(c, F.array().cast(kinds[c])).alias(c) for c in (*(f"{n}_results" for n in names), "disagreements")]
    return out.select("qid", "query", *full), rejected
