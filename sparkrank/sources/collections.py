"""A collection reader exposing the canonical DataFrames over a folder of Parquet tables.

Canonical schemas:

* ``corpus(doc_id, text)``
* ``queries(qid, text)``
* ``qrels(qid, doc_id, rel)`` (``rel > 0`` is relevant)
* ``vectors(doc_id, embedding array<float>)`` / ``vector_queries(qid, embedding)``

Role mapping for the driver's tables is in ``FIXTURES.md``. Every reader selects only the
columns it needs, so Parquet scans are pruned.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import tokenize
from ..session import broadcast_if_small, written


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents(doc_id, text)``; doc_id is the table's key."""
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``benchmark(item_id AS qid, text)``."""
    return table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("qid"), "text")


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``embeddings(vec_id AS doc_id, embedding)``."""
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("doc_id"), "embedding")


def vector_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The query set of vector searches: every embedding whose id is divisible by 50 (the self
    match stays in), searched against all embeddings."""
    return table(spark, sf_dir, "embeddings").where(F.col("vec_id") % 50 == 0).select(F.col("vec_id").alias("qid"), "embedding")


def latency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events(event_type AS system, value AS ms)``."""
    return table(spark, sf_dir, "events").select(F.col("event_type").alias("system"), F.col("value").alias("ms"))


def prep_qrels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Judgments for corpus preparation: ``labels(doc_id, quality AS rel)`` under one query id."""
    return table(spark, sf_dir, "labels").select(F.lit(0).cast("long").alias("qid"), "doc_id", F.col("quality").alias("rel"))


def text_qrels(corpus_df: DataFrame, queries_df: DataFrame, postings: DataFrame, term_stats: DataFrame) -> DataFrame:
    """Qrels ``(qid, doc_id, rel=1)``: documents whose text contains the query text verbatim.

    Exact. A document containing the query text contains, as whole
    tokens, every token of the query that is not cut by the query's edges ("complete"
    tokens), so the candidates are the postings of the query's rarest complete token; the
    verbatim ``contains`` check runs only on those candidates. Queries without a complete
    token (at most two tokens, both touching an edge) take their candidates from vocabulary
    terms that contain their longest token, which needs the vocabulary only; passages with no
    token at all are checked against every document. These two joins by ``contains`` are planned
    only where such a query exists; everything else is an equi-join.
    """
    q = queries_df.select(
        "qid",
        "text",
        tokenize("text").alias("toks"),
        F.lower("text").rlike(r"^[\p{L}\p{N}_]").alias("cut_head"),
        F.lower("text").rlike(r"[\p{L}\p{N}_]$").alias("cut_tail"),
    )
    n = F.size("toks")
    complete = F.filter(
        F.transform("toks", lambda t, i: F.struct(t.alias("t"), i.alias("i"))),
        lambda s: ~((s["i"] == 0) & F.col("cut_head")) & ~((s["i"] == n - 1) & F.col("cut_tail")),
    )
    q = q.withColumn("complete", F.array_distinct(F.transform(complete, lambda s: s["t"])))
    anchored = q.filter(F.size("complete") > 0)
    # Rarest complete token per query: (qid, term) with min df, ties by term.
    cand_terms = (
        anchored.select("qid", F.explode_outer("complete").alias("term")).filter(F.col("term").isNotNull()).join(term_stats, "term")
    )
    best = cand_terms.groupBy("qid").agg(F.min(F.struct("df", "term")).alias("m")).select("qid", F.col("m.term").alias("term"))
    cands = postings.select("term", "doc_id").join(broadcast_if_small(best), "term").select("qid", "doc_id")
    # Degenerate queries: candidate docs hold a term containing the query's longest token.
    degen = q.filter(F.size("complete") == 0).filter(n > 0).select(
        "qid", F.element_at(F.array_sort(F.transform("toks", lambda t: F.struct((-F.length(t)).alias("l"), t.alias("t")))), 1)["t"].alias("frag")
    )
    pairs = cands
    if not degen.isEmpty():
        degen_terms = term_stats.select("term").join(broadcast_if_small(degen), F.col("term").contains(F.col("frag"))).select("qid", "term").distinct()
        degen_cands = postings.select("term", "doc_id").join(broadcast_if_small(degen_terms), "term").select("qid", "doc_id")
        pairs = cands.unionByName(degen_cands.distinct())
    texts = queries_df.select("qid", F.col("text").alias("qtext"))
    # Candidate pairs (with their query text) are the small side: the corpus is streamed
    # through a broadcast join, never shuffled, and only candidates are checked verbatim. They are
    # written, so counting them does not read the postings once more.
    cand = broadcast_if_small(written(pairs.join(texts, "qid"), "candidates"))
    found = (
        corpus_df.select("doc_id", "text")
        .join(cand, "doc_id")
        .filter(F.col("text").contains(F.col("qtext")))
        .select("qid", "doc_id")
    )
    # Passages without any token (punctuation only) have no index entry point: they are
    # checked against every document, streaming the corpus past the (few) broadcast passages.
    tokenless = q.filter((n == 0) & (F.length("text") > 0)).select("qid", F.col("text").alias("qtext"))
    if tokenless.isEmpty():
        return found.select("qid", "doc_id", F.lit(1).alias("rel"))
    found_tokenless = (
        corpus_df.select("doc_id", "text")
        .join(broadcast_if_small(tokenless), F.col("text").contains(F.col("qtext")))
        .select("qid", "doc_id")
    )
    return found.unionByName(found_tokenless).select("qid", "doc_id", F.lit(1).alias("rel"))
