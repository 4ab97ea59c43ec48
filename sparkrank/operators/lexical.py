"""Lexical retrieval: BM25 inverted index build, incremental add, batch top-k search.

Tables of an index (all DataFrames, persisted as Parquet by ``sources.index_store``):

* ``postings(doc_id, term, tf, dl)``: one row per (document, distinct term); ``dl`` is
  denormalised so scoring needs no join with ``doc_stats``.
* ``doc_stats(doc_id, dl)``: every document, **including** those with no tokens.
* ``term_stats(term, df)``.
* ``corpus_stats(n, total_dl, avgdl)``: one row.

Plan shape of a build: the corpus scan tokenises and counts terms inside each row, so
``postings`` and ``doc_stats`` need no shuffle; ``term_stats`` is one partial+final hash
aggregation by term; ``corpus_stats`` is a global aggregate of two numbers.

Plan shape of a search: the queries' distinct terms (small, size-checked) are broadcast and joined
with ``postings`` by term (the postings side is never shuffled for the join). What is left of a
document is gathered into one row of terms and weights; rows are packed into blocks, and blocks of
queries are scored against them with arrays, so a (query, document) pair is a row only where it is
among the k best of a block. ``top_k`` ranks those. When the postings come from an index saved with
``bucket_by_doc`` the scan is already clustered by ``doc_id``, so the gathering needs no exchange
and only the local top-k of each task is shuffled. Query terms too many to broadcast are joined by a
shuffle and summed per (qid, doc_id), and so, in one lazy plan, are the matches of a cached index.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..session import bound_batches, ship_package, spread, written
from ..functions.text import RANK_DECIMALS, doc_length, tokenize, with_term_frequencies
from .blocks import packer, scorer
from .ordering import top_k

# The reference's default BM25 parameters.
DEFAULT_K1 = 1.2
DEFAULT_B = 0.75

# Largest query-term table broadcast to every task (rows of (qid, term, idf)).
MAX_BROADCAST_QUERY_TERMS = 5_000_000
# Rows of (qid, term), about, in one block of queries.
TERMS_PER_QUERY_BLOCK = 100_000


def tokenized(corpus: DataFrame, text: str = "text") -> DataFrame:
    return corpus.select("doc_id", tokenize(text).alias("tokens"))


def one_text_per_id(docs: DataFrame) -> DataFrame:
    """``(doc_id, text)`` with the smallest text of a repeated id, the same in every evaluation."""
    return docs.groupBy("doc_id").agg(F.min("text").alias("text"))


def per_document(corpus: DataFrame, cluster: int | None = None, shuffled: bool = False) -> DataFrame:
    """``(doc_id, dl, tfs array<struct<term, tf>>)``: one row per document, no shuffle (or,
    with ``cluster``, one shuffle of the term arrays, never of the text, by doc_id). Texts that
    come from a shuffle (``shuffled``) are spread already; counting their partitions would run it."""
    toks = tokenized(corpus if shuffled else spread(corpus)).withColumn("dl", doc_length("tokens").cast("int"))
    rows = with_term_frequencies(toks, "tokens", "tfs").select("doc_id", "dl", "tfs")
    return rows.repartition(cluster, "doc_id") if cluster else rows


def postings_of(per_doc: DataFrame) -> DataFrame:
    # inline_outer + null filter: a plain ``inline`` makes the optimizer infer a
    # ``size(tfs) > 0`` filter and push it, with the whole tf expression, below the
    # projections that compute it once.
    return (
        per_doc.select("doc_id", "dl", F.inline_outer("tfs"))
        .filter(F.col("term").isNotNull())
        .select("doc_id", "term", "tf", "dl")
    )


def build_postings(corpus: DataFrame, shuffled: bool = False) -> tuple[DataFrame, DataFrame]:
    """B1 + T2/T3: ``(postings, doc_stats)`` from ``corpus(doc_id, text)``; no shuffle."""
    pd_ = per_document(corpus, shuffled=shuffled)
    return postings_of(pd_), pd_.select("doc_id", "dl")


def term_stats_of(postings: DataFrame) -> DataFrame:
    """B2: document frequency per term (partial aggregation before the shuffle by term)."""
    return postings.groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def corpus_stats_of(doc_stats: DataFrame) -> DataFrame:
    """N and avgdl over **all** documents (empty ones count); N = 0 gives avgdl 0.0."""
    return doc_stats.agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum("dl"), F.lit(0)).cast("long").alias("total_dl"),
    ).withColumn("avgdl", F.when(F.col("n") > 0, F.col("total_dl") / F.col("n")).otherwise(F.lit(0.0)))


def idf_expr(n, df) -> "F.Column":
    """``ln(1 + (N - df + 0.5) / (df + 0.5))``; callers drop unseen terms (idf 0)."""
    return F.log(F.lit(1.0) + (n - df + F.lit(0.5)) / (df + F.lit(0.5)))


def bm25_term_score(idf, tf, dl, avgdl, k1, b) -> "F.Column":
    """One term's contribution: ``idf * tf * (k1 + 1) / (tf + k1 * (1 - b + b * dl / avgdl))``."""
    norm = F.lit(1.0) - b + b * dl / avgdl
    return idf * (tf * (k1 + F.lit(1.0))) / (tf + k1 * norm)


def query_terms(queries: DataFrame, text: str = "text") -> DataFrame:
    """Distinct terms of each query (a repeated term counts once); blank queries give none."""
    # explode_outer + null filter: keeps the optimizer from inferring (and pushing down) a
    # size() filter that would tokenise every query twice.
    return (
        queries.select("qid", F.explode_outer(F.array_distinct(tokenize(text))).alias("term"))
        .filter(F.col("term").isNotNull())
    )


@dataclass
class LexicalIndex:
    postings: DataFrame
    doc_stats: DataFrame
    term_stats: DataFrame
    corpus_stats: DataFrame
    k1: float = DEFAULT_K1
    b: float = DEFAULT_B
    meta: dict = field(default_factory=dict)
    per_doc: DataFrame | None = None  # (doc_id, dl, tfs) when built here; lets a save shuffle arrays
    cached: bool = False  # its search stays one lazy plan and writes nothing

    # ---- build -------------------------------------------------------------------------
    @classmethod
    def build(cls, corpus: DataFrame, k1: float = DEFAULT_K1, b: float = DEFAULT_B, persist: bool = False) -> "LexicalIndex":
        """B1-B3 over ``corpus(doc_id, text)``; doc ids must be unique (see ``sources``).

        All four tables derive from one tokenised per-document table. With ``persist`` that
        table (hash-partitioned by doc_id) and the two statistics tables are kept (memory,
        spilling to disk), so a job that uses the index several times tokenises the corpus
        once and scores without shuffling matched pairs; for repeated use across jobs, save it
        with ``sources.index_store`` instead.
        """
        if persist:
            # Cached clustered by doc_id: scans of the cache keep that partitioning, so every
            # search sums per (qid, doc_id) without an exchange, as on a saved bucketed index.
            n = int(corpus.sparkSession.conf.get("spark.sql.shuffle.partitions"))
            per_doc = per_document(corpus, cluster=n).persist(StorageLevel.MEMORY_AND_DISK)
        else:
            per_doc = per_document(corpus)
        postings = postings_of(per_doc)
        doc_stats = per_doc.select("doc_id", "dl")
        term_stats = term_stats_of(postings)
        corpus_stats = corpus_stats_of(doc_stats)
        if persist:
            term_stats = term_stats.persist(StorageLevel.MEMORY_AND_DISK)
            corpus_stats = corpus_stats.persist(StorageLevel.MEMORY_AND_DISK)
        return cls(postings, doc_stats, term_stats, corpus_stats, k1, b, per_doc=per_doc, cached=persist)

    def scalar(self, name: str):
        """A corpus statistic as a scalar subquery (lazy, evaluated once, no join)."""
        return self.corpus_stats.select(name).scalar()

    def idf(self) -> DataFrame:
        """B4 for every indexed term."""
        return self.term_stats.select("term", idf_expr(self.scalar("n"), F.col("df")).alias("idf"))

    # ---- search ------------------------------------------------------------------------
    def _weighted_query_terms(self, queries: DataFrame) -> DataFrame:
        qt = query_terms(queries)
        # Unseen terms have idf 0 and match nothing: the inner join drops them.
        weighted = qt.join(self.term_stats, "term").select(
            "qid", "term", idf_expr(self.scalar("n"), F.col("df")).alias("idf")
        )
        return weighted

    def matched(self, queries: DataFrame, broadcast: bool | None = None) -> DataFrame:
        """Postings of the query terms: ``(qid, doc_id, term, tf, dl, idf)``.

        The query side is broadcast when its row count is at most MAX_BROADCAST_QUERY_TERMS
        (checked with a count over the query batch, never over the corpus); above that the
        join falls back to a shuffle join chosen by the planner.
        """
        wq = self._weighted_query_terms(queries)
        if broadcast is None:
            broadcast = query_terms(queries).count() <= MAX_BROADCAST_QUERY_TERMS
        side = F.broadcast(wq) if broadcast else wq
        return self.postings.join(side, "term")

    def score_all(self, queries: DataFrame, k1=None, b=None, broadcast: bool | None = None) -> DataFrame:
        """BM25 score of every matching (qid, doc_id) (before top-k)."""
        k1 = F.lit(float(self.k1 if k1 is None else k1))
        b = F.lit(float(self.b if b is None else b))
        avgdl = self.scalar("avgdl")
        m = self.matched(queries, broadcast)
        contrib = bm25_term_score(F.col("idf"), F.col("tf"), F.col("dl"), avgdl, k1, b)
        return m.groupBy("qid", "doc_id").agg(F.sum(contrib).alias("score"))

    def best_in_blocks(self, queries: DataFrame, k: int, k1=None, b=None) -> DataFrame:
        """``(qid, doc_id, score)``, the k best of each query among them: k a query and block at most.

        The query terms, with their weights, are written and broadcast."""
        spark = queries.sparkSession
        ship_package(spark)
        bound_batches(spark)
        k1 = F.lit(float(self.k1 if k1 is None else k1))
        b = F.lit(float(self.b if b is None else b))
        asked = written(self._weighted_query_terms(queries).withColumn("avgdl", self.scalar("avgdl")), "query-terms")
        n_blocks = max(1, -(-asked.count() // TERMS_PER_QUERY_BLOCK))
        weighted = written(asked.select("term", "idf", "avgdl").distinct(), "weighted-terms")
        blocks = asked.groupBy(F.pmod(F.xxhash64("qid"), F.lit(n_blocks)).alias("block")).agg(F.collect_list(F.struct("qid", "term")).alias("asked"))
        blocks = written(blocks.select("asked"), "query-blocks")
        weight = bm25_term_score(F.col("idf"), F.col("tf"), F.col("dl"), F.col("avgdl"), k1, b)
        rows = self.postings.join(F.broadcast(weighted), "term").select("doc_id", "term", weight.alias("weight"))
        docs = rows.groupBy("doc_id").agg(F.collect_list("term").alias("terms"), F.collect_list("weight").alias("weights"))
        id_field, qid_field = (T.StructField(c, df.schema[c].dataType) for c, df in (("doc_id", self.postings), ("qid", queries)))
        packed = docs.mapInArrow(packer, f"ids array<{id_field.dataType.simpleString()}>, vocabulary array<string>, sizes binary, codes binary, weights binary")
        schema = T.StructType([qid_field, id_field, T.StructField("score", T.DoubleType())])
        return packed.crossJoin(F.broadcast(blocks)).mapInArrow(scorer(k, to_arrow_schema(schema)), schema)

    def search(
        self, queries: DataFrame, k: int = 10, k1=None, b=None, broadcast: bool | None = None, decimals: int = RANK_DECIMALS
    ) -> DataFrame:
        """Top-k per query ``(qid, doc_id, score, rank)``; only matching docs are returned,
        a query without tokens (or without known terms) returns no rows. Scores keep the
        ranking precision; ``decimals=4`` gives the display score (T5)."""
        if broadcast is None:
            broadcast = query_terms(queries).count() <= MAX_BROADCAST_QUERY_TERMS
        found = self.best_in_blocks(queries, k, k1, b) if broadcast and not self.cached else self.score_all(queries, k1, b, broadcast)
        ranked = top_k(found, k)
        return ranked.select("qid", "doc_id", F.round("score", decimals).alias("score"), "rank")

    # ---- incremental add ----------------------------------------------------------------
    def add_documents(self, new_docs: DataFrame) -> tuple["LexicalIndex", DataFrame]:
        """Append documents whose ids are new; returns ``(index, rejected_ids)``.

        Existing ids are rejected (the reference would double-count them). The statistics are
        merged from the delta: ``term_stats`` = old df + delta df, ``corpus_stats`` from sums,
        so the cost is proportional to the delta plus the vocabulary, not the whole index.
        """
        fresh = one_text_per_id(new_docs).join(self.doc_stats.select("doc_id"), "doc_id", "left_anti")
        rejected = new_docs.select("doc_id").join(self.doc_stats.select("doc_id"), "doc_id", "left_semi").distinct()
        d_post, d_docs = build_postings(fresh, shuffled=True)
        d_terms = term_stats_of(d_post)
        term_stats = (
            self.term_stats.unionByName(d_terms).groupBy("term").agg(F.sum("df").cast("long").alias("df"))
        )
        d_corpus = corpus_stats_of(d_docs)
        corpus_stats = (
            self.corpus_stats.select("n", "total_dl")
            .unionByName(d_corpus.select("n", "total_dl"))
            .agg(F.sum("n").alias("n"), F.sum("total_dl").alias("total_dl"))
            .withColumn("avgdl", F.when(F.col("n") > 0, F.col("total_dl") / F.col("n")).otherwise(F.lit(0.0)))
        )
        idx = LexicalIndex(
            self.postings.unionByName(d_post),
            self.doc_stats.unionByName(d_docs),
            term_stats,
            corpus_stats,
            self.k1,
            self.b,
            dict(self.meta),
        )
        return idx, rejected
