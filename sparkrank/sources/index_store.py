"""Persisted indexes as Parquet tables.

Lexical index layout under ``path``:

* ``postings``: bucketed by ``doc_id`` (``buckets`` files per table, sorted by doc_id). A
  search joins the broadcast query terms with this scan; because every posting of a document
  sits in one bucket, the per-(qid, doc_id) sum needs **no exchange** and each task ranks its
  own documents, so only ``k`` rows per query and task are shuffled.
* ``doc_stats``, ``term_stats`` (range-partitioned by term, so a term lookup reads few row
  groups) and the one-row ``corpus_stats``; ``meta`` holds the parameters and bucket count.

Bucketed tables are registered in the session catalog with
``CREATE TABLE ... CLUSTERED BY (doc_id) INTO n BUCKETS LOCATION ...``, so a fresh session can
re-attach an index written by another one. Dense vectors (``vectors``) are plain Parquet.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.lexical import LexicalIndex, corpus_stats_of, per_document, postings_of, term_stats_of

DEFAULT_BUCKETS = 64
#: Documents whose postings one task sorts and one search task reads, about.
DOCS_PER_BUCKET = 10_000


def buckets_for(n_docs: int, least: int = 1) -> int:
    """Buckets of an index of ``n_docs`` documents: they grow in number, not in size."""
    return max(least, -(-n_docs // DOCS_PER_BUCKET))


def _table_name(prefix: str) -> str:
    return f"sparkrank_{prefix}_{uuid.uuid4().hex[:12]}"


def save_lexical(index: LexicalIndex, path: str, buckets: int = DEFAULT_BUCKETS) -> None:
    """Write the postings and document lengths, derive the two statistics tables from
    those files, and write the metadata."""
    spark = index.postings.sparkSession
    base = path.rstrip("/")
    name = _table_name("postings")
    # Cluster by doc_id before bucketing. When the per-document term arrays are at hand they
    # are shuffled instead of the exploded postings (same bytes, far fewer rows); the hash
    # partitioning survives the explode, so each task writes exactly one bucket file.
    if index.per_doc is not None:
        clustered = postings_of(index.per_doc.repartition(buckets, "doc_id"))
    else:
        clustered = index.postings.repartition(buckets, "doc_id")
    (
        clustered
        .write.mode("overwrite")
        .bucketBy(buckets, "doc_id")
        .sortBy("doc_id")
        .option("path", f"{base}/postings")
        .saveAsTable(name)
    )
    spark.sql(f"DROP TABLE IF EXISTS {name}")  # external table: data stays, catalog entry goes
    index.doc_stats.write.mode("overwrite").parquet(f"{base}/doc_stats")
    # The statistics come from what was just written, not from the text once more.
    postings = spark.read.schema(index.postings.schema).parquet(f"{base}/postings")
    doc_stats = spark.read.schema(index.doc_stats.schema).parquet(f"{base}/doc_stats")
    term_stats_of(postings).repartitionByRange("term").sortWithinPartitions("term").write.mode("overwrite").parquet(f"{base}/term_stats")
    corpus_stats_of(doc_stats).coalesce(1).write.mode("overwrite").parquet(f"{base}/corpus_stats")
    id_type = index.postings.schema["doc_id"].dataType.simpleString()
    meta = {"k1": index.k1, "b": index.b, "buckets": buckets, "id_type": id_type}
    spark.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1).write.mode("overwrite").text(f"{base}/meta")


def load_lexical(spark: SparkSession, path: str) -> LexicalIndex:
    """Re-attach an index written by ``save_lexical`` (bucketing kept)."""
    base = path.rstrip("/")
    meta = json.loads(spark.read.text(f"{base}/meta").first()[0])
    name = _table_name("postings")
    spark.sql(
        f"CREATE TABLE {name} (doc_id {meta['id_type']}, term STRING, tf INT, dl INT) USING parquet "
        f"CLUSTERED BY (doc_id) SORTED BY (doc_id) INTO {int(meta['buckets'])} BUCKETS LOCATION '{base}/postings'"
    )
    return LexicalIndex(
        postings=spark.table(name),
        doc_stats=spark.read.parquet(f"{base}/doc_stats"),
        term_stats=spark.read.parquet(f"{base}/term_stats"),
        corpus_stats=spark.read.parquet(f"{base}/corpus_stats"),
        k1=float(meta["k1"]),
        b=float(meta["b"]),
        meta={"path": base, "table": name, **meta},
    )


def write_documents(corpus: DataFrame, path: str, buckets: int = DEFAULT_BUCKETS) -> LexicalIndex:
    """An index for one job: a row of terms for each document, written once in buckets of ``doc_id``.

    Postings are unnested where they are read and keep the buckets, so a search sums per document
    without an exchange; nothing of the size of the corpus is held in memory."""
    name = _table_name("documents")
    rows = per_document(corpus, cluster=buckets)
    rows.write.bucketBy(buckets, "doc_id").option("path", path).saveAsTable(name)
    per_doc = corpus.sparkSession.table(name)
    postings, doc_stats = postings_of(per_doc), per_doc.select("doc_id", "dl")
    return LexicalIndex(postings, doc_stats, term_stats_of(postings), corpus_stats_of(doc_stats), per_doc=per_doc)


def save_vectors(vectors: DataFrame, path: str) -> None:
    """``vectors(doc_id, embedding)`` as Parquet (plus ``cell_id`` partitions for IVF)."""
    w = vectors.write.mode("overwrite")
    if "cell_id" in vectors.columns:
        w = w.partitionBy("cell_id")
    w.parquet(path)


def load_vectors(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
