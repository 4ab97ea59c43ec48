"""Structured Streaming re-aims of the reference's incremental surfaces.

The reference has no streams; these keep an index and answer queries as files arrive.

* ``StreamingIndexer`` (R1): each micro-batch of documents becomes delta tables under the
  index folder, in a ``batch_id=N`` partition written with dynamic partition overwrite, so a
  replayed batch replaces its own output (idempotent) and never double-counts. Ids already
  indexed by earlier batches are rejected (as ``LexicalIndex.add_documents``). Statistics are
  assembled at read time from per-batch deltas: ``df`` = sum of per-batch document
  frequencies, N and avgdl from ``doc_stats``.
* ``stream_search`` (R2): each micro-batch of queries is answered against a static index and
  appended to a ``batch_id``-partitioned result table (idempotent the same way). Ranking uses a
  partitioned window, which is why it runs in ``foreachBatch`` (a stream cannot host it).
* ``stream_responses`` (R2): the whole search response (X7) of each micro-batch, against the
  version of a segmented index that is newest when the batch starts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.search import search_response
from ..session import broadcast_if_small
from ..sources.segment_store import SegmentStore
from ..operators.lexical import DEFAULT_B, DEFAULT_K1, LexicalIndex, build_postings, corpus_stats_of, one_text_per_id, term_stats_of


def _write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    (
        df.withColumn("batch_id", F.lit(int(batch_id)))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch_id")
        .parquet(path)
    )


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


FILES_PER_BATCH = 1000


class StreamingIndexer:
    """Per-batch delta tables below ``path``, all read with explicit schemas: a batch without
    documents or without tokens leaves tables that are empty, not unreadable."""

    def __init__(self, spark: SparkSession, path: str, k1: float = DEFAULT_K1, b: float = DEFAULT_B, id_type: str = "bigint"):
        self.spark, self.path, self.k1, self.b = spark, path.rstrip("/"), k1, b
        self.schemas = {
            "postings": f"doc_id {id_type}, term string, tf int, dl int",
            "doc_stats": f"doc_id {id_type}, dl int",
            "term_df": "term string, df bigint",
            "rejected": f"doc_id {id_type}",
        }

    def _t(self, name: str) -> str:
        return f"{self.path}/{name}"

    def table(self, name: str) -> DataFrame:
        """A delta table with its ``batch_id``; empty before the first batch."""
        schema = f"{self.schemas[name]}, batch_id bigint"
        if not _exists(self.spark, self._t(name)):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self._t(name))

    def process(self, batch: DataFrame, batch_id: int) -> None:
        docs = one_text_per_id(batch.select("doc_id", "text"))
        # Only the ids of the batch are looked for among the indexed ones.
        ids = batch.select("doc_id").distinct()
        seen = self.table("doc_stats").filter(F.col("batch_id") != batch_id).select("doc_id")
        seen = seen.join(broadcast_if_small(ids), "doc_id", "left_semi").distinct()
        _write_batch(seen, self._t("rejected"), batch_id)
        known = self.table("rejected").filter(F.col("batch_id") == batch_id).select("doc_id")
        postings, doc_stats = build_postings(docs.join(broadcast_if_small(known), "doc_id", "left_anti"), shuffled=True)
        _write_batch(postings, self._t("postings"), batch_id)
        _write_batch(doc_stats, self._t("doc_stats"), batch_id)
        _write_batch(term_stats_of(self.table("postings").filter(F.col("batch_id") == batch_id)), self._t("term_df"), batch_id)

    def rejected(self) -> DataFrame:
        """Ids that arrived again after they were indexed."""
        return self.table("rejected").select("doc_id").distinct()

    def index(self) -> LexicalIndex:
        doc_stats = self.table("doc_stats").drop("batch_id")
        term_stats = self.table("term_df").groupBy("term").agg(F.sum("df").cast("long").alias("df"))
        return LexicalIndex(self.table("postings").drop("batch_id"), doc_stats, term_stats, corpus_stats_of(doc_stats), self.k1, self.b)


def stream_index(
    spark: SparkSession, source: str, schema: str, index_path: str, checkpoint: str, fmt: str = "parquet", files_per_batch: int = FILES_PER_BATCH
) -> StreamingIndexer:
    """Index every document file under ``source`` (available-now trigger) into ``index_path``."""
    id_type = spark.createDataFrame([], schema).schema["doc_id"].dataType.simpleString()
    indexer = StreamingIndexer(spark, index_path, id_type=id_type)
    q = (
        spark.readStream.schema(schema)
        .format(fmt)
        .option("maxFilesPerTrigger", files_per_batch)
        .load(source)
        .writeStream.foreachBatch(indexer.process)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    return indexer


def stream_search(
    spark: SparkSession,
    index: LexicalIndex,
    source: str,
    schema: str,
    out_path: str,
    checkpoint: str,
    k: int = 10,
    fmt: str = "parquet",
    files_per_batch: int = FILES_PER_BATCH,
) -> DataFrame:
    """R2: answer every query file under ``source`` with BM25 top-k; returns the result table."""

    def answer(batch: DataFrame, batch_id: int) -> None:
        _write_batch(index.search(batch.select("qid", "text"), k=k), out_path, batch_id)

    q = (
        spark.readStream.schema(schema)
        .format(fmt)
        .option("maxFilesPerTrigger", files_per_batch)
        .load(source)
        .writeStream.foreachBatch(answer)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    return spark.read.parquet(out_path).drop("batch_id")


def stream_segments(spark: SparkSession, source: str, schema: str, path: str, checkpoint: str, max_segments: int = 8, id_type: str = "bigint", files_per_batch: int = 1) -> SegmentStore:
    """R1 on the segmented index: every micro-batch of ``source`` (``files_per_batch``) becomes a segment of the index at
    ``path`` (made if there is none), and segments are merged as their number passes
    ``max_segments``. Runs until all available files are taken; returns the last snapshot.

    A version of the index names whole segments only, so a batch that fails leaves none of its
    documents, and one that is replayed after its version was written finds its ids there and adds
    nothing. Readers keep the version they opened.
    """
    try:
        SegmentStore.create(spark, path, id_type=id_type)
    except AnalysisException as e:
        if "PATH_ALREADY_EXISTS" not in str(e):
            raise

    def take(batch, _) -> None:
        store, _ = SegmentStore.open(batch.sparkSession, path).add(batch.select("doc_id", "text"))
        store.merge(max_segments)

    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)
    rows.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return SegmentStore.open(spark, path)


RESPONSE_SCHEMA = """qid {qid}, query string,
bm25_results array<struct<doc_id {doc}, score double, rank int, snippet string>>,
dense_results array<struct<doc_id {doc}, score double, rank int, snippet string>>,
hybrid_results array<struct<doc_id {doc}, score double, rank int, snippet string>>,
disagreements array<struct<type string, docs string, description string>>"""


def stream_responses(
    spark: SparkSession,
    index_path: str,
    corpus: Callable[[], DataFrame],
    vectors: Callable[[], DataFrame],
    source: str,
    schema: str,
    out_path: str,
    checkpoint: str,
    k: int = 10,
    alpha: float = 0.5,
    method: str = "rrf",
    fmt: str = "parquet",
    files_per_batch: int = FILES_PER_BATCH,
) -> tuple[DataFrame, DataFrame]:
    """R2: answer every query file under ``source`` in full (``plans.search.search_response``);
    returns the tables ``(responses, rejected)`` below ``out_path``.

    Each batch opens the newest version of the index at ``index_path`` and calls ``corpus`` and
    ``vectors``, so documents added between batches are found by later ones, and one batch sees one
    version. A batch writes its rejected queries, then its responses, each into its own partition
    by overwriting it: a replayed batch replaces its output and writes nothing twice.
    """
    kinds = {f.name: f.dataType.simpleString() for f in spark.createDataFrame([], schema).schema.fields}
    doc = {f.name: f.dataType.simpleString() for f in corpus().schema.fields}["doc_id"]
    tables = {"responses": RESPONSE_SCHEMA.format(qid=kinds["qid"], doc=doc), "rejected": f"qid {kinds['qid']}, reason string"}
    base = out_path.rstrip("/")

    def answer(batch: DataFrame, batch_id: int) -> None:
        store = SegmentStore.open(batch.sparkSession, index_path)
        found, rejected = search_response(batch.select("qid", "text"), corpus(), store, vectors(), k=k, alpha=alpha, method=method)
        _write_batch(rejected, f"{base}/rejected", batch_id)
        _write_batch(found, f"{base}/responses", batch_id)

    rows = spark.readStream.schema(schema).format(fmt).option("maxFilesPerTrigger", files_per_batch).load(source)
    rows.writeStream.foreachBatch(answer).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()

    def read(name: str) -> DataFrame:
        full = f"{tables[name]}, batch_id bigint"
        path = f"{base}/{name}"
        table = spark.read.schema(full).parquet(path) if _exists(spark, path) else spark.createDataFrame([], full)
        return table.drop("batch_id")

    return read("responses"), read("rejected")
