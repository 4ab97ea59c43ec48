"""A lexical index of segments, read by term and extended in place.

Layout under the base path:

* ``manifest/v=NNNNNNNN``: one line of JSON per version: parameters and the list of segments with
  their counts. A writer makes a segment's tables first and the next version last, and fails if
  that version exists; a reader takes the greatest version and never looks at anything else, so it
  keeps its snapshot while others write, and a segment whose version was not written does not exist.
* ``<segment>/blocks``: one row per (bucket of documents, term) with the postings as arrays
  ``ids, tfs, dls`` sorted by id; partitioned by a hash of the term, sorted by term in a file.
* ``<segment>/docs (doc_id, dl)``, ``<segment>/terms (term, df)``, and, of segments that delete,
  ``<segment>/dead (doc_id, since)``: documents gone from the segments before this one; their counts
  are in ``terms`` with a minus sign, so statistics are sums over segments at every moment.

A search reads the partitions of its terms only, and of those the row groups and pages that hold
them (the terms are pushed to Parquet up to ``MAX_PUSHED_TERMS``). Buckets grow in number with the
documents (``docs_per_bucket``), so blocks stay bounded; a task that writes has one part of the terms
of at most ``BUCKETS_PER_FILE`` buckets. Blocks of the terms
asked for are shuffled by bucket, as arrays and once for all queries of a query block; the k best of
each query and bucket are ranked over all.

``merge`` rewrites the smallest segments, without their deleted documents, into one where there are
more than ``max_segments`` or where an eighth of a segment's documents is gone, reading postings and
never text. Old files stay for the readers of older versions until ``vacuum`` is called.

Edge cases: null ids are refused by ``add``; a repeated id keeps the smallest text; ids that the
index holds are rejected and returned; an id deleted before may come again; blank documents count in
the statistics; deleting unknown ids does nothing; an empty index answers with no rows.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..functions.text import RANK_DECIMALS
from ..operators.blocks import block_kernel
from ..operators.lexical import DEFAULT_B, DEFAULT_K1, MAX_BROADCAST_QUERY_TERMS, idf_expr, one_text_per_id, per_document, postings_of, query_terms
from ..operators.ordering import top_k
from ..session import broadcast_if_small, scratch_path, ship_package

PARTS = 32
DOCS_PER_BUCKET = 20_000
BUCKETS_PER_FILE = 16
MAX_SEGMENTS = 8
MAX_PUSHED_TERMS = 256
QUERIES_PER_BLOCK = 20_000


def _part(term, parts: int):
    return F.pmod(F.xxhash64(term), F.lit(parts)).cast("int")


def _bucket(doc_id, n: int):
    return F.pmod(F.xxhash64(doc_id, F.lit(1)), F.lit(n)).cast("int")


@dataclass
class SegmentStore:
    """A snapshot of the index at ``path``; ``add``, ``delete`` and ``merge`` give the next one."""

    spark: SparkSession
    path: str
    version: int
    k1: float
    b: float
    parts: int
    docs_per_bucket: int
    id_type: str
    segments: list[dict] = field(default_factory=list)

    # ---- versions ------------------------------------------------------------------------
    @classmethod
    def create(cls, spark, path: str, id_type: str = "bigint", k1: float = DEFAULT_K1, b: float = DEFAULT_B, parts: int = PARTS, docs_per_bucket: int = DOCS_PER_BUCKET) -> SegmentStore:
        """An empty index; fails if there is one at ``path``."""
        return cls(spark, path.rstrip("/"), -1, k1, b, parts, docs_per_bucket, id_type)._commit([])

    @classmethod
    def open(cls, spark, path: str, version: int | None = None) -> SegmentStore:
        """The index at ``path`` as of its last version, or of ``version``."""
        base = path.rstrip("/")
        rows = spark.read.text(f"{base}/manifest/*")
        if version is not None:
            rows = rows.where(F.get_json_object("value", "$.version").cast("int") == version)
        last = rows.agg(F.max_by("value", F.get_json_object("value", "$.version").cast("int"))).first()[0]
        if last is None:
            raise FileNotFoundError(f"no version {version} at {base}")
        return cls(spark, base, **json.loads(last))

    def _commit(self, segments: list[dict]) -> SegmentStore:
        state = {c: getattr(self, c) for c in ("k1", "b", "parts", "docs_per_bucket", "id_type")}
        state |= {"version": self.version + 1, "segments": segments}
        line = self.spark.createDataFrame([(json.dumps(state),)], "value string").coalesce(1)
        line.write.mode("errorifexists").text(f"{self.path}/manifest/v={self.version + 1:08d}")
        return SegmentStore(self.spark, self.path, **state)

    # ---- tables of the snapshot ----------------------------------------------------------
    def _schema(self, name: str) -> str:
        return {
            "blocks": f"bucket int, term string, ids array<{self.id_type}>, tfs array<int>, dls array<int>, part int",
            "docs": f"doc_id {self.id_type}, dl int",
            "terms": "term string, df bigint",
            "dead": f"doc_id {self.id_type}, since int",
        }[name]

    def _read(self, segment: dict, name: str) -> DataFrame:
        return self.spark.read.schema(self._schema(name)).parquet(f"{self.path}/{segment['name']}/{name}")

    def _union(self, name: str, have: str) -> DataFrame:
        """The table of all segments that have it, with ``seg``, their place in the list."""
        out = self.spark.createDataFrame([], self._schema(name)).withColumn("seg", F.lit(0))
        for k, s in enumerate(self.segments):
            if s[have]:
                out = out.unionByName(self._read(s, name).withColumn("seg", F.lit(k)))
        return out

    def dead(self) -> DataFrame:
        """``(doc_id, since)``: the document is gone from the segments before place ``since``."""
        places = {s["name"]: k for k, s in enumerate(self.segments)}
        rows = self._union("dead", "n_dead")
        return rows.select("doc_id", F.col("seg").alias("since")) if places else rows.select("doc_id", "since")

    def docs(self) -> DataFrame:
        """``(doc_id, dl)`` of the documents that the snapshot holds."""
        return self._live(self._union("docs", "n")).select("doc_id", "dl")

    def _live(self, rows: DataFrame) -> DataFrame:
        if not any(s["n_dead"] for s in self.segments):
            return rows
        gone = broadcast_if_small(self.dead().groupBy(F.col("doc_id").alias("gone")).agg(F.max("since").alias("since")))
        return rows.join(gone, (F.col("doc_id") == F.col("gone")) & (F.col("seg") < F.col("since")), "left_anti")

    @property
    def n(self) -> int:
        return sum(s["n"] - s["n_dead"] for s in self.segments)

    @property
    def avgdl(self) -> float:
        return sum(s["total_dl"] for s in self.segments) / self.n if self.n else 0.0

    def term_stats(self) -> DataFrame:
        """``(term, df)`` of the snapshot."""
        return self._union("terms", "has_terms").groupBy("term").agg(F.sum("df").alias("df")).where("df > 0")

    # ---- writing -------------------------------------------------------------------------
    def _write_blocks(self, postings: DataFrame, name: str) -> None:
        """Blocks of ``postings (bucket, part, doc_id, term, tf, dl)`` that come together by
        (run of buckets, part): one task writes one part of the terms of a few buckets."""
        rows = postings.groupBy("run", "part", "bucket", "term").agg(F.sort_array(F.collect_list(F.struct("doc_id", "tf", "dl"))).alias("p"))
        blocks = rows.select("bucket", "term", F.col("p.doc_id").alias("ids"), F.col("p.tf").alias("tfs"), F.col("p.dl").alias("dls"), "part")
        blocks.sortWithinPartitions("part", "term", "bucket").write.partitionBy("part").parquet(f"{self.path}/{name}/blocks")

    def _together(self, rows: DataFrame, n_buckets: int) -> DataFrame:
        """``rows (doc_id, part, ...)`` shuffled by (run of buckets, part), with ``bucket`` and ``run``."""
        rows = rows.withColumn("bucket", _bucket("doc_id", n_buckets)).withColumn("run", F.floor(F.col("bucket") / F.lit(BUCKETS_PER_FILE)).cast("int"))
        return rows.repartition(self._files(n_buckets) * self.parts, "run", "part")

    def _n_buckets(self, n: int) -> int:
        return max(1, -(-n // self.docs_per_bucket))

    def _files(self, n_buckets: int) -> int:
        return max(1, -(-n_buckets // BUCKETS_PER_FILE))

    def _finish(self, name: str, n_buckets: int) -> dict:
        """Term statistics from the blocks just written, and the segment's entry."""
        entry = {"name": name, "n_buckets": n_buckets, "n": 1, "n_dead": 0, "has_terms": True}
        terms = self._read(entry, "blocks").groupBy("term").agg(F.sum(F.size("ids")).cast("long").alias("df"))
        terms.repartitionByRange("term").sortWithinPartitions("term").write.parquet(f"{self.path}/{name}/terms")
        n, total = self._read(entry, "docs").agg(F.count("*"), F.coalesce(F.sum("dl"), F.lit(0))).first()
        return entry | {"n": n, "total_dl": int(total)}

    def add(self, docs: DataFrame) -> tuple[SegmentStore, DataFrame]:
        """Index the documents whose ids are new; ``(next snapshot, rejected ids)``.

        The cost is that of the new documents, and of reading the ids held.
        """
        rows = docs.select(F.col("doc_id").cast(self.id_type).alias("doc_id"), "text")
        rows = rows.withColumn("doc_id", F.coalesce("doc_id", F.raise_error(F.lit("a document without an id"))))
        held = self.docs().select("doc_id")
        rejected = rows.select("doc_id").join(held, "doc_id", "left_semi").distinct()
        fresh = one_text_per_id(rows.join(held, "doc_id", "left_anti"))
        name = f"seg-{uuid.uuid4().hex[:12]}"
        per_doc = per_document(fresh, shuffled=True)
        staged = scratch_path(self.spark, "per-doc")  # tokenised once, for its count and its blocks
        per_doc.write.parquet(staged)
        per_doc = self.spark.read.schema(per_doc.schema).parquet(staged)
        n = per_doc.count()
        if not n:
            return self, rejected
        n_buckets = self._n_buckets(n)
        terms = per_doc.select("doc_id", "dl", F.inline_outer("tfs")).where("term is not null").withColumn("part", _part("term", self.parts))
        self._write_blocks(self._together(terms, n_buckets), name)
        per_doc.select("doc_id", "dl").write.parquet(f"{self.path}/{name}/docs")
        return self._commit([*self.segments, self._finish(name, n_buckets)]), rejected

    def delete(self, ids: DataFrame) -> SegmentStore:
        """Take documents out: their ids, and their counts with a minus sign, as a new segment."""
        ids = ids.select(F.col("doc_id").cast(self.id_type).alias("doc_id")).distinct()
        gone = self.docs().join(ids, "doc_id", "left_semi")
        name = f"seg-{uuid.uuid4().hex[:12]}"
        gone.select("doc_id", F.lit(len(self.segments)).alias("since"), "dl").write.parquet(f"{self.path}/{name}/dead")
        found = self.spark.read.parquet(f"{self.path}/{name}/dead")
        n, total = found.agg(F.count("*"), F.coalesce(F.sum("dl"), F.lit(0))).first()
        if not n:
            return self
        counts = self.postings().join(broadcast_if_small(found.select("doc_id")), "doc_id", "left_semi")
        counts = counts.groupBy("term").agg((-F.count("*")).alias("df"))
        counts.repartitionByRange("term").sortWithinPartitions("term").write.parquet(f"{self.path}/{name}/terms")
        entry = {"name": name, "n_buckets": 0, "n": 0, "n_dead": n, "total_dl": -int(total), "has_terms": True}
        return self._commit([*self.segments, entry])

    def postings(self) -> DataFrame:
        """``(doc_id, term, tf, dl)`` of the snapshot's documents."""
        pairs = F.arrays_zip("ids", "tfs", "dls")
        rows = self._union("blocks", "n").select("seg", "term", F.explode(pairs).alias("p"))
        return self._live(rows.select("seg", "term", F.col("p.ids").alias("doc_id"), F.col("p.tfs").alias("tf"), F.col("p.dls").alias("dl"))).select("doc_id", "term", "tf", "dl")

    def merge(self, max_segments: int = MAX_SEGMENTS, all_of_them: bool = False) -> SegmentStore:
        """One segment in place of the last ones, without their deleted documents.

        Segments are merged from the end of the list, so that what a deletion reaches back to keeps
        its place: as many as leave ``max_segments`` where there are more, and on to the last one of
        which at least an eighth is live only in part."""
        first = len(self.segments)
        if all_of_them:
            first = 0
        elif len(self.segments) > max_segments or 8 * sum(s["n_dead"] for s in self.segments) > sum(s["n"] for s in self.segments):
            first = max(0, max_segments - 1)
            if any(s["n_dead"] for s in self.segments):
                first = 0
            # A merged segment should not be rewritten with every small one: go on while the next is no larger.
            while 0 < first < len(self.segments) and self.segments[first - 1]["n"] <= sum(s["n"] for s in self.segments[first:]):
                first -= 1
        if len(self.segments) - first < 2:
            return self
        tail = SegmentStore(self.spark, self.path, self.version, self.k1, self.b, self.parts, self.docs_per_bucket, self.id_type, self.segments[first:])
        n = tail.n
        name = f"seg-{uuid.uuid4().hex[:12]}"
        kept = self.segments[:first]
        if not n:
            return self._commit(kept)
        n_buckets = self._n_buckets(n)
        self._write_blocks(self._together(tail.postings().withColumn("part", _part("term", self.parts)), n_buckets), name)
        tail.docs().write.parquet(f"{self.path}/{name}/docs")
        return self._commit([*kept, self._finish(name, n_buckets)])

    def vacuum(self) -> list[str]:
        """Remove the files of segments that this version does not name; returns their names."""
        jvm = self.spark.sparkContext._jvm
        root = jvm.org.apache.hadoop.fs.Path(self.path)
        fs = root.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        named = {s["name"] for s in self.segments}
        old = [f.getPath() for f in fs.listStatus(root) if f.getPath().getName().startswith("seg-") and f.getPath().getName() not in named]
        for p in old:
            fs.delete(p, True)
        return sorted(p.getName() for p in old)

    # ---- search --------------------------------------------------------------------------
    def candidates(self, queries: DataFrame, k: int, k1: float | None = None, b: float | None = None) -> DataFrame:
        """``(qid, doc_id, score)``: the k best documents of each query and bucket."""
        ship_package(self.spark)
        qid_type = queries.schema["qid"].dataType
        schema = T.StructType([T.StructField("qid", qid_type), T.StructField("doc_id", T._parse_datatype_string(self.id_type)), T.StructField("score", T.DoubleType())])
        if not self.n or not self.avgdl:
            return self.spark.createDataFrame([], schema)
        asked = query_terms(queries)
        distinct = asked.select("term").distinct()
        some = [r[0] for r in distinct.limit(MAX_PUSHED_TERMS + 1).collect()]
        pushed = len(some) <= MAX_PUSHED_TERMS
        # All that is derived from the queries' terms is broadcast if those are few enough.
        small = F.broadcast if asked.count() <= MAX_BROADCAST_QUERY_TERMS else lambda df: df
        stats = self._union("terms", "has_terms")
        stats = stats.where(F.col("term").isin(some)) if pushed else stats.join(small(distinct), "term", "left_semi")
        idf = stats.groupBy("term").agg(F.sum("df").alias("df")).where("df > 0").select("term", idf_expr(F.lit(self.n), F.col("df")).alias("idf"))
        n_blocks = max(1, -(-queries.count() // QUERIES_PER_BLOCK))
        blocks_of = F.pmod(F.xxhash64("qid"), F.lit(n_blocks)).cast("int")
        weighted = asked.join(small(idf), "term").groupBy("term", blocks_of.alias("qblock"))
        weighted = weighted.agg(F.collect_list("qid").alias("qids"), F.collect_list("idf").alias("idfs"))
        blocks = self._union("blocks", "n")
        if pushed:
            terms = self.spark.createDataFrame([(t,) for t in some], "term string")
            parts = [r[0] for r in terms.select(_part("term", self.parts)).distinct().collect()] if some else []
            blocks = blocks.where(F.col("part").isin(parts) & F.col("term").isin(some))
        joined = blocks.drop("part").join(small(weighted), "term").withColumn("dead", F.lit(None).cast(f"array<{self.id_type}>"))
        if any(s["n_dead"] for s in self.segments):
            joined = joined.drop("dead").join(broadcast_if_small(self._dead_by_bucket()), ["seg", "bucket"], "left")
        kernel = block_kernel(k, self.k1 if k1 is None else k1, self.b if b is None else b, self.avgdl, to_arrow_schema(schema))
        return joined.groupBy("seg", "bucket", "qblock").applyInArrow(kernel, schema)

    def _dead_by_bucket(self) -> DataFrame:
        """``(seg, bucket, dead)``: the deleted ids of each bucket of each segment before them."""
        sizes = [(k, s["n_buckets"]) for k, s in enumerate(self.segments) if s["n"]]
        segments = self.spark.createDataFrame(sizes, "seg int, n_buckets int")
        rows = self.dead().join(F.broadcast(segments), F.col("seg") < F.col("since"))  # at most the few segments
        bucket = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.col("n_buckets")).cast("int")
        return rows.groupBy("seg", bucket.alias("bucket")).agg(F.collect_set("doc_id").alias("dead"))

    def search(self, queries: DataFrame, k: int = 10, k1: float | None = None, b: float | None = None) -> DataFrame:
        """The k best documents of each query: ``(qid, doc_id, score, rank)``."""
        ranked = top_k(self.candidates(queries, k, k1, b), k)
        return ranked.select("qid", "doc_id", F.round("score", RANK_DECIMALS).alias("score"), "rank")
