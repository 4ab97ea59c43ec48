"""Approximate k-NN with an inverted-file (IVF) index (D5), the Spark re-aim of HNSW.

Build: MLlib ``KMeans`` learns ``nlist`` centroids on about ``SAMPLE_PER_CELL`` vectors a cell,
picked by a hash of their ids; every vector gets its nearest centroid as ``cell_id``. Saved with
``partitionBy("cell_id")``, a cell's vectors in as many files as their number asks for, so a
search reads only the probed cells' directories and a large cell is not one task's work.

Search: each query's ``nprobe`` nearest centroids are found in its own batch (centroids are
``nlist x dim``, bounded by construction); the vector scan is restricted to the union of probed
cells (partition pruning when loaded from disk), blocks of vectors are joined with the query
blocks that ask for their cell (a query is in one block, its cells beside it as bits), and the same
running top-k as in exact search scores them. With
``nprobe = nlist`` the result equals exact search.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import rank_key
from ..session import ship_package
from . import dense as D
from .ordering import top_k

#: Vectors the centroids are learned on, for each cell; all vectors are indexed.
SAMPLE_PER_CELL = 64
#: Vectors of one cell that one task writes, about.
ROWS_PER_FILE = 500_000
#: Queries whose distances to all centroids are held at once.
QUERIES_AT_ONCE = 1_024


@dataclass
class IVFIndex:
    vectors: DataFrame  # doc_id, embedding, cell_id
    centroids: np.ndarray  # nlist x dim, small by construction

    @property
    def nlist(self) -> int:
        return len(self.centroids)

    @classmethod
    def build(cls, vectors: DataFrame, nlist: int | None = None, max_iter: int = 20, seed: int = 7) -> "IVFIndex":
        """Learn ``nlist`` cells (default: the root of the number of vectors) and assign every
        vector to one. Null vectors, wrong dimensions and non-finite entries are left out (D6)."""
        from pyspark.ml.clustering import KMeans
        from pyspark.ml.functions import array_to_vector

        good = D.valid_vectors(vectors, D.dimension(vectors))
        n = good.count()
        nlist = nlist or max(1, math.isqrt(n))
        feats = good.select("doc_id", "embedding", array_to_vector(F.col("embedding").cast("array<double>")).alias("features"))
        model = KMeans(k=max(2, nlist), maxIter=max_iter, seed=seed, featuresCol="features", predictionCol="cell_id")
        share = SAMPLE_PER_CELL * max(2, nlist) / max(1, n)
        some = feats if share >= 1 else feats.where(F.shiftrightunsigned(F.xxhash64("doc_id"), 1) / F.lit(float(1 << 63)) < share)
        model = model.fit(some)
        cells = model.transform(feats).select("doc_id", "embedding", F.col("cell_id").cast("int").alias("cell_id"))
        return cls(cells, np.asarray(model.clusterCenters(), dtype=np.float64))

    def save(self, path: str) -> None:
        """Vectors partitioned by cell, and the centroids, below ``path``."""
        base = path.rstrip("/")
        spark = self.vectors.sparkSession
        size = self.vectors.groupBy("cell_id").agg(F.ceil(F.count("*") / ROWS_PER_FILE).alias("__files"))  # nlist rows
        dealt = self.vectors.join(F.broadcast(size), "cell_id").withColumn("__file", F.pmod(F.xxhash64("doc_id"), F.col("__files")))
        dealt.repartition("cell_id", "__file").drop("__files", "__file").write.partitionBy("cell_id").parquet(f"{base}/vectors")
        rows = [(i, c.tolist()) for i, c in enumerate(self.centroids)]
        spark.createDataFrame(rows, "cell_id int, centroid array<double>").coalesce(1).write.parquet(f"{base}/centroids")

    @classmethod
    def load(cls, spark, path: str) -> "IVFIndex":
        base = path.rstrip("/")
        rows = spark.read.parquet(f"{base}/centroids").orderBy("cell_id").collect()  # nlist rows
        return cls(spark.read.parquet(f"{base}/vectors"), np.array([r["centroid"] for r in rows], dtype=np.float64))

    def probes(self, queries: DataFrame, nprobe: int) -> DataFrame:
        """``(qid, embedding, probes array<int>)``: the nprobe nearest cells of each query."""
        C = self.centroids
        nprobe = min(nprobe, len(C))
        spark = queries.sparkSession
        ship_package(spark)
        bc = spark.sparkContext.broadcast(C)

        @F.arrow_udf("array<int>")
        def nearest(emb: pa.Array) -> pa.Array:
            cents = bc.value
            norms = (cents**2).sum(axis=1)[None]
            good = pc.fill_null(pc.equal(pc.list_value_length(emb), cents.shape[1]), False)
            q = emb.filter(good).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, cents.shape[1])
            order = np.empty((len(q), nprobe), dtype=np.int32)
            for a in range(0, len(q), QUERIES_AT_ONCE):
                d = norms - 2 * q[a : a + QUERIES_AT_ONCE] @ cents.T  # one product per batch
                order[a : a + QUERIES_AT_ONCE] = np.argsort(d, axis=1, kind="stable")[:, :nprobe]
            ends = np.cumsum(np.r_[0, good.to_numpy(zero_copy_only=False) * nprobe])
            return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(order.ravel()))

        return queries.select("qid", "embedding", nearest(F.col("embedding")).alias("probes"))

    def search(self, queries: DataFrame, k: int = 10, nprobe: int | None = None) -> DataFrame:
        nprobe = nprobe or max(1, self.nlist // 3)
        q = self.probes(queries, nprobe)
        cells = sorted({int(c) for row in q.select(F.explode("probes").alias("c")).distinct().collect() for c in row})
        scan = self.vectors.filter(F.col("cell_id").isin(cells))  # partition pruning on disk
        cand = D.knn_candidates(scan, q, k, probe_col="cell_id", query_probe_col="probes")
        ranked = top_k(cand, k, score="distance", ascending=True)
        return ranked.select("qid", "doc_id", rank_key("distance").alias("distance"), "rank")

    def summary(self) -> DataFrame:
        return D.summary(self.vectors, index_type=f"ivf{len(self.centroids)}")
