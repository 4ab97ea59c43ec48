"""A document store for fetches by id.

Documents are hashed into shards (a directory each) and sorted by id inside their shard, in
small row groups with a Bloom filter on the id. A fetch joins the wanted rows on
``(shard, doc_id)``: the join's shards prune directories while the job runs (dynamic partition
pruning). Up to ``MAX_PUSHED_IDS`` distinct ids are pushed to Parquet as well, where row groups
and pages without any of them are skipped. Text of other shards is never read, and no text is
shuffled as long as the wanted rows are few enough to broadcast.

Edge cases: null ids are not stored, and a wanted row with a null or unknown id gets the text
``""``; of repeated ids one row stays (the greatest text); a null text is stored as ``""``; an
empty table gives a store without shards' files. Columns of the wanted rows pass through; they
must not be named like the text column or ``shard``.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import MAX_BROADCAST_ROWS, written

#: Documents of a shard, on average, when the number of shards is not given.
SHARD_DOCS = 100_000
#: Distinct ids that a fetch pushes to Parquet besides its join.
MAX_PUSHED_IDS = 256
ROW_GROUP_BYTES = 8 << 20
PAGE_ROWS = 64


class DocumentStore:
    """Documents below ``path``, read by id."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        meta = json.loads(spark.read.text(f"{self.path}/meta").first()[0])
        self.shards, self.id_type = int(meta["shards"]), meta["id_type"]

    @classmethod
    def write(cls, docs: DataFrame, path: str, shards: int | None = None) -> "DocumentStore":
        """Store ``docs(doc_id, text)``: one shuffle of the texts, one task and file per shard."""
        spark, base = docs.sparkSession, path.rstrip("/")
        rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).where("doc_id is not null")
        if shards is None:
            shards = max(1, -(-docs.count() // SHARD_DOCS))
        rows = rows.withColumn("shard", _shard(F.col("doc_id"), shards)).repartition(shards, "shard")
        rows = rows.groupBy("shard", "doc_id").agg(F.max("text").alias("text")).sortWithinPartitions("shard", "doc_id")
        (
            rows.write.partitionBy("shard")
            .option("parquet.block.size", ROW_GROUP_BYTES)
            .option("parquet.page.row.count.limit", PAGE_ROWS)
            .option("parquet.bloom.filter.enabled#doc_id", "true")
            .parquet(f"{base}/documents")
        )
        meta = {"shards": shards, "id_type": docs.schema["doc_id"].dataType.simpleString()}
        spark.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1).write.text(f"{base}/meta")
        return cls(spark, base)

    def documents(self) -> DataFrame:
        """``(doc_id, text, shard)`` of every stored document."""
        return self.spark.read.schema(f"doc_id {self.id_type}, text string, shard int").parquet(f"{self.path}/documents")

    def fetch(self, wanted: DataFrame, text: str = "text") -> DataFrame:
        """``wanted`` (any rows with ``doc_id``, repeats included) with the column ``text``.

        The wanted rows are written once and read by each side of the plan. They are the
        broadcast side up to ``MAX_BROADCAST_ROWS`` rows; beyond that both sides are shuffled.
        """
        if {text, "shard"} & set(wanted.columns):
            raise ValueError(f"wanted rows must not have columns named {text} or shard")
        rows = written(wanted.withColumn("shard", _shard(F.col("doc_id").cast(self.id_type), self.shards)), "wanted")
        few = rows.limit(MAX_BROADCAST_ROWS + 1).count() <= MAX_BROADCAST_ROWS
        side = F.broadcast(rows) if few else rows
        store = self.documents().withColumnRenamed("text", text)
        ids = rows.where("doc_id is not null").select("doc_id").distinct().limit(MAX_PUSHED_IDS + 1).collect()
        if len(ids) <= MAX_PUSHED_IDS:
            store = store.where(F.col("doc_id").isin([r["doc_id"] for r in ids]))
        keys = ["shard", "doc_id"]
        found = store.join(side, keys).select(*wanted.columns, text)
        known = store.select(*keys).join(F.broadcast(rows.select(*keys).distinct()) if few else rows.select(*keys), keys, "left_semi")
        # At most as many known ids as wanted rows, so the same bound holds for them.
        absent = rows.join(F.broadcast(known) if few else known, keys, "left_anti").select(*wanted.columns, F.lit("").alias(text))
        return found.unionByName(absent)


def _shard(doc_id: Column, shards: int) -> Column:
    return F.pmod(F.xxhash64(doc_id), F.lit(shards)).cast("int")
