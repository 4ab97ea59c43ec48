"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, release_memory, scratch_path, ship_package  # noqa: F401 (release_memory: for this package's operators)


#: Batches for Python workers hold at most so many bytes: whole texts of any number of rows would
#: otherwise come in batches of the default 64 MB, several times that as Python objects.
BATCH_BYTES = 4 << 20


def prepare(spark: SparkSession) -> None:
    """Make the package importable by Python workers, fix the shared scratch folder, and bound
    the session's Arrow batches by ``BATCH_BYTES`` unless they are bounded closer already."""
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    now = str(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", "64m")).rstrip("bB")
    if not now.isdigit() or not 0 < int(now) <= BATCH_BYTES:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh table in the shared folder and read it back.

    This cuts the lineage with files every executor can reach, so a lost executor costs a
    re-read, and the work behind ``df`` is done once however often the result is used.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Keys are broadcast up to this measured size, and joined by a shuffle beyond it.
MAX_BROADCAST_KEYS = 1_000_000


#: A join with a side of more rows is merged by a shuffle, whatever size the planner takes it for.
MAX_PLANNED_ROWS = 100_000


def merged_if_large(df: DataFrame, rows: int) -> DataFrame:
    """``df``, a side of a join whose larger side has at most ``rows`` rows.

    The planner takes a table for as large as its files, without the rows that an explode adds, and
    broadcasts through the driver what seems small; beyond ``MAX_PLANNED_ROWS`` it is told to merge.
    """
    return df.hint("merge") if rows > MAX_PLANNED_ROWS else df


def free(df: DataFrame, name: str) -> str:
    """``name``, with underscores behind it until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def _by_key(docs: DataFrame, keys: DataFrame, id_col: str, text_col: str, how: str) -> DataFrame:
    key, h = free(docs, "_key_id"), free(docs, "_key_h")
    some = keys.select(F.col("doc_id").alias(key), F.col("h").alias(h)).distinct()
    some = F.broadcast(some) if some.limit(MAX_BROADCAST_KEYS + 1).count() <= MAX_BROADCAST_KEYS else some
    same = docs[id_col].eqNullSafe(F.col(key)) & (F.xxhash64(docs[text_col]) == F.col(h))
    return docs.join(some, same, how)


def without_rows(docs: DataFrame, keys: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows whose ``(id, hash of the text)`` is in ``keys (doc_id, h)``."""
    return _by_key(docs, keys, id_col, text_col, "left_anti")


def with_rows(docs: DataFrame, keys: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose ``(id, hash of the text)`` is in ``keys (doc_id, h)``."""
    return _by_key(docs, keys, id_col, text_col, "left_semi")


def fold(doc_id: str, parts: int):
    """``crc32(doc_id as text) mod parts``; a null id falls into part 0."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % parts, F.lit(0))


def id_frame(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(doc_id, text)`` whatever other columns the input has; a null text becomes empty."""
    return df.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
