"""File sources and sinks of the reference's collection formats.

* Corpus: JSON lines ``{"doc_id", "text"}``; a repeated id keeps the **last** line (file
  order; with several files, the greatest path is last).
* Queries: TSV ``qid<TAB>text`` split on the **first** tab only, no quoting (quotes and later
  tabs are data); a line without a tab is an error; a repeated qid keeps the last line.
* Judgments: TSV ``qid<TAB>doc_id<TAB>rel``; lines with fewer than 3 fields are skipped, extra
  fields ignored, a non-integer rel is an error, ``rel > 0`` kept, pairs distinct.

The text readers use ``spark.read.text`` (not the CSV reader, which would interpret quotes).
"Last wins" is ``max_by(value, (file path, split start, row id))``: a partial+final
aggregation by id, so duplicates are combined map-side before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _order_key() -> "F.Column":
    return F.struct(F.col("__path"), F.col("__start"), F.col("__row"))


def _with_file_order(df: DataFrame) -> DataFrame:
    return (
        df.withColumn("__path", F.col("_metadata.file_path"))
        .withColumn("__start", F.col("_metadata.file_block_start"))
        .withColumn("__row", F.monotonically_increasing_id())
    )


def read_corpus_jsonl(spark: SparkSession, path: str, id_type: str = "string") -> DataFrame:
    """``(doc_id, text)`` with last-wins on duplicate ids; malformed JSON and a line without
    one of the two fields (or with null in it) fail the job."""
    raw = spark.read.schema(f"doc_id {id_type}, text string").option("mode", "FAILFAST").json(path)
    given = lambda c: F.coalesce(c, F.raise_error(F.lit(f"corpus line without {c}")).cast(raw.schema[c].dataType)).alias(c)
    return (
        _with_file_order(raw)
        .select(given("doc_id"), given("text"), "__path", "__start", "__row")
        .groupBy("doc_id")
        .agg(F.max_by("text", _order_key()).alias("text"))
    )


def read_queries_tsv(spark: SparkSession, path: str, id_type: str = "string") -> DataFrame:
    """``(qid, text)``; text keeps later tabs and quotes verbatim."""
    lines = _with_file_order(spark.read.text(path))
    parts = F.split(F.col("value"), "\t", 2)
    checked = lines.select(
        F.when(F.size(parts) == 2, parts).otherwise(F.raise_error(F.concat(F.lit("query line without a tab: "), F.col("value")))).alias("p"),
        "__path",
        "__start",
        "__row",
    )
    return (
        checked.select(F.col("p")[0].cast(id_type).alias("qid"), F.col("p")[1].alias("text"), "__path", "__start", "__row")
        .groupBy("qid")
        .agg(F.max_by("text", _order_key()).alias("text"))
    )


def read_qrels_tsv(spark: SparkSession, path: str, id_type: str = "string", relevant_only: bool = True) -> DataFrame:
    """S3: ``(qid, doc_id, rel)``; with ``relevant_only`` just distinct relevant pairs (rel 1)."""
    parts = F.split(F.col("value"), "\t", -1)
    rows = (
        spark.read.text(path)
        .filter(F.size(parts) >= 3)
        .select(
            parts[0].cast(id_type).alias("qid"),
            parts[1].cast(id_type).alias("doc_id"),
            parts[2].cast("int").alias("rel"),  # ANSI cast: a non-integer fails the job
        )
    )
    if relevant_only:
        return rows.filter(F.col("rel") > 0).select("qid", "doc_id").distinct().withColumn("rel", F.lit(1))
    return rows


def write_corpus_jsonl(corpus: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Corpus as JSON lines."""
    corpus.select("doc_id", "text").write.mode(mode).json(path)


def write_queries_tsv(queries: DataFrame, path: str, mode: str = "overwrite") -> None:
    """``qid<TAB>text`` lines. The format has no quoting, so a line break inside a query
    cannot be represented: each CR/LF becomes one space (lengths are unchanged)."""
    text = F.translate(F.col("text"), "\r\n", "  ")
    queries.select(F.concat_ws("\t", F.col("qid").cast("string"), text).alias("value")).write.mode(mode).text(path)


def write_qrels_tsv(qrels: DataFrame, path: str, mode: str = "overwrite") -> None:
    """``qid<TAB>doc_id<TAB>rel`` lines, every rel value (0 included)."""
    qrels.select(
        F.concat_ws("\t", F.col("qid").cast("string"), F.col("doc_id").cast("string"), F.col("rel").cast("string")).alias("value")
    ).write.mode(mode).text(path)


def write_results_json(tables: dict[str, DataFrame], path: str, mode: str = "overwrite") -> dict[str, str]:
    """Each experiment table as JSON lines under ``path/<name>``; returns the paths."""
    out = {}
    for name, df in tables.items():
        p = f"{path.rstrip('/')}/{name}"
        df.write.mode(mode).json(p)
        out[name] = p
    return out
