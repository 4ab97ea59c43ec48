"""SimHash near-duplicates through multi-index hashing.

Fingerprints: the 64-bit majority of the XXH64 values of all word shingles of a whole text.
Links: fingerprints at most ``MAX_BITS`` (3) apart. A fingerprint is cut into two segments of
32 bits; of two linked fingerprints one segment differs in at most one bit, so every
fingerprint is stored in a table under both segments, and looks up the Hamming ball of radius
one around each segment. A pair whose segments differ in one bit is found from the side that
has the bit set, so only the flips that clear a bit are enumerated: 17 probes per segment on
average, and tables of 2**32 keys keep buckets small at billions of rows. Matches are verified
by the complete distance.

Exact copies share a fingerprint and are collapsed before anything else. Near copies that
share a segment would meet as all pairs: before the probe join, fingerprints of a shared
segment are linked through the points at most one bit away from their other segment (at most
33 fingerprints meet in a point, all within two bits of each other), and a bucket whose
members are already one component is not probed at all. Only links between different
components are left for the probe join.

Fingerprints are counted; beyond a small number every join is a merge by a shuffle. The planner
does not see that probes are many times the fingerprints, and would broadcast them.

Edge cases: a null or empty text, or one without words, has fingerprint zero and is linked
like any other; a text with fewer words than a shingle is one shingle; repeated rows share a
fingerprint; a null ``doc_id`` never names a component unless it has no other member; an empty
table gives an empty result; other input columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, merged_if_large, prepare, release_memory, table, with_rows, without_rows
from .components import components

SHINGLE_WORDS = 3
MAX_BITS = 3
SEED = 42
_BLOCK = 1 << 15


def fingerprint(text: bytes, width: int = SHINGLE_WORDS) -> int:
    """Unsigned fingerprint of one whole UTF-8 text."""
    words = text.lower().split()  # bytes: ASCII letters and ASCII white space only
    if not words:
        return 0
    n = max(1, len(words) - width + 1)
    flat, ends = b" ".join(words), np.cumsum([len(w) + 1 for w in words])
    starts = (ends - [len(w) + 1 for w in words])[:n].tolist()
    stops = (ends[min(width, len(words)) - 1 :] - 1).tolist()
    hash_of = xxhash.xxh64_intdigest
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, n, _BLOCK):
        h = np.array([hash_of(flat[i:j], SEED) for i, j in zip(starts[at : at + _BLOCK], stops[at : at + _BLOCK])], dtype="<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def _fingerprints(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(t.as_py(), width) for t in b.column(2)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fp.view(np.int64))], names=["doc_id", "h", "fp"])
        release_memory()

    return run


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE_WORDS) -> DataFrame:
    """``(doc_id, h, fp)`` of every row: the text's hash and its signed 64-bit fingerprint."""
    prepare(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("h"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_fingerprints(width), f"doc_id {kind}, h bigint, fp bigint")


def _segments(fps: DataFrame) -> DataFrame:
    """One row per fingerprint and segment: the segment number packed over its value."""
    hi, lo = F.shiftrightunsigned("fp", 32), F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF))
    part = lambda s, x, y: F.struct((F.lit(s << 32) + x).alias("key"), y.alias("rest"))
    return fps.withColumn("p", F.explode(F.array(part(0, hi, lo), part(1, lo, hi)))).select(
        *fps.columns, F.col("p.key").alias("key"), F.col("p.rest").alias("rest")
    )


def _flips(col: str, only_set: bool) -> str:
    keep = f"({col} & shiftleft(1L, i)) != 0" if only_set else "true"
    return f"concat(array({col}), transform(filter(sequence(0, 31), i -> {keep}), i -> {col} ^ shiftleft(1L, i)))"


def fingerprint_links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``(a, b)``: links whose components are those of "at most ``max_bits`` bits apart".

    ``fps`` has one distinct fingerprint per row in ``fp``. At most 3 bits: two segments of
    radius one cover no more.
    """
    if not 0 <= max_bits <= 3:
        raise ValueError("two segments searched with radius one cover distances up to 3")
    n = fps.count()
    # 1. Fingerprints that share a whole segment meet in points near their other segment.
    seg = _segments(fps)
    shared = seg.groupBy("key").count().where("count > 1").select("key")
    meet = seg.join(merged_if_large(shared, 2 * n), "key").withColumn("point", F.explode(F.expr(_flips("rest", False))))
    near = (
        meet.groupBy("key", "point")
        .agg(F.collect_list("fp").alias("m"))
        .where(F.size("m") > 1)
        .select(F.array_min("m").alias("a"), F.explode("m").alias("b"))
        .where(F.expr(f"bit_count(a ^ b) between 1 and {max_bits}"))
    )
    near = cut(near.distinct(), "near")
    # 2. Probe the tables for links between what is not one component yet.
    label = components(near)
    known = cut(
        fps.join(merged_if_large(label, n).select(F.col("node").alias("fp"), "component"), "fp", "left").select(
            "fp", F.coalesce("component", "fp").alias("c")
        ),
        "labelled",
    )
    table = _segments(known).select("key", F.col("fp").alias("t_fp"), F.col("c").alias("t_c"))
    bucket = table.groupBy("key").agg(F.min("t_c").alias("lo_c"), F.max("t_c").alias("hi_c"))
    probes = _segments(known).select(F.explode(F.expr(_flips_of_segment())).alias("key"), "fp", "c")
    # A probe for each segment and bit: at most 66 a fingerprint.
    open_ = probes.join(merged_if_large(bucket, 66 * n), "key").where("lo_c != c or hi_c != c").select("key", "fp", "c")
    found = open_.join(merged_if_large(table, 66 * n), "key").where(F.expr(f"t_c != c and bit_count(fp ^ t_fp) <= {max_bits}"))
    return near.unionByName(found.select(F.least("fp", "t_fp").alias("a"), F.greatest("fp", "t_fp").alias("b")).distinct())


def _flips_of_segment() -> str:
    # The segment number sits above bit 31 and is left alone.
    return _flips("key", True)


def simhash_components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """``(doc_id, h, fp, component_id, kept)`` of every row; see the module's text.

    ``kept`` marks the rows with the smallest ``(doc_id, h)`` of their component, nulls last:
    all copies of one row, where rows repeat.
    """
    rows = cut(fingerprints(docs, id_col, text_col, width), "simhash")
    order = F.struct(F.col("doc_id").isNull().alias("without"), "doc_id", "h")
    classes = cut(rows.groupBy("fp").agg(F.min(order).alias("first"), F.count("*").alias("n")), "classes")
    n = classes.count()
    label = components(fingerprint_links(classes.select("fp"), max_bits)).withColumnRenamed("node", "fp")
    linked = cut(classes.join(merged_if_large(label, n), "fp", "left").withColumn("root", F.coalesce("component", "fp")), "roots")
    least = linked.groupBy("root").agg(F.min("first").alias("head"))
    # A class of one row that heads its component needs no join.
    shown = linked.join(merged_if_large(least, n), "root").where("n > 1 or first != head").select("fp", "head")
    alone = F.col("head").isNull()
    return rows.join(merged_if_large(shown, n), "fp", "left").select(
        "doc_id",
        "h",
        "fp",
        F.when(alone, F.col("doc_id")).otherwise(F.col("head.doc_id")).alias("component_id"),
        (alone | (order.eqNullSafe(F.col("head")))).alias("kept"),
    )


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with exactly one row of every component, whole and in its own columns."""
    found = cut(simhash_components(docs, id_col, text_col, width, max_bits), "components")
    left = without_rows(docs, found.where("not kept"), id_col, text_col)
    repeated = found.where("kept").groupBy("doc_id", "h").count().where("count > 1").select("doc_id", "h")
    if repeated.isEmpty():
        return left
    single = without_rows(left, repeated, id_col, text_col)
    copies = with_rows(left, repeated, id_col, text_col)
    return single.unionByName(copies.dropDuplicates([id_col, text_col]))


def q_op7_simhash(spark, sf_dir) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    out = simhash_components(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
