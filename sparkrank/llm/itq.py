"""Embedding near-duplicates by iterative quantisation and multi-index Hamming tables.

1. Exact copies are collapsed into classes by a digest of their components.
2. Iterative quantisation: on a sample of at most ``SAMPLE_VECTORS`` expected classes, a
   projection to principal components and a rotation that brings the projected vectors close
   to balanced binary codes (alternating signs and an orthogonal Procrustes step) are learned;
   several rotations start from different seeds. Every class is encoded and indexed.
3. Multi-index tables: codes are cut into segments; each class is stored under the Hamming ball
   of radius one around each segment, so two classes meet wherever a segment differs in at most
   two bits; each such pair is let through at one of its meeting points only, if the distance
   of its complete codes is possible at the asked cosine.
4. Candidates are reranked with the original vectors: cosine in double precision, links from
   ``MIN_COSINE`` on, none below.

The segment width follows the number of classes (buckets stay small at any size). Centring and
projecting change angles, so how often code bits differ is measured on pairs at the asked cosine:
sampled vectors with partners made by noise and by differences of other vectors, and the sampled
pairs there are. The number of rotations follows, so that the chance to meet is at least ``RECALL``
over each kind of pairs and ``HARD_RECALL`` over its worst tenth; closer pairs meet more surely.
Where that takes more than ``MAX_ROTATIONS``, segments are made narrower until it does not: buckets
grow then, in the extreme (two bits) until all meet. Vectors are compared with those of their own
dimension, each dimension with a quantiser and tables of its own. Recall is measured in the tests.

Edge cases: vectors that are null, empty, zero or hold null or non-finite components link with
nothing; a vector's copies are its links; a null id never names a component unless it is alone;
repeated rows count as vectors of their own; an empty table gives an empty result; other columns
are ignored. Dimensions are gone through one after the other, so there should be few.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, prepare, table
from .components import components

MIN_COSINE = 0.9
RECALL = 0.97
HARD_RECALL = 0.93
SAMPLE_VECTORS = 20_000
MEASURED = 2_000
MAX_ROTATIONS = 32
STEPS = 50
MAX_BITS = 64
#: Codes a stored point carries for the distance check, however many rotations there are.
CARRIED = 4


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(vec_id, key, dim)``: key is null for vectors that link with nothing."""
    for b in batches:
        keys, dims = [], []
        for v in b.column(1):
            x = None if not v.is_valid else v.values
            a = np.array([]) if x is None or x.null_count else x.to_numpy(zero_copy_only=False).astype(np.float64) + 0.0
            good = len(a) > 0 and np.isfinite(a).all() and a.any()
            keys.append(hashlib.blake2b(a.tobytes(), digest_size=16).digest() if good else None)
            dims.append(len(a) if good else None)
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(keys, pa.binary()), pa.array(dims, pa.int32())], names=["vec_id", "vector", "key", "dim"])


def unit_rows(vectors: pa.Array, dim: int) -> np.ndarray:
    x = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def learn(x: np.ndarray, rotations: int, steps: int = STEPS) -> tuple[np.ndarray, list[np.ndarray]]:
    """Mean and, per rotation, the matrix whose signs are the code bits."""
    mean = x.mean(axis=0)
    centred = x - mean
    bits = min(MAX_BITS, x.shape[1])
    _, axes = np.linalg.eigh(centred.T @ centred)
    axes = axes[:, ::-1][:, :bits]
    v = centred @ axes
    out = []
    for seed in range(rotations):
        r, _ = np.linalg.qr(np.random.default_rng(seed).normal(size=(bits, bits)))
        for _ in range(steps):
            u, _, w = np.linalg.svd(np.where(v @ r >= 0, 1.0, -1.0).T @ v)
            r = w.T @ u.T
        out.append(axes @ r)
    return mean, out


def bit_rates(x: np.ndarray, mean: np.ndarray, turn: np.ndarray, cosine: float) -> list[np.ndarray]:
    """Chances of a bit to differ, for several kinds of pairs at ``cosine``, centred and projected."""
    rng = np.random.default_rng(0)
    some, n = x[rng.permutation(len(x))[:MEASURED]], len(x)
    kinds = []
    for side in (rng.normal(size=some.shape), x[rng.integers(0, n, len(some))] - x[rng.integers(0, n, len(some))]):
        side = side - (side * some).sum(axis=1, keepdims=True) * some
        norm = np.linalg.norm(side, axis=1, keepdims=True)
        ok = norm[:, 0] > 1e-6
        kinds.append((some[ok], cosine * some[ok] + math.sqrt(1 - cosine**2) * side[ok] / norm[ok]))
    a, b = [], []
    for at in range(0, len(some), 200):
        sim = some[at : at + 200] @ x.T
        i, j = np.nonzero((sim >= cosine) & (sim < cosine + 0.3 * (1 - cosine)))
        a.append(some[at + i[:2000]])
        b.append(x[j[:2000]])
    if sum(map(len, a)) >= 50:
        kinds.append((np.concatenate(a), np.concatenate(b)))
    out = []
    for p, q in kinds:
        if not len(p):  # one dimension has no other directions
            continue
        u, v = (p - mean) @ turn, (q - mean) @ turn
        size = np.linalg.norm(u, axis=1) * np.linalg.norm(v, axis=1)
        angle = np.arccos(np.clip((u * v).sum(axis=1) / np.where(size > 0, size, 1.0), -1, 1)) / math.pi
        differ = ((u >= 0) != (v >= 0)).mean()
        out.append(np.clip(angle * max(1.0, differ / max(angle.mean(), 1e-9)), 0.0, 0.5))
    return out


def plan_tables(classes: int, bits: int, rates: list[np.ndarray]) -> tuple[int, int]:
    """``(segment width, rotations)`` for so many classes and the measured chances of bits to differ."""
    widest = min(bits, 32, max(8, math.ceil(math.log2(max(2, classes))) + 2))
    for width in range(widest, 0, -1):
        own = max(1, bits // width)
        for rotations in range(1, MAX_ROTATIONS + 1):
            for p in rates:
                meet = sum(math.comb(width, k) * p**k * (1 - p) ** (width - k) for k in range(3))
                recall = np.sort(1 - (1 - meet) ** (own * rotations))
                if recall.mean() < RECALL or recall[: max(1, len(recall) // 10)].mean() < HARD_RECALL:
                    break
            else:
                return width, rotations
    raise AssertionError("codes of up to two bits always meet")


def _encoder(dim: int, mean: np.ndarray, turns: list[np.ndarray]):
    def run(vectors: pa.Array) -> pa.Array:
        if not len(vectors):
            return pa.array([], type=pa.list_(pa.int64()))
        x = unit_rows(vectors, dim) - mean
        codes = np.zeros((len(x), len(turns)), dtype=np.uint64)
        for t, turn in enumerate(turns):
            on = x @ turn >= 0
            codes[:, t] = (on.astype(np.uint64) << np.arange(on.shape[1], dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
        return pa.array(codes.view(np.int64).tolist(), type=pa.list_(pa.int64()))

    return F.arrow_udf(run, "array<bigint>")


def candidates(coded: DataFrame, width: int, bits: int, rotations: int, p: float) -> DataFrame:
    """``(a, b)``, ``a < b``: classes whose codes meet; ``coded`` has ``cid`` and ``codes``; ``p``: highest chance of a bit to differ.

    A stored point carries the codes of its own and the next rotations, ``CARRIED`` at most; the
    distance check is made on those.
    """
    carried = min(CARRIED, rotations)
    codes = lambda r: ", ".join(f"codes[{(r + i) % rotations}] as c{i}" for i in range(carried))
    segment = "struct({t} as t, {codes}, shiftrightunsigned(codes[{r}], {s}) & {m}L as seg)"
    own = [(r, s) for r in range(rotations) for s in range(bits // width)]
    cells = ", ".join(segment.format(t=t, r=r, codes=codes(r), s=s * width, m=(1 << width) - 1) for t, (r, s) in enumerate(own))
    flips = f"concat(array(c.seg), transform(sequence(0, {width - 1}), i -> c.seg ^ shiftleft(1L, i)))"
    stored = coded.select("cid", F.explode(F.expr(f"array({cells})")).alias("c"))
    stored = stored.select("cid", "c.t", *(f"c.c{i}" for i in range(carried)), "c.seg", F.explode(F.expr(flips)).alias("at"))
    total = bits * carried
    far = min(total, math.ceil(total * p + 5 * math.sqrt(total * p * (1 - p)) * math.sqrt(carried)))
    distance = " + ".join(f"bit_count(x.c{i} ^ y.c{i})" for i in range(carried))
    gap = "(x.seg ^ y.seg)"
    once = f"""case bit_count({gap}) when 0 then x.at = x.seg when 1 then x.at = least(x.seg, y.seg)
        else x.at = least(x.seg ^ ({gap} & -{gap}), x.seg ^ ({gap} ^ ({gap} & -{gap}))) end"""
    met = stored.alias("x").join(stored.alias("y"), F.expr(f"x.t = y.t and x.at = y.at and x.cid < y.cid and {distance} <= {far} and {once}"))
    return met.select(F.col("x.cid").alias("a"), F.col("y.cid").alias("b")).distinct()


def _pairs(classes: DataFrame, dim: int, n: int, cosine: float, sample: int) -> DataFrame:
    """Candidate pairs of the ``n`` classes of one dimension."""
    bits = min(MAX_BITS, dim)
    h = F.shiftrightunsigned(F.xxhash64("key"), 1) / F.lit(float(1 << 63))  # in [0, 1]
    picked = classes.where(h <= sample / n).select("key", "vector").orderBy("key").toArrow()
    if picked.num_rows < 2:
        picked = classes.select("key", "vector").orderBy("key").limit(2).toArrow()
    x = unit_rows(picked["vector"].combine_chunks(), dim)
    mean, turns = learn(x, 1)
    rates = bit_rates(x, mean, turns[0], cosine)
    width, rotations = plan_tables(n, bits, rates)
    mean, turns = learn(x, rotations)
    coded = cut(classes.select("cid", _encoder(dim, mean, turns)("vector").alias("codes")), "vector-codes")
    return candidates(coded, width, bits, rotations, max((float(p.max()) for p in rates), default=0.0))


def near_duplicates(
    rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", cosine: float = MIN_COSINE, sample: int = SAMPLE_VECTORS
) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` for every row; see the module's text."""
    spark = rows.sparkSession
    prepare(spark)
    given = rows.select(F.col(id_col).alias("vec_id"), F.col(vector_col).alias("vector"))
    kinds = {f.name: f.dataType.simpleString() for f in given.schema.fields}
    keyed = cut(given.mapInArrow(_digests, f"vec_id {kinds['vec_id']}, vector {kinds['vector']}, key binary, dim int"), "vectors")
    classes = (
        keyed.where("dim is not null").groupBy("dim", "key")
        .agg(F.min("vec_id").alias("least"), F.count("*").alias("n"), F.first("vector").alias("vector"))
        .withColumn("cid", F.monotonically_increasing_id())
    )
    classes = cut(classes, "vector-classes")
    pairs = spark.createDataFrame([], "a bigint, b bigint")
    for r in classes.groupBy("dim").count().where("count > 1").orderBy("dim").collect():  # one row a dimension
        pairs = pairs.unionByName(_pairs(classes.where(F.col("dim") == r["dim"]), r["dim"], r["count"], cosine, sample))
    side = classes.select("cid", F.transform("vector", lambda c: c.cast("double")).alias("v"))
    side = side.withColumn("norm", F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, c: s + c * c)))
    x, y = (side.select(F.col("cid").alias(k), F.col("v").alias(f"v{k}"), F.col("norm").alias(f"norm{k}")) for k in "ab")
    both = pairs.join(x, "a").join(y, "b")
    dot = F.aggregate(F.zip_with("va", "vb", lambda p, q: p * q), F.lit(0.0), lambda s, c: s + c)
    links = cut(both.where(dot / (F.col("norma") * F.col("normb")) >= cosine).select("a", "b"), "vector-links")
    ends = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    size = classes.select(F.col("cid").alias("b"), "n")
    linked = ends.join(size, "b").groupBy("a").agg(F.sum("n").alias("others")).withColumnRenamed("a", "cid")
    label = components(links).withColumnRenamed("node", "cid")
    full = classes.select("key", "cid", "least", "n").join(linked, "cid", "left").join(label, "cid", "left")
    full = cut(full.withColumn("root", F.coalesce("component", "cid")), "vector-roots")
    least = full.groupBy("root").agg(F.min("least").alias("component_id"))
    shown = full.join(least, "root").select("key", "component_id", (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), F.lit(True).alias("hit"))
    # Only classes with links or copies are joined to the rows.
    found = keyed.select("vec_id", "key").join(shown.where("n_links > 0"), "key", "left")
    component = F.when(F.col("hit"), F.col("component_id")).otherwise(F.col("vec_id"))
    return found.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept")
    )


def q_op2_itq(spark, sf_dir) -> DataFrame:
    """Links and components of all embeddings at cosine 0.9."""
    return near_duplicates(table(spark, sf_dir, "embeddings"))
