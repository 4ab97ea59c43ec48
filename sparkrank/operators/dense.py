"""Dense retrieval: encoding, normalisation, exact k-NN by squared L2.

Distances follow the reference's index: **squared L2**, lower is better (on unit vectors it
equals ``2 - 2 cos``). Runs carry ``distance`` and rank ascending.

Encoders (D1):

* ``hash_encode``: the built-in stand-in encoder. For each distinct term of a text:
  ``bucket = int(md5(term)[0:8], 16) mod dim``, ``sign = +1`` if the 9th hex digit of the md5 is
  0-7, else -1; ``v[bucket] += sign * tf``; then L2-normalised. It reproduces the plumbing and
  scale of a sentence encoder, **not** its semantic quality.
* ``model_encode``: any Python model over text batches, run with ``mapInPandas`` (the model
  is loaded once per task by the factory; batch size is an option).

Exact k-NN (D4): queries and vectors are packed into blocks inside their own tasks and joined
block by block; a task scores block pairs with a BLAS matmul and keeps a running top-k per query,
so no (query, vector) pair is ever a row. The global top-k is then a partitioned ``row_number``
over those candidates. No query passes through the driver's Python, and the vectors are read
once however many queries there are.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from ..functions.text import RANK_DECIMALS, rank_key, tokenize
from ..session import bound_batches, release_memory, ship_package, spread
from .ordering import top_k

DEFAULT_DIM = 64
# Largest query matrix (float64 bytes) that is broadcast; beyond it blocks are joined by a shuffle.
MAX_QUERY_MATRIX_BYTES = 64 * 1024 * 1024


# ---- D2 -------------------------------------------------------------------------------
def l2_normalize(v) -> "F.Column":
    """``v / ||v||`` in double precision; a zero vector stays zero."""
    v = F.col(v) if isinstance(v, str) else v
    vd = v.cast("array<double>")
    norm = F.sqrt(F.aggregate(vd, F.lit(0.0), lambda a, x: a + x * x))
    return F.when(norm > 0, F.transform(vd, lambda x: x / norm)).otherwise(vd)


# ---- D1: hashing encoder ----------------------------------------------------------------
def term_bucket(term, dim: int = DEFAULT_DIM) -> "F.Column":
    return F.pmod(F.conv(F.substring(F.md5(term), 1, 8), 16, 10).cast("long"), F.lit(dim)).cast("int")


def term_sign(term) -> "F.Column":
    return F.when(F.substring(F.md5(term), 9, 1).isin("0", "1", "2", "3", "4", "5", "6", "7"), F.lit(1)).otherwise(F.lit(-1))


# Tokens that one step of the encoder sums at once, and terms whose bucket a worker remembers.
TOKENS_AT_ONCE = 262_144
MAX_KNOWN_TERMS = 100_000


def _signed_buckets(terms: list[str], dim: int, known: dict[str, int]) -> np.ndarray:
    """``bucket`` of each term, or ``-bucket - 1`` where its sign is -1 (as ``term_bucket``, ``term_sign``)."""
    if len(known) + len(terms) > MAX_KNOWN_TERMS:
        known.clear()
    out = np.empty(len(terms), dtype=np.int64)
    for j, t in enumerate(terms):
        c = known.get(t)
        if c is None:
            h = hashlib.md5(t.encode(), usedforsecurity=False).hexdigest()
            c = int(h[:8], 16) % dim
            known[t] = c = c if h[8] < "8" else -c - 1
        out[j] = c
    return out


def _bucket_sum_udf(dim: int):
    known: dict[str, int] = {}  # in each Python worker

    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def bucket_sum(tokens: pa.Array) -> pa.Array:
        """Unit vectors; sums of signs are whole numbers, so no order of adding changes them."""
        ends = np.cumsum(pc.fill_null(pc.list_value_length(tokens), 0).to_numpy(zero_copy_only=False))
        flat, n = tokens.flatten(), len(tokens)
        out = np.zeros((n, dim))
        row = 0
        while row < n:
            first = int(ends[row - 1]) if row else 0
            stop = max(row + 1, int(np.searchsorted(ends, first + TOKENS_AT_ONCE, side="right")))
            coded = flat.slice(first, int(ends[stop - 1]) - first).dictionary_encode()
            if len(coded):
                code = _signed_buckets(coded.dictionary.to_pylist(), dim, known)[coded.indices.to_numpy()]
                rows = np.repeat(np.arange(stop - row), np.diff(np.r_[first, ends[row:stop]]))
                at = rows * dim + np.where(code < 0, -code - 1, code)
                m = np.bincount(at, weights=np.where(code < 0, -1.0, 1.0), minlength=(stop - row) * dim).reshape(-1, dim)
                norm = np.sqrt((m * m).sum(axis=1, keepdims=True))
                np.divide(m, norm, out=out[row:stop], where=norm > 0)
            row = stop
        release_memory()
        return pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * dim, pa.int32()), pa.array(out.ravel()))

    return bucket_sum


def hash_encode(texts: DataFrame, id_col: str = "doc_id", text: str = "text", dim: int = DEFAULT_DIM) -> DataFrame:
    """D1 + D2: ``(id, embedding array<double>)``, L2-normalised hashed term frequencies.

    The JVM tokenises; the tokens of an Arrow batch are then hashed once for each distinct term
    and summed and normalised by one vectorised bincount, a bounded number of tokens at a time.
    No shuffle.
    """
    ship_package(texts.sparkSession)
    bound_batches(texts.sparkSession)
    toks = spread(texts).select(id_col, tokenize(text).alias("__tokens"))
    return toks.select(id_col, _bucket_sum_udf(dim)(F.col("__tokens")).alias("embedding"))


def model_encode(
    texts: DataFrame,
    model_factory: Callable[[], Callable[[list[str]], np.ndarray]],
    id_col: str = "doc_id",
    text: str = "text",
    batch_size: int = 32,
    normalize: bool = True,
) -> DataFrame:
    """D1 with an external model: ``model_factory()`` is called once per task and must return
    ``encode(list[str]) -> ndarray[n, dim]``. Vectors are L2-normalised in float64."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = model_factory()
        for pdf in batches:
            for start in range(0, len(pdf), batch_size):
                part = pdf.iloc[start : start + batch_size]
                m = np.asarray(encode(part[text].fillna("").tolist()), dtype=np.float64)
                if normalize:
                    nrm = np.linalg.norm(m, axis=1, keepdims=True)
                    m = np.divide(m, nrm, out=np.zeros_like(m), where=nrm > 0)
                yield pd.DataFrame({id_col: part[id_col].to_numpy(), "embedding": list(m)})

    ship_package(texts.sparkSession)
    id_type = texts.schema[id_col].dataType
    schema = T.StructType([T.StructField(id_col, id_type), T.StructField("embedding", T.ArrayType(T.DoubleType()))])
    return texts.select(id_col, text).mapInPandas(run, schema)


def predict_encode(
    texts: DataFrame,
    make_model: Callable[[], Callable[[list[str]], np.ndarray]],
    id_col: str = "doc_id",
    text: str = "text",
    batch_size: int = 32,
    normalize: bool = True,
) -> DataFrame:
    """D1 + D2 with an external model, ``(id, embedding array<float>)``.

    ``make_model()`` runs once in a Python worker, whose later tasks use the same model, and must
    return ``encode(list[str]) -> ndarray[n, dim]``; it gets at most ``batch_size`` texts at a time,
    a null one as ``""``. Vectors are normalised in float64 and kept as float32; a zero vector stays.
    """
    from pyspark.ml.functions import predict_batch_udf

    def make():
        encode = make_model()

        def predict(values: np.ndarray) -> np.ndarray:
            m = np.asarray(encode(values.tolist()), dtype=np.float64)
            if normalize:
                norms = np.sqrt((m * m).sum(axis=1, keepdims=True))
                m = np.divide(m, norms, out=np.zeros_like(m), where=norms > 0)
            return m.astype(np.float32)

        return predict

    ship_package(texts.sparkSession)
    run = predict_batch_udf(make, return_type=T.ArrayType(T.FloatType()), batch_size=batch_size)
    return texts.select(id_col, run(F.coalesce(text, F.lit(""))).alias("embedding"))


# ---- D6 ---------------------------------------------------------------------------------
def valid_vectors(df: DataFrame, dim: int | None = None, col: str = "embedding") -> DataFrame:
    """Drop null vectors, vectors with null, NaN or infinite entries and (if ``dim``) wrong dimensions."""
    limit = F.lit(float("inf"))
    ok = F.col(col).isNotNull() & ~F.exists(col, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == limit))
    if dim is not None:
        ok = ok & (F.size(col) == dim)
    return df.filter(ok)


def dimension(vectors: DataFrame, col: str = "embedding") -> int:
    """Dimension of the index: that of the first vectors stored (0 for an empty table).

    A few rows are read as they are; only if those are all null is the table searched. (A
    filter on a computed vector column would be pushed into the encoder, see ``_packer``.)
    """
    some = [len(r[0]) for r in vectors.select(col).head(32) if r[0] is not None]
    return some[0] if some else int(vectors.agg(F.max(F.size(col))).first()[0] or 0)


# ---- D7 ---------------------------------------------------------------------------------
def summary(vectors: DataFrame, metric: str = "l2sq", index_type: str = "exact") -> DataFrame:
    """One row ``(n_docs, dim, metric, index_type)``."""
    return vectors.agg(F.count(F.lit(1)).alias("n_docs"), F.max(F.size("embedding")).alias("dim")).select(
        "n_docs", "dim", F.lit(metric).alias("metric"), F.lit(index_type).alias("index_type")
    )


# ---- D4 ---------------------------------------------------------------------------------
# Largest (rows x queries) distance block computed at once inside a task (float64 cells).
MAX_BLOCK_CELLS = 4_000_000
# Bytes of vectors in one packed block, of either side.
BLOCK_BYTES = 512 * 1024
# Query states a task keeps at once; the state used longest ago is emitted beyond that.
MAX_STATE_ROWS = 2_000_000

_PAIRS_AT_ONCE = 65_536


class _TopK:
    """Running top-k per query of one block over (query index, doc id, distance) triples, kept as
    three flat arrays sorted by (query, distance rounded to RANK_DECIMALS, doc id); ``kth`` is each
    query's k-th distance so far. Ids are of any type that sorts."""

    def __init__(self, k: int, queries: np.ndarray, qids: pa.Array):
        self.k, self.qids, self.Q = k, qids, queries
        self.qn = (queries * queries).sum(axis=1)
        self.q = np.empty(0, dtype=np.int64)
        self.i: np.ndarray | None = None
        self.d = np.empty(0, dtype=np.float64)
        self.kth = np.full(len(queries), np.inf)

    def merge(self, q: np.ndarray, i: np.ndarray, d: np.ndarray) -> None:
        aq, ad = np.concatenate([self.q, q]), np.concatenate([self.d, d])
        ai = i if self.i is None else np.concatenate([self.i, i])
        order = np.lexsort((ai, np.round(ad, RANK_DECIMALS), aq))
        aq, ai, ad = aq[order], ai[order], ad[order]
        starts = np.r_[0, np.flatnonzero(np.diff(aq)) + 1]
        pos = np.arange(len(aq)) - np.repeat(starts, np.diff(np.r_[starts, len(aq)]))
        keep = pos < self.k
        self.q, self.i, self.d = aq[keep], ai[keep], ad[keep]
        full = pos[keep] == self.k - 1
        self.kth[self.q[full]] = self.d[full]

    def add(self, D: np.ndarray, ids: np.ndarray, low: float, high: float, asking: np.ndarray | None = None) -> None:
        """Score the vectors ``D``, whose norms lie between ``low`` and ``high``, for all queries or
        those ``asking``.

        A query whose norm is further from that range than its k-th distance allows is skipped.
        Candidates come from the BLAS expansion ``|d|^2 + |q|^2 - 2 d.q`` within a tolerance of
        each query's k-th value, of the block or of all rows seen so far; their distances are then
        recomputed exactly as ``sum((d - q)^2)`` and merged in the canonical order, so float noise
        never decides a rank.
        """
        norm = np.sqrt(self.qn)
        gap = np.maximum(0.0, np.maximum(low - norm, norm - high))
        near = gap * gap <= self.kth + 1e-9 * (1.0 + high * high + self.qn)
        qi = np.flatnonzero(near if asking is None else near & asking)
        if not len(qi):
            return
        Q, qn, dn = self.Q[qi], self.qn[qi], (D * D).sum(axis=1)
        rows = max(1, MAX_BLOCK_CELLS // len(qi))
        for a in range(0, len(D), rows):
            Db, dnb, idb = D[a : a + rows], dn[a : a + rows], ids[a : a + rows]
            approx = dnb[:, None] + qn[None, :] - 2.0 * (Db @ Q.T)
            thr = np.partition(approx, self.k - 1, axis=0)[self.k - 1] if len(Db) > self.k else np.full(len(Q), np.inf)
            tol = 1e-9 * (1.0 + dnb.max() + qn)
            r, j = np.nonzero(approx <= (np.minimum(thr, self.kth[qi]) + tol)[None, :])
            if not len(r):
                continue
            exact = np.empty(len(r))
            for p in range(0, len(r), _PAIRS_AT_ONCE):
                diff = Db[r[p : p + _PAIRS_AT_ONCE]] - Q[j[p : p + _PAIRS_AT_ONCE]]
                exact[p : p + _PAIRS_AT_ONCE] = (diff * diff).sum(axis=1)
            self.merge(qi[j], idb[r], exact)

    def rows(self, id_type: pa.DataType) -> pa.RecordBatch:
        ids = pa.array(self.i.tolist(), pa.string()).cast(id_type) if self.i.dtype.kind == "U" else pa.array(self.i).cast(id_type)
        return pa.RecordBatch.from_arrays([self.qids.take(pa.array(self.q)), ids, pa.array(self.d)], names=["qid", "doc_id", "distance"])


def _packer(dim: int, salts: int):
    """Per-task packing of ``(id, embedding, cell)`` rows into blocks of one cell.

    A block is one row ``(cell, salt, tag, ids, matrix, low, high)``: a digest of its ids and
    vectors, the vectors as float64 bytes and the range of their norms. D6 happens here: null vectors, wrong dimensions, null or non-finite
    entries and null ids are left out. (A DataFrame filter on a computed vector column would be
    pushed below the projections that compute it and re-evaluate the whole encoder.)
    """
    block = max(1, BLOCK_BYTES // (8 * dim))

    def row(cell: int, parts: list) -> pa.RecordBatch:
        ids, m = pa.concat_arrays([i for i, _ in parts]), np.concatenate([x for _, x in parts])
        norms, data = np.sqrt((m * m).sum(axis=1)), m.tobytes()
        tag = hashlib.blake2b(repr(ids.to_pylist()).encode() + data, digest_size=16).digest()
        one = [
            pa.array([cell], pa.int32()), pa.array([zlib.crc32(tag) % salts], pa.int32()), pa.array([tag], pa.binary()),
            pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids), pa.array([data], pa.binary()),
            pa.array([norms.min()]), pa.array([norms.max()]),
        ]
        return pa.RecordBatch.from_arrays(one, names=["cell", "salt", "tag", "ids", "matrix", "low", "high"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        count: dict[int, int] = {}
        for b in batches:
            v = b.column(1)
            ok = pc.and_(pc.and_(v.is_valid(), b.column(0).is_valid()), pc.fill_null(pc.equal(pc.list_value_length(v), dim), False))
            b = b.filter(pc.and_(ok, b.column(2).is_valid()))
            if not b.num_rows:
                continue
            x = b.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)  # a null entry is NaN
            finite = np.isfinite(x).all(axis=1)
            x, b = x[finite], b.filter(pa.array(finite))
            cells = b.column(2).to_numpy(zero_copy_only=False)
            order = np.argsort(cells, kind="stable")
            for rows in np.split(order, np.flatnonzero(np.diff(cells[order])) + 1) if len(order) else []:
                cell = int(cells[rows[0]])
                for a in range(0, len(rows), block):
                    some = rows[a : a + block]
                    if count.get(cell, 0) + len(some) > block:
                        yield row(cell, held.pop(cell))
                        del count[cell]
                    held.setdefault(cell, []).append((b.column(0).take(pa.array(some)), x[some]))
                    count[cell] = count.get(cell, 0) + len(some)
            while sum(count.values()) > 8 * block:
                cell = max(count, key=count.get)
                yield row(cell, held.pop(cell))
                del count[cell]
        for cell, parts in held.items():
            yield row(cell, parts)

    return run


def _probing_packer(dim: int):
    """Per-task packing of queries ``(id, embedding, probes)`` into blocks, each vector once.

    A block is one row ``(tag, qids, qmatrix, cells, asked)``: ``cells`` are those that any of its
    queries probes, ``asked`` the bits (query, place of the cell among them). D6 as in ``_packer``.
    """
    block = max(1, BLOCK_BYTES // (8 * dim))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a in range(0, whole.num_rows, block):
                b = whole.slice(a, block)
                v, probes = b.column(1), b.column(2)
                ok = pc.and_(pc.and_(v.is_valid(), b.column(0).is_valid()), pc.fill_null(pc.equal(pc.list_value_length(v), dim), False))
                b = b.filter(pc.and_(ok, pc.fill_null(pc.greater(pc.list_value_length(probes), 0), False)))
                x = b.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
                finite = np.isfinite(x).all(axis=1)
                x, b = x[finite], b.filter(pa.array(finite))
                if not len(x):
                    continue
                ids, probes = b.column(0), b.column(2)
                cells, place = np.unique(probes.flatten().to_numpy(zero_copy_only=False), return_inverse=True)
                asked = np.zeros((len(x), len(cells)), dtype=bool)
                asked[np.repeat(np.arange(len(x)), pc.list_value_length(probes).to_numpy()), place] = True
                data, bits = x.tobytes(), np.packbits(asked, axis=1).tobytes()
                tag = hashlib.blake2b(repr(ids.to_pylist()).encode() + data + bits, digest_size=16).digest()
                lists = [pa.ListArray.from_arrays(pa.array([0, len(y)], pa.int32()), y) for y in (ids, pa.array(cells, pa.int32()))]
                one = [pa.array([tag], pa.binary()), lists[0], pa.array([data], pa.binary()), lists[1], pa.array([bits], pa.binary())]
                yield pa.RecordBatch.from_arrays(one, names=["tag", "qids", "qmatrix", "cells", "asked"])

    return run


def _scorer(k: int, dim: int, id_type: pa.DataType):
    """Per-task scoring of (query block, vector block) rows: the running top-k of each query block
    met, emitted at the end or when more than ``MAX_STATE_ROWS`` results are held. A row with a
    ``cell`` is scored for the block's queries that probe it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        states: dict[bytes, _TopK] = {}
        asking: dict[bytes, dict[int, np.ndarray]] = {}  # of each state, the queries that probe a cell
        for b in batches:
            tags, qids, qmat, ids, mat = (b.column(n) for n in ("tag", "qids", "qmatrix", "ids", "matrix"))
            probing = "cell" in b.schema.names
            low, high = b.column("low").to_pylist(), b.column("high").to_pylist()
            for r in range(b.num_rows):
                key = tags[r].as_py()
                top = states.pop(key, None)
                if top is None:
                    top = _TopK(k, np.frombuffer(qmat[r].as_buffer(), dtype=np.float64).reshape(-1, dim).copy(), qids[r].values)
                    if probing:
                        cells = b.column("cells")[r].as_py()
                        bits = np.frombuffer(b.column("asked")[r].as_buffer(), dtype=np.uint8).reshape(len(top.Q), -1)
                        asking[key] = dict(zip(cells, np.unpackbits(bits, axis=1, count=len(cells)).astype(bool).T))
                states[key] = top  # last used comes last
                names = ids[r].values.to_numpy(zero_copy_only=False)
                names = names.astype(str) if names.dtype == object else names
                some = asking[key][b.column("cell")[r].as_py()] if probing else None
                top.add(np.frombuffer(mat[r].as_buffer(), dtype=np.float64).reshape(-1, dim), names, low[r], high[r], some)
                while len(states) > 1 and sum(len(t.Q) for t in states.values()) * k > MAX_STATE_ROWS:
                    gone = next(iter(states))
                    old = states.pop(gone)
                    asking.pop(gone, None)
                    if len(old.q):
                        yield old.rows(id_type)
        for top in states.values():
            if len(top.q):
                yield top.rows(id_type)

    return run


def knn_candidates(
    vectors: DataFrame,
    queries: DataFrame,
    k: int,
    probe_col: str | None = None,
    query_probe_col: str | None = None,
    max_query_bytes: int = MAX_QUERY_MATRIX_BYTES,
) -> DataFrame:
    """Candidates ``(qid, doc_id, distance)`` that hold the k nearest of every query: at most k for
    each query and task. With ``probe_col`` (of the vectors) and ``query_probe_col`` (an array) a
    vector is scored only for the queries that probe its cell.

    Both sides are packed into blocks in their own tasks and joined block by block. Query blocks of
    at most ``max_query_bytes`` in all are broadcast and the vectors are not shuffled; beyond that
    vector blocks are shuffled once over the salts, query blocks to each salt. Either way the
    vectors are read once, and a query is packed once however many cells it probes: its block
    carries them as bits. Query ids are expected to be unique.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    dim = dimension(vectors)
    qid_type, id_type = queries.schema["qid"].dataType, vectors.schema["doc_id"].dataType
    schema = T.StructType([T.StructField("qid", qid_type), T.StructField("doc_id", id_type), T.StructField("distance", T.DoubleType())])
    n = queries.count() if dim else 0
    if not n:
        return spark.createDataFrame([], schema)
    query_bytes = n * dim * 8
    small = query_bytes <= max_query_bytes
    salts = 1 if small else int(spark.conf.get("spark.sql.shuffle.partitions"))
    packed = "cell int, salt int, tag binary, ids array<{}>, matrix binary, low double, high double"
    cell = F.lit(0) if probe_col is None else F.col(probe_col)
    vb = vectors.select("doc_id", "embedding", cell.cast("int").alias("cell"))
    vb = vb.mapInArrow(_packer(dim, salts), packed.format(id_type.simpleString())).drop("tag")
    parts = max(1, min(4096, math.ceil(query_bytes / BLOCK_BYTES)))
    if query_probe_col is None:
        qb = queries.select("qid", "embedding", F.lit(0).alias("cell")).repartition(parts, F.pmod(F.xxhash64("qid"), F.lit(parts)))
        qb = qb.mapInArrow(_packer(dim, 1), packed.format(qid_type.simpleString()))
        qb = qb.select("cell", "tag", F.col("ids").alias("qids"), F.col("matrix").alias("qmatrix"))
        keys, carried = ["cell"], []
    else:
        # Queries whose nearest cell is the same come together, so a block meets few cells if they probe few.
        first = F.get(query_probe_col, 0)
        qb = queries.select("qid", "embedding", F.col(query_probe_col).cast("array<int>").alias("probes"), first.alias("first"))
        qb = qb.repartition(parts, "first").sortWithinPartitions("first").drop("first")
        qb = qb.mapInArrow(_probing_packer(dim), f"tag binary, qids array<{qid_type.simpleString()}>, qmatrix binary, cells array<int>, asked binary")
        keys, carried = [], ["cell", "cells", "asked"]
    if not small:
        qb = qb.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        pairs = qb.hint("merge").join(vb, [*keys, "salt"])  # streams a query block past the salt's vector blocks
    else:
        pairs = vb.join(F.broadcast(qb), keys) if keys else vb.crossJoin(F.broadcast(qb))
    if not keys:
        pairs = pairs.where(F.array_contains("cells", F.col("cell")))
    pairs = pairs.select("tag", "qids", "qmatrix", "ids", "matrix", "low", "high", *carried)
    return pairs.mapInArrow(_scorer(k, dim, to_arrow_type(id_type)), schema)


def knn(vectors: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """Exact k nearest vectors per query by squared L2: ``(qid, doc_id, distance, rank)``."""
    cand = knn_candidates(vectors, queries, k)
    ranked = top_k(cand, k, score="distance", ascending=True)
    return ranked.select("qid", "doc_id", rank_key("distance").alias("distance"), "rank")


def squared_l2(a, b) -> "F.Column":
    """Pure-SQL squared L2 between two array columns (for small inputs and tests)."""
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x)
