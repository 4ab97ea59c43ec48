"""Scoring of posting blocks: one task per (segment, bucket of documents, block of queries).

A block holds all postings of one term within one bucket of documents, as arrays sorted by
document id. A group of blocks arrives with the queries that ask for their terms, so queries
travel through the plan and never through the driver. Scores of a query are accumulated over the
bucket's documents, strongest term first; once the terms left cannot lift a document unseen so
far to the k-th partial score, they only complete the documents that still can reach it. The
bounds are those of real block contributions, so the result is that of scoring everything.

Postings that lie by document are scored the same way: ``packer`` gathers a task's documents, with
the weights of their terms, into blocks of a bounded number, ``scorer`` meets each of them with
blocks of queries.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from ..functions.text import RANK_DECIMALS
from ..session import release_memory

#: A threshold is only worth its selection while at least so many times the bucket's documents
#: are left among the postings to add. It never changes a result.
SKIP_FACTOR = 4
#: Documents of a block that ``packer`` makes; its postings are at most so many and one batch more.
BLOCK_DOCS = 8_192
BLOCK_POSTINGS = 1_000_000


def ordered_codes(ids: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The distinct ids in ascending order, and each id's place among them (any type that sorts)."""
    coded = ids.dictionary_encode()
    order = pc.array_sort_indices(coded.dictionary).to_numpy()
    place = np.empty(len(order), dtype=np.int64)
    place[order] = np.arange(len(order))
    return coded.dictionary.take(pa.array(order)), place[coded.indices.to_numpy()]


def best(score: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best positive scores, by rounded score and then place."""
    at = np.nonzero(score > 0)[0]
    shown = np.round(score[at], RANK_DECIMALS)
    if len(at) > k:
        least = np.partition(shown, len(shown) - k)[len(shown) - k]
        at, shown = at[shown >= least], shown[shown >= least]
    return at[np.lexsort((at, -shown))[:k]]


def accumulate(blocks: list[tuple[float, np.ndarray, np.ndarray]], n: int, k: int) -> np.ndarray:
    """Scores over ``n`` documents from ``(greatest, places, contributions)`` blocks of one query.

    Documents that cannot be among the k best may be left with a part of their score."""
    blocks = sorted(blocks, key=lambda b: -b[0])
    rest = np.cumsum([b[0] for b in blocks][::-1])[::-1]  # the most that this and later blocks add
    left = np.cumsum([len(b[1]) for b in blocks][::-1])[::-1]
    score, keep = np.zeros(n), None
    for (_, at, add), most, size in zip(blocks, rest.tolist(), left.tolist()):
        if keep is None and n > k and size > SKIP_FACTOR * n:
            kth = np.partition(score, n - k)[n - k]
            if most < kth * (1 - 1e-9):
                keep = score + most >= kth * (1 - 1e-9)
        if keep is None:
            score[at] += add
        else:
            inside = keep[at]
            score[at[inside]] += add[inside]
    return score


def block_kernel(k: int, k1: float, b: float, avgdl: float, schema: pa.Schema):
    """``applyInArrow`` function over the blocks of one bucket: ``(qid, doc_id, score)`` rows, the k
    best of each query among the bucket's documents."""

    def run(table: pa.Table) -> pa.Table:
        cols = {c: table[c].combine_chunks() for c in ("ids", "tfs", "dls", "qids", "idfs")}
        cols = {c: x.chunk(0) if isinstance(x, pa.ChunkedArray) else x for c, x in cols.items()}
        size = pc.list_value_length(cols["ids"]).to_numpy()
        ids, place = ordered_codes(cols["ids"].flatten())
        tf, dl = (cols[c].flatten().to_numpy().astype(np.float64) for c in ("tfs", "dls"))
        part = (tf * (k1 + 1.0)) / (tf + k1 * (1.0 - b + b * dl / avgdl))
        dead = table["dead"].combine_chunks()
        dead = dead.chunk(0) if isinstance(dead, pa.ChunkedArray) else dead
        if dead.null_count < len(dead):
            gone = pc.index_in(dead.flatten().unique(), value_set=ids).drop_null().to_numpy()
            part[np.isin(place, gone)] = 0.0  # a deleted document scores nothing
        stop = np.cumsum(size)
        greatest = [part[i:j].max() if j > i else 0.0 for i, j in zip((stop - size).tolist(), stop.tolist())]
        asked = pc.list_value_length(cols["qids"]).to_numpy()
        qids, query = ordered_codes(cols["qids"].flatten())
        idf, block = cols["idfs"].flatten().to_numpy(), np.repeat(np.arange(len(asked)), asked)
        order = np.argsort(query, kind="stable")
        bounds = np.searchsorted(query[order], np.arange(len(qids) + 1)).tolist()
        out = ([], [], [])
        for q in range(len(qids)):
            mine = []
            for x in order[bounds[q] : bounds[q + 1]].tolist():
                r, w = block[x], idf[x]
                i, j = stop[r] - size[r], stop[r]
                mine.append((w * greatest[r], place[i:j], w * part[i:j]))
            score = accumulate(mine, len(ids), k)
            at = best(score, k)
            out[0].append(np.full(len(at), q))
            out[1].append(at)
            out[2].append(score[at])
        if not out[0]:
            return schema.empty_table()
        q, d, s = (np.concatenate(x) for x in out)
        return pa.Table.from_arrays([qids.take(pa.array(q)).cast(schema.field(0).type), ids.take(pa.array(d)).cast(schema.field(1).type), pa.array(s)], schema=schema)

    return run


def _packed(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    ids, terms, weights = (pa.concat_arrays([b.column(c) for b in parts]) for c in range(3))
    coded = terms.flatten().dictionary_encode()
    lists = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in (ids, coded.dictionary)]
    data = (pc.list_value_length(terms).to_numpy(), coded.indices.to_numpy(), weights.flatten().to_numpy())
    binary = [pa.array([x.astype(t).tobytes()], pa.binary()) for x, t in zip(data, (np.int32, np.int32, np.float64))]
    return pa.RecordBatch.from_arrays([*lists, *binary], names=["ids", "vocabulary", "sizes", "codes", "weights"])


def packer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``(doc_id, terms, weights)`` to blocks ``(ids, vocabulary, sizes, codes, weights)``."""
    held, docs, postings = [], 0, 0
    for whole in batches:
        for a in range(0, whole.num_rows, BLOCK_DOCS):
            b = whole.slice(a, BLOCK_DOCS)
            if held and (docs + b.num_rows > BLOCK_DOCS or postings > BLOCK_POSTINGS):
                yield _packed(held)
                held, docs, postings = [], 0, 0
            held.append(b)
            docs, postings = docs + b.num_rows, postings + len(b.column(1).flatten())
    if held:
        yield _packed(held)
    held.clear()
    release_memory()


def _best_of_block(ids: pa.Array, vocabulary: pa.Array, sizes: np.ndarray, codes: np.ndarray, weights: np.ndarray, asked: pa.Array, k: int):
    """``(query, id, score)`` arrays of the k best documents of each query within one block."""
    qids, terms = asked.flatten()
    known = pc.index_in(terms, value_set=vocabulary)
    qids, known = qids.filter(known.is_valid()).dictionary_encode(null_encoding="encode"), known.drop_null().to_numpy()
    order = pc.array_sort_indices(ids, null_placement="at_start").to_numpy().astype(np.int64)
    n, place = len(ids), np.empty(len(ids), dtype=np.int64)
    place[order] = np.arange(n)
    key = codes.astype(np.int64) * n + np.repeat(place, sizes)
    by_term = np.argsort(key, kind="stable")
    key, weights = key[by_term], weights[by_term]
    new = np.r_[True, key[1:] != key[:-1]]
    if not new.all():  # a repeated document holds a term more than once
        key, weights = key[new], np.add.reduceat(weights, np.flatnonzero(new))
    at = key % n
    bounds = np.searchsorted(key, np.arange(len(vocabulary) + 1) * n)
    greatest = np.maximum.reduceat(weights, bounds[:-1]).tolist() if len(key) else []
    bounds, query = bounds.tolist(), qids.indices.to_numpy()
    by_query = np.argsort(query, kind="stable")
    stops = np.searchsorted(query[by_query], np.arange(len(qids.dictionary) + 1)).tolist()
    known = known[by_query].tolist()
    out = ([np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0)])
    for q, (i, j) in enumerate(zip(stops, stops[1:])):
        score = accumulate([(greatest[t], at[bounds[t] : bounds[t + 1]], weights[bounds[t] : bounds[t + 1]]) for t in known[i:j]], n, k)
        found = best(score, k)
        out[0].append(np.full(len(found), q))
        out[1].append(order[found])
        out[2].append(score[found])
    q, d, s = (np.concatenate(x) for x in out)
    return qids.dictionary.take(pa.array(q)), ids.take(pa.array(d)), pa.array(s)


def scorer(k: int, schema: pa.Schema):
    """``mapInArrow`` function over rows of a block of documents (see ``packer``) and a block of queries,
    ``asked`` of ``(qid, term)``: ``(qid, doc_id, score)``, the k best of each query in the block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in range(b.num_rows):
                ids, vocabulary, asked = (b.column(c)[r].values for c in ("ids", "vocabulary", "asked"))
                flat = (np.frombuffer(b.column(c)[r].as_buffer(), t) for c, t in (("sizes", np.int32), ("codes", np.int32), ("weights", np.float64)))
                cols = _best_of_block(ids, vocabulary, *flat, asked, k)
                yield pa.RecordBatch.from_arrays([x.cast(f.type) for x, f in zip(cols, schema)], schema=schema)
        release_memory()

    return run
