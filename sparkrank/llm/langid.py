"""Language identification by prediction by partial matching over bytes.

Each language has a byte context tree of variable order up to ``ORDER`` (3): the counts of every
symbol after each context of three, two, one and no bytes. The length of a text under a language
is the sum, over all its bytes, of ``-log2 p``: a symbol unknown in the longest known context
costs an escape (method C: the context's distinct symbols against its total) and is looked up in
the next shorter context with the longer context's symbols excluded, down to a uniform choice
among the bytes never seen. Statistics are frozen, so the cost of a symbol depends on its three
preceding bytes alone; a task works out the costs of the distinct four-byte strings of a batch
for all languages at once and adds them up per text. The language with the shortest code wins.

All training rows are counted, in the tasks and then by an aggregation of ``(lang, four bytes,
count)``, and every counted string is used. All contexts of a string end in the same byte, so the
counts fall into parts by language and that byte, each with whole contexts. Up to
``MAX_STRINGS`` strings are broadcast and texts are scored in one pass; more take one pass for
each part of about that size, and the code lengths of a text are added up over the passes, which
gives the same lengths however many passes there are.

Edge cases: a text that is null or has no letter, and any text if nothing was learned, is
``und`` with score 0; ties go to the language first in order; a null id counts as held out;
rows without a language or text are not learned from; repeated rows get equal results; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, fold, prepare, table

ORDER = 3
MAX_STRINGS = 1 << 21
UNKNOWN = "und"
_START = b"\n" * ORDER
_CHUNK = 1 << 22


def strings(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Four-byte strings ending at each byte of the texts, and where each text's begin."""
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    if not lengths.sum():
        return np.zeros(0, dtype=np.uint32), np.zeros(len(texts), dtype=np.int64)
    b = np.frombuffer(b"".join(x for t in texts for x in (_START, t)), dtype=np.uint8).astype(np.uint32)
    code = b[ORDER:].copy()
    for k in range(1, ORDER + 1):
        code |= b[ORDER - k : len(b) - k] << np.uint32(8 * k)
    starts = np.cumsum(lengths) - lengths
    # Drop the strings that end inside the next text's starting context.
    keep = np.ones(len(code), dtype=bool)
    inner = np.cumsum(lengths + ORDER)[:-1] - ORDER
    for k in range(ORDER):
        keep[inner + k] = False
    return code[keep], starts


def _merge(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    code = np.concatenate([c for c, _ in parts])
    n = np.concatenate([n for _, n in parts])
    order = np.argsort(code, kind="stable")
    code, n = code[order], n[order]
    first = np.nonzero(np.concatenate([[True], code[1:] != code[:-1]]))[0]
    return code[first], np.add.reduceat(n, first)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(lang, code, n)`` of one task; memory follows the distinct strings, not the texts."""
    held: dict[str, list] = {}
    waiting: dict[str, list[bytes]] = {}
    size: dict[str, int] = {}

    def settle(lang: str) -> None:
        code, n = np.unique(strings(waiting.pop(lang))[0], return_counts=True)
        size[lang] = 0
        parts = held.setdefault(lang, [])
        parts.append((code, n))
        if len(parts) > 8:
            held[lang] = [_merge(parts)]

    for b in batches:
        for lang, text in zip(b.column(0).to_pylist(), b.column(1)):
            t = text.as_py()
            for at in range(0, len(t), _CHUNK):
                # A very long text goes in chunks, each with the context it continues.
                part = t[at : at + _CHUNK] if not at else t[at - ORDER : at + _CHUNK]
                if at:
                    code = strings([part])[0][ORDER:]
                    held.setdefault(lang, []).append(np.unique(code, return_counts=True))
                    continue
                waiting.setdefault(lang, []).append(part)
                size[lang] = size.get(lang, 0) + len(part)
            if size.get(lang, 0) >= _CHUNK:
                settle(lang)
    for lang in list(waiting):
        settle(lang)
    for lang, parts in held.items():
        code, n = _merge(parts)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(code)), pa.array(code.astype(np.int64)), pa.array(n.astype(np.int64))], names=["lang", "code", "n"])


class Tree:
    """Frozen statistics of one language; ``costs`` gives the bits of four-byte strings."""

    def __init__(self, code: np.ndarray, n: np.ndarray):
        self.code, self.n, self.ctx, self.total, self.kinds, self.excluded = [], [], [], [], [], []
        for k in range(ORDER + 1):  # strings of k + 1 bytes: contexts of order k
            c = code[k].astype(np.int64)
            order = np.argsort(c)
            c, m = c[order], n[k][order].astype(np.float64)
            self.code.append(c)
            self.n.append(m)
            ctx, first = np.unique(c >> 8, return_index=True)
            self.ctx.append(ctx)
            self.total.append(np.add.reduceat(m, first) if len(first) else m)
            self.kinds.append(np.diff(np.append(first, len(c))).astype(np.float64))
            if k and len(first):
                shorter = self._look(self.code[k - 1], self.n[k - 1], c & ((1 << 8 * k) - 1))
                self.excluded.append(np.add.reduceat(shorter, first))
            else:
                self.excluded.append(np.zeros(len(first)))

    @staticmethod
    def _look(keys: np.ndarray, values: np.ndarray, asked: np.ndarray) -> np.ndarray:
        """Values of the asked keys, 0 where absent."""
        if not len(keys):
            return np.zeros(len(asked))
        at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
        return np.where(keys[at] == asked, values[at], 0.0)

    def costs(self, asked: np.ndarray) -> np.ndarray:
        bits = np.zeros(len(asked))
        todo = np.arange(len(asked))
        # What the next longer context has: excluded counts and distinct symbols.
        gone, gone_kinds = np.zeros(len(asked)), np.zeros(len(asked))
        for k in range(ORDER, -1, -1):
            s = asked[todo] & ((1 << 8 * (k + 1)) - 1)
            total = self._look(self.ctx[k], self.total[k], s >> 8)
            kinds = self._look(self.ctx[k], self.kinds[k], s >> 8)
            free, free_kinds = total - gone, kinds - gone_kinds
            seen = self._look(self.code[k], self.n[k], s)
            open_ = free_kinds > 0
            hit = seen > 0
            whole = np.log2(np.where(open_, free + free_kinds, 1.0))
            bits[todo] += np.where(hit, whole - np.log2(np.where(hit, seen, 1.0)), whole - np.log2(np.where(open_, free_kinds, 1.0)))
            gone = self._look(self.ctx[k], self.excluded[k], s >> 8)[~hit]
            gone_kinds = kinds[~hit]
            todo = todo[~hit]
        bits[todo] += np.log2(256 - gone_kinds)
        return bits


def count_strings(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """``(lang, k, code, n)``: strings of ``k + 1`` bytes of all rows that have a language and a text."""
    prepare(docs.sparkSession)
    rows = docs.select(F.col(lang_col).alias("lang"), F.col(text_col).cast("binary").alias("text")).where("lang is not null and text is not null")
    counted = cut(rows.mapInArrow(_count, "lang string, code bigint, n bigint").groupBy("lang", "code").agg(F.sum("n").alias("n")), "byte-strings")
    every = None
    for k in range(ORDER + 1):
        own = counted.groupBy("lang", F.lit(k).alias("k"), F.col("code").bitwiseAND((1 << 8 * (k + 1)) - 1).alias("code")).agg(F.sum("n").alias("n"))
        every = own if every is None else every.unionByName(own)
    return cut(every, "byte-contexts")


def _trees(every: DataFrame) -> dict[str, Tree]:
    got = every.select("lang", "k", "code", "n").toArrow()
    if not got.num_rows:
        return {}
    coded = got["lang"].combine_chunks().dictionary_encode()
    at, langs = coded.indices.to_numpy(), coded.dictionary.to_pylist()
    order = np.lexsort((got["k"].to_numpy(), at))
    key, code, n = (at.astype(np.int64) * (ORDER + 1) + got["k"].to_numpy())[order], got["code"].to_numpy()[order], got["n"].to_numpy()[order]
    ends = np.searchsorted(key, np.arange(len(langs) * (ORDER + 1) + 1))
    of = lambda i, k: slice(ends[i * (ORDER + 1) + k], ends[i * (ORDER + 1) + k + 1])
    return {x: Tree(*zip(*((code[of(i, k)], n[of(i, k)]) for k in range(ORDER + 1)))) for i, x in enumerate(langs)}


def train(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", max_strings: int | None = None) -> dict[str, Tree]:
    """A tree per language from all rows that have a language and a text.

    With ``max_strings``, for callers that want small trees, a tree keeps the strings seen at least
    ``2 ** t`` times, the least ``t`` at which no order has more than its share of so many.
    """
    every = count_strings(docs, lang_col, text_col)
    if max_strings is None:
        return _trees(every)
    sizes = every.groupBy("lang", "k", F.floor(F.log2("n")).alias("t")).count().collect()  # at most 4 * 63 rows a language
    langs = sorted({r["lang"] for r in sizes})
    least = {}
    for lang in langs:
        for t in range(64):
            held = [sum(r["count"] for r in sizes if r["lang"] == lang and r["k"] == k and r["t"] >= t) for k in range(ORDER + 1)]
            if max(held) <= max_strings // len(langs):
                break
        least[lang] = 1 << t
    if not langs:
        return {}
    enough = F.coalesce(*(F.when(F.col("lang") == x, F.lit(n)) for x, n in least.items()))
    return _trees(every.where(F.col("n") >= enough))


#: Byte that ends all contexts of a string, none for those of no context.
_LAST = "if(k = 0, null, shiftright(code, 8) & 255)"


def parts_of(every: DataFrame, max_strings: int) -> list[list[tuple[str, int, int]]]:
    """Parts of about ``max_strings`` strings: ``(lang, first, last)`` ranges of the last context byte.

    At most 257 rows a language reach the driver. Each byte of each language is in one part.
    """
    sizes = {(r["lang"], r["last"]): r["count"] for r in every.groupBy("lang", F.expr(_LAST).alias("last")).count().collect()}
    out, held = [[]], 0
    for lang in sorted({x for x, _ in sizes}):
        own, opened = sizes.get((lang, None), 0), False
        for last in range(256):
            more = sizes.get((lang, last), 0)
            if out[-1] and held + more + (0 if opened else own) > max_strings:
                out.append([])
                held, opened = 0, False
            if opened:
                out[-1][-1] = (lang, out[-1][-1][1], last)
            else:
                out[-1].append((lang, last, last))
                held, opened = held + own, True
            held += more
    return out if out[0] else []


def code_lengths(texts: list[bytes], trees: list[Tree], ranges: list[tuple[int, int]] | None = None) -> np.ndarray:
    """Bits of each text under each tree, of the strings whose last context byte is in its range."""
    code, starts = strings(texts)
    out = np.zeros((len(texts), len(trees)))
    if not len(code):
        return out
    distinct, at = np.unique(code, return_inverse=True)
    filled = np.array([len(t) > 0 for t in texts])
    asked = distinct.astype(np.int64)
    last = asked >> 8 & 255
    for j, tree in enumerate(trees):
        costs, own = np.zeros(len(asked)), slice(None) if ranges is None else (last >= ranges[j][0]) & (last <= ranges[j][1])
        costs[own] = tree.costs(asked[own])
        out[filled, j] = np.add.reduceat(costs[at], starts[filled])
    return out


def _groups(texts: list[bytes]) -> Iterator[list[bytes]]:
    out, size = [], 0
    for t in texts:
        out.append(t)
        size += len(t)
        if size >= _CHUNK // 2:
            yield out
            out, size = [], 0
    if out:
        yield out


_KIND = pa.struct([("lang_pred", pa.string()), ("score", pa.float64())])


def _best(bits: np.ndarray, langs: list[str]) -> list[dict]:
    """The shortest code of each row, and its share if all languages are equally likely."""
    best = bits.argmin(axis=1)
    gap = np.minimum(bits - bits.min(axis=1, keepdims=True), 1000)
    score = 1.0 / np.power(2.0, -gap).sum(axis=1)
    return [{"lang_pred": langs[b], "score": float(s)} for b, s in zip(best, score)]


def _predictor(shared):

    def run(texts: pa.Array) -> pa.Array:
        trees = shared.value
        langs = sorted(trees)
        out = []
        for group in _groups([t or b"" for t in texts.to_pylist()]):
            bits = code_lengths(group, [trees[x] for x in langs])
            out += _best(bits, langs)
        return pa.array(out, type=_KIND)

    return F.arrow_udf(run, "lang_pred string, score double")


def predict(docs: DataFrame, trees: dict[str, Tree], text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, the winner's share if all are equally likely."""
    spark = docs.sparkSession
    prepare(spark)
    readable = F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False))
    if not trees:
        return docs.withColumns({"lang_pred": F.lit(UNKNOWN), "score": F.lit(0.0)})
    shared = spark.sparkContext.broadcast(trees)
    # Texts without a letter are not sent to the models.
    found = _predictor(shared)(F.when(readable, F.col(text_col)).cast("binary"))
    rows = docs.withColumns({"_found": found, "_readable": readable})
    return rows.withColumns(
        {"lang_pred": F.when(F.col("_readable"), F.col("_found.lang_pred")).otherwise(UNKNOWN), "score": F.when(F.col("_readable"), F.col("_found.score")).otherwise(0.0)}
    ).drop("_found", "_readable")


def _partial(shared):
    """Bits of the strings of one part, a value for each of its ranges."""

    def run(texts: pa.Array) -> pa.Array:
        trees, ranges = shared.value
        out = []
        for group in _groups([t or b"" for t in texts.to_pylist()]):
            out += code_lengths(group, trees, ranges).tolist()
        return pa.array(out, type=pa.list_(pa.float64()))

    return F.arrow_udf(run, "array<double>")


def _total(langs: list[str], spans: list[tuple[int, int]]):
    """Prediction from the bits of all parts; part ``i`` has the languages ``spans[i]``."""

    def run(parts: pa.Array) -> pa.Array:
        bits = np.zeros((len(parts), len(langs)))
        for i, found in enumerate(parts.to_pylist()):
            for p in sorted(found, key=lambda p: p["part"]):
                a, b = spans[p["part"]]
                bits[i, a:b] += p["bits"]
        return pa.array(_best(bits, langs) if len(parts) else [], type=_KIND)

    return F.arrow_udf(run, "lang_pred string, score double")


def identify(docs: DataFrame, every: DataFrame, text_col: str = "text", max_strings: int = MAX_STRINGS) -> DataFrame:
    """``predict`` with all strings of ``count_strings``, in as many passes as their size asks for."""
    parts = parts_of(every, max_strings)
    if len(parts) <= 1:
        return predict(docs, _trees(every), text_col)
    spark = docs.sparkSession
    langs = sorted({lang for part in parts for lang, _, _ in part})
    base = cut(docs.withColumn("_row", F.monotonically_increasing_id()), "langid-texts")
    readable = F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False))
    asked, every, passes = base.where(readable), every.withColumn("last", F.expr(_LAST)), None
    for i, part in enumerate(parts):
        (first, low, _), (final, _, high) = part[0], part[-1]
        lang, last = F.col("lang"), F.col("last")
        above = (lang > first) | ((lang == first) & (last.isNull() | (last >= low)))
        below = (lang < final) | ((lang == final) & (last.isNull() | (last <= high)))
        trees = _trees(every.where(above & below))
        shared = spark.sparkContext.broadcast(([trees[x] for x, _, _ in part], [(a, b) for _, a, b in part]))
        done = cut(asked.select("_row", F.lit(i).alias("part"), _partial(shared)(F.col(text_col).cast("binary")).alias("bits")), "langid-bits")
        shared.destroy()  # its bits are written
        passes = done if passes is None else passes.unionByName(done)
    spans = [(langs.index(p[0][0]), langs.index(p[-1][0]) + 1) for p in parts]
    found = passes.groupBy("_row").agg(F.collect_list(F.struct("part", "bits")).alias("parts"))
    found = found.select("_row", _total(langs, spans)("parts").alias("_found"))
    rows = base.join(found, "_row", "left")
    return rows.select(
        *(F.col(f"`{c}`") for c in docs.columns), F.coalesce("_found.lang_pred", F.lit(UNKNOWN)).alias("lang_pred"), F.coalesce("_found.score", F.lit(0.0)).alias("score")
    )


def q_op10_langid(spark, sf_dir) -> DataFrame:
    """Language of every document, learned from the documents outside the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    every = count_strings(docs.where(fold("doc_id", 5) != 0))
    held = docs.select("doc_id", "text", (fold("doc_id", 5) == 0).alias("held_out"))
    return identify(held, every).select("doc_id", "held_out", "lang_pred", "score")
