"""SentencePiece (byte-pair model) encoding and decoding by suffix-array matching.

The model file is read for its pieces, scores and normaliser only; segmentation is done here,
in the tasks, a batch of texts at a time:

1. No piece of such a model has a word mark behind another character (checked when the model is
   loaded), so normalised text falls apart before each run of word marks, and so it does before
   a stop whose predecessor it follows in no piece. The batch's distinct parts that the worker
   does not remember are concatenated.
2. The concatenation is indexed by a suffix array, suffixes compared over the longest piece's
   length, in blocks of ``BLOCK`` positions that overlap by that length.
3. Every piece is binary-searched for its range of occurrences; the ranges are the edges.
4. Edges are sorted by position and relaxed from left to right. A byte-pair segmentation is
   the one in which every two neighbours stay apart when merged alone, and each prefix has
   exactly one last piece of that kind, so the state of a position is its last piece; an edge
   is taken if its start is reached and its piece is compatible with the piece that ends there.

Characters in no piece become byte pieces. Decoding concatenates the pieces' bytes.

Edge cases: a null text is empty; an empty text has no ids and decodes to the empty text; a
literal word mark in a text decodes as a space, as with the model's library; very long texts
and parts are handled in blocks; repeated rows get equal results; an empty table gives an empty
result; other columns pass through.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import prepare, release_memory, table

MARK = "▁"
BLOCK = 1 << 18
CACHE_PARTS = 250_000
BATCH_CHARS = 1 << 20
WIDE = 96
MAX_REMEMBERED = 2_000_000
RECENT_BITS = 20
_SPREAD = np.uint64(0x9E3779B97F4A7C15)
_CUT = "\0"
_PARTS = re.compile(f"{MARK}*[^{MARK}{_CUT}]+|{MARK}+")
_WHOLE = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
_STOPS = ".,;:!?"


def _suffix_order(codes: np.ndarray, n: int) -> np.ndarray:
    """Stable order of the first ``n`` suffixes of ``codes`` by as many characters as are left behind
    the last of them; characters are packed by their rank among those that occur, as many as fit."""
    width = len(codes) - n + 1
    rank = np.cumsum(np.bincount(codes) > 0)
    ranks, bits = rank[codes], int(rank[-1]).bit_length()
    keys = []
    for a in range(0, width, 63 // bits):
        key = np.zeros(n, dtype=np.int64)
        for j in range(a, min(a + 63 // bits, width)):
            key <<= bits
            key |= ranks[j : j + n]
        keys.append(key)
    return np.lexsort(keys[::-1])


class Model:
    """Pieces, scores and special ids of a byte-pair model with byte fallback."""

    def __init__(self, path: str):
        import sentencepiece

        self.processor = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(sp.get_piece_size())
        self.byte_ids = {int(sp.id_to_piece(i)[3:5], 16): i for i in ids if sp.is_byte(i)}
        if len(self.byte_ids) != 256:
            raise ValueError("the model has no byte pieces")
        normal = [i for i in ids if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        self.pieces = [sp.id_to_piece(i) for i in normal]
        if any(MARK in p.lstrip(MARK) for p in self.pieces):
            raise ValueError("a piece spans words")
        self.ids = normal
        self.score = {p: sp.get_score(i) for p, i in zip(self.pieces, normal)}
        bare = sorted(set("".join(self.pieces)) - set(self.pieces))  # mergeable characters without an id
        self.pieces += bare
        self.ids += [-1] * len(bare)
        self.known = frozenset(p for p in self.pieces if len(p) == 1)
        self.longest = max(map(len, self.pieces))
        self.dead = len(self.pieces)
        width = self.longest + 1
        low = np.zeros((self.dead, width), dtype=np.uint32)
        for k, p in enumerate(self.pieces):
            low[k, : len(p)] = np.frombuffer(p.encode("utf-32-le"), dtype=np.uint32) + 1
        high = low.copy()
        self.lengths = np.array([len(p) for p in self.pieces])
        high[np.arange(self.dead), self.lengths] = 0x200000  # above every character
        # Bounds are searched in their own order, each beside the one before, and put back by piece.
        self.bounds = []
        for b in (low.view(f"<U{width}").ravel(), high.view(f"<U{width}").ravel()):
            order = np.argsort(b, kind="stable")
            self.bounds.append((b[order], np.argsort(order)))
        self.id_of = np.array([*self.ids, -1], dtype=np.int64)
        # Pairs of pieces seen so far, packed and sorted, and whether they stay apart.
        self.pairs, self.stays = np.array([-1], dtype=np.int64), np.array([False])
        # Of them, in the place that its digits choose, the pair found last: most are looked up here.
        self.recent, self.recent_stays = np.full(1 << RECENT_BITS, -1, dtype=np.int64), np.zeros(1 << RECENT_BITS, dtype=bool)
        whole = [self.merge(p) == [p] for p in self.pieces]
        self.whole = np.array(whole)  # a piece that its own merges do not make is never used
        # Parts of this and of the previous generation: what is used again moves up, so parts that
        # come often are never encoded twice and memory stays bounded.
        self.cache_parts = CACHE_PARTS
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        before = {q: {x for p in self.pieces for x, y in zip(p, p[1:]) if y == q} for q in _STOPS}
        stop = lambda q, xs: f"{re.escape(q)}(?<=[^{re.escape(''.join(sorted(xs)))}{_CUT}]{re.escape(q)})"
        self.stops = re.compile("|".join(stop(q, xs) for q, xs in before.items()))
        self.text_of = [b""] * sp.get_piece_size()
        for p, i in zip(self.pieces, self.ids):
            if i >= 0:
                self.text_of[i] = p.replace(MARK, " ").encode()
        for b, i in self.byte_ids.items():
            self.text_of[i] = bytes([b])

    def merge(self, text: str) -> list[str]:
        """Plain byte-pair merging: best score first, then leftmost."""
        parts = list(text)
        score = self.score.get
        gain = [score(a + b) for a, b in zip(parts, parts[1:])]
        while True:
            best, at = None, -1
            for k, g in enumerate(gain):
                if g is not None and (best is None or g > best):
                    best, at = g, k
            if best is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del gain[at]
            if at < len(gain):
                gain[at] = score(parts[at] + parts[at + 1])
            if at:
                gain[at - 1] = score(parts[at - 1] + parts[at])

    def edges(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(start, stop, piece)`` of all occurrences in ``codes`` (characters + 1; 0: a cut)."""
        out = []
        width = self.longest + 1
        padded = np.concatenate([codes, np.zeros(width, dtype=np.uint32)])
        for at in range(0, len(codes), BLOCK):
            n = min(BLOCK, len(codes) - at)
            block = padded[at : at + n + width - 1]
            order = _suffix_order(block, n)
            windows = np.lib.stride_tricks.sliding_window_view(block, width)
            ranked = windows[order].view(f"<U{width}").ravel()
            first, last = (np.searchsorted(ranked, b)[place] for b, place in self.bounds)
            count = np.where(self.whole, last - first, 0)
            piece = np.repeat(np.arange(self.dead), count)
            rank = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(first, count)
            start = order[rank] + at
            out.append((start, start + self.lengths[piece], piece))
        start, stop, piece = (np.concatenate(x) for x in zip(*out))
        single = np.zeros(len(codes), dtype=bool)
        single[start[stop - start == 1]] = True
        dead = np.nonzero(~single & (codes > 0))[0]
        start, stop = np.concatenate([start, dead]), np.concatenate([stop, dead + 1])
        piece = np.concatenate([piece, np.full(len(dead), self.dead)])
        order = np.lexsort((start, stop))
        return start[order], stop[order], piece[order]

    def _compatible(self, pairs: np.ndarray) -> np.ndarray:
        """Whether each packed pair of pieces stays apart when merged alone."""
        place = (pairs.view(np.uint64) * _SPREAD >> np.uint64(64 - RECENT_BITS)).view(np.int64)
        out, rest = self.recent_stays[place], np.flatnonzero(self.recent[place] != pairs)
        if len(rest):
            out[rest] = found = self._stays(pairs[rest])
            self.recent[place[rest]] = pairs[rest]
            # Of pairs that share a place one is kept, with its own answer.
            won = self.recent[place[rest]] == pairs[rest]
            self.recent_stays[place[rest[won]]] = found[won]
        return out

    def _stays(self, pairs: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.pairs, pairs)
        at[at == len(self.pairs)] = 0
        known = self.pairs[at] == pairs
        if not known.all():
            size, pieces, new = self.dead + 1, self.pieces, np.unique(pairs[~known])
            stays = [self.merge(pieces[x // size] + pieces[x % size]) == [pieces[x // size], pieces[x % size]] for x in new.tolist()]
            if len(self.pairs) > MAX_REMEMBERED:
                self.pairs, self.stays = self.pairs[:1], self.stays[:1]
            at = np.searchsorted(self.pairs, new)
            self.pairs, self.stays = np.insert(self.pairs, at, new), np.insert(self.stays, at, stays)
            return self._stays(pairs)
        return self.stays[at]

    def _relaxed(self, codes: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Last piece of each position and where it starts, over all parts side by side.

        Edges are taken by their end's place in its part, so all that an edge needs of its part is
        known; places beyond ``WIDE`` are left to the parts that are so long, one edge at a time.
        """
        start, stop, piece = self.edges(codes)
        n = len(codes)
        token, back = np.full(n + 1, -1, dtype=np.int64), np.zeros(n + 1, dtype=np.int64)
        first = np.zeros(n + 1, dtype=bool)
        first[begins] = True
        place = stop - begins[np.searchsorted(begins, start, side="right") - 1]
        order = np.argsort(place, kind="stable")
        start, stop, piece, place = start[order], stop[order], piece[order], place[order]
        bounds = np.searchsorted(place, np.arange(1, WIDE + 2))
        size, dead = self.dead + 1, self.dead
        for i, j in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            s, e, p = start[i:j], stop[i:j], piece[i:j]
            q = token[s]
            ok = first[s] | (q >= 0)
            ask = ok & ~first[s] & (q != dead) & (p != dead)
            if ask.any():
                ok[ask] = self._compatible(q[ask] * size + p[ask])
            token[e[ok]], back[e[ok]] = p[ok], s[ok]
        for s, e, p in zip(*(x[bounds[-1] :].tolist() for x in (start, stop, piece))):
            q = int(token[s])
            if token[e] < 0 and (first[s] or (q >= 0 and (dead in (p, q) or self._compatible(np.array([q * size + p]))[0]))):
                token[e], back[e] = p, s
        return token, back

    def _segment(self, parts: list[str]) -> list[bytes]:
        """Packed ids of each distinct part."""
        text = "\0".join(parts)
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32) + np.uint32(1)
        ends = np.cumsum([len(p) + 1 for p in parts]) - 1
        begins = np.concatenate([[0], ends[:-1] + 1])
        codes[ends[:-1]] = 0
        # A cut is no character, so positions of different parts never meet.
        token, back = self._relaxed(codes, begins, ends)
        used, at, begin = np.zeros(len(token), dtype=bool), ends, begins
        while len(at):
            if (token[at] < 0).any():
                raise ValueError("a part has no segmentation")
            used[at] = True
            at = back[at]
            at, begin = at[at > begin], begin[at > begin]
        stop = np.nonzero(used)[0]
        ids = self.id_of[token[stop]]
        many = np.ones(len(stop), dtype=np.int64)
        # Characters without an id of their own become byte pieces.
        spelled = {k: [self.byte_ids[b] for b in text[back[stop[k]] : stop[k]].encode("utf-8", "surrogatepass")] for k in np.nonzero(ids < 0)[0].tolist()}
        if spelled:
            many[list(spelled)] = list(map(len, spelled.values()))
            ids = np.repeat(ids, many)
            at = np.cumsum(many) - many
            for k, x in spelled.items():
                ids[at[k] : at[k] + len(x)] = x
        upto = np.concatenate([[0], np.cumsum(many)])[np.searchsorted(stop, ends, side="right")]
        flat, upto = ids.astype(np.int32).tobytes(), (4 * upto).tolist()
        return [flat[i:j] for i, j in zip([0, *upto], upto)]

    def _parts(self, text: str) -> list[str]:
        if _CUT in text:
            return _WHOLE.findall(text)
        text = self.stops.sub(_CUT + r"\g<0>", text)
        if MARK + MARK in text:
            return _PARTS.findall(text)
        parts = text.replace(MARK, _CUT + MARK).split(_CUT)  # the same, where no two marks meet
        return parts if parts[0] else parts[1:]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as packed 32-bit integers."""
        if len(self.cache) > self.cache_parts:
            self.cache, self.older = {}, self.cache
        cache = self.cache
        found, gaps, asked = [], [], set()
        for t in texts:
            parts = self._parts(self.processor.normalize(t)) if t else []
            ids = list(map(cache.get, parts))
            at = [k for k, x in enumerate(ids) if x is None]
            lacking = [parts[k] for k in at]
            asked.update(lacking)
            found.append(ids)
            gaps.append((at, lacking))
        known = self.older.keys() & asked
        cache.update((p, self.older[p]) for p in known)
        new = sorted(asked - known)
        if new:
            cache.update(zip(new, self._segment(new)))
        out = []
        for ids, (at, lacking) in zip(found, gaps):
            for k, p in zip(at, lacking):
                ids[k] = cache[p]
            out.append(b"".join(ids))
        return out

    def decode(self, ids) -> str:
        """The text of ids that ``encode`` gave; the leading word mark is dropped."""
        data = b"".join(map(self.text_of.__getitem__, ids))
        return data.decode("utf-8", "replace").removeprefix(" ")


_MODELS: dict[str, Model] = {}


def model_at(path: str) -> Model:
    if path not in _MODELS:
        _MODELS[path] = Model(path)
    return _MODELS[path]


def _groups(texts: pa.Array):
    """Runs of texts of about ``BATCH_CHARS`` characters."""
    some, size = [], 0
    for t in texts:
        some.append(t.as_py() or "")
        size += len(some[-1])
        if size >= BATCH_CHARS:
            yield some
            some, size = [], 0
    if some:
        yield some


def _encoder(path: str, cache_parts: int = CACHE_PARTS):
    def run(texts: pa.Array) -> pa.Array:
        model = model_at(path)
        model.cache_parts = cache_parts
        ids = [x for group in _groups(texts) for x in model.encode(group)]
        release_memory()
        stops = np.concatenate([[0], np.cumsum([len(x) // 4 for x in ids], dtype=np.int64)])
        values = pa.array(np.frombuffer(b"".join(ids), dtype=np.int32))
        return pa.ListArray.from_arrays(pa.array(stops.astype(np.int32)), values)

    return run


def _decoder(path: str):
    def run(ids: pa.Array) -> pa.Array:
        model = model_at(path)
        # Row by row: the ids of a whole batch would be millions of Python integers.
        return pa.array((model.decode(x.values.to_numpy().tolist()) if x.is_valid else None for x in ids), type=pa.string())

    return run


def encode(docs: DataFrame, model: str, text_col: str = "text", out: str = "ids", cache_parts: int = CACHE_PARTS) -> DataFrame:
    """``docs`` with ``out``: the ids of every whole text. A worker remembers two generations of
    ``cache_parts`` parts: fewer take less memory and more time, with the same result."""
    prepare(docs.sparkSession)
    return docs.withColumn(out, F.arrow_udf(_encoder(model, cache_parts), T.ArrayType(T.IntegerType()))(F.col(text_col)))


def decode(rows: DataFrame, model: str, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """``rows`` with ``out``: the text of the ids (null for null)."""
    prepare(rows.sparkSession)
    return rows.withColumn(out, F.arrow_udf(_decoder(model), "string")(F.col(ids_col)))


def encoded_documents(docs: DataFrame, model: str, cache_parts: int = CACHE_PARTS) -> DataFrame:
    """``(doc_id, n_tokens, ids, decoded_sha256, round_trip)`` of every document."""
    both = decode(encode(docs.select("doc_id", "text"), model, cache_parts=cache_parts), model)
    same = F.col("decoded") == F.translate(F.coalesce("text", F.lit("")), MARK, " ")
    return both.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256"), same.alias("round_trip"))


def q_op5_pieces(spark, sf_dir) -> DataFrame:
    """Ids of every document, and the digest of the text they decode to."""
    import public_tokenizers

    return encoded_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
