"""Alignment of two tokenizers' tokens over the bytes of each whole text.

Side A is a ``tokenizers`` byte-level model, side B a ``sentencepiece`` model that puts a space in
front; A is given that space too, so both sides spell the bytes of space + text. Per batch, pandas
``merge_asof``, keyed by unit, finds for each token's start the other side's covering token; the
union of both directions is every overlapping pair, once. Offsets where tokens of both sides end
cut the tokens into groups.

Units: neither side joins across a space behind a character that is no white space (A's split
pattern never does, and B is checked for pieces that would), so a document falls apart there
(closing spaces stay with what they follow) and both sides end a token at each such cut. The units keyed in a batch are its distinct parts that
the worker does not remember; a document is the sequence of its parts. Models of which this does
not hold are given whole documents as units.

The first pass encodes and aligns, and writes each document's numbers and its distinct id pairs
with how often it links them. Pairs are counted over all documents from there (partial sums per
task), and a second pass over the written pairs looks the counts up: sorted arrays of up to
``MAX_PAIRS`` pairs are broadcast, and beyond that several such tables, cut by the A id, one after
the other.

Edge cases: null and empty texts, and texts whose bytes on either side differ from space + text
(a literal word mark, for example), have no tokens: zeros and an empty string, and they count for
no pair. Strings of special tokens are plain text. Repeated rows get equal results and count each.
Parts and texts of any length are aligned whole; a worker remembers two generations of parts, each
begun anew beyond ``CACHE_PARTS`` parts or ``CACHE_CHARS`` characters. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import cut, prepare, table

MAX_PAIRS = 4 << 20
CACHE_PARTS = 250_000
CACHE_CHARS = 8 << 20
GROUP_CHARS = 1 << 20
RUN_PARTS = 256
_COLS = ["n_a", "n_b", "n_groups", "n_links", "bad"]
_LINKS, _BAD = 3, 4
_ROW = ["doc_id", *_COLS[:_BAD], "groups_sha256"]
_CUT = re.compile(r"(?<=\S)(?= +[^ ])")
_ODD = re.compile(r"[^\S ] [^\S ]")  # white space on both sides of a space: no cut there
_MARK = "▁"


def _byte_alphabet() -> dict[str, int]:
    """Byte of each character of the byte-level alphabet: printable Latin-1 characters stand for
    themselves, the other bytes in order for the characters from U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def _plain(text: str) -> bool:
    """Whether every space of a text has a cut in front."""
    return not ("  " in text or text[0] == " " or text[-1] == " " or _ODD.search(text))


class Aligner:
    """Both tokenizers and what a worker remembers of parts: their numbers (``rows``), and their
    groups' ids in decimal (``spelled``), and their packed links (``links``, from ``first`` on). A part
    is spelled without the space it starts with."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        byte_of = _byte_alphabet()
        vocabulary = self.a.get_vocab(with_added_tokens=True)
        self.a_text = [b""] * (max(vocabulary.values(), default=0) + 1)
        for token, i in vocabulary.items():
            self.a_text[i] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()
        self.b_text = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            self.b_text.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace(_MARK, " ").encode())
        self.a_len, self.b_len = (np.array(list(map(len, x)), dtype=np.int64) for x in (self.a_text, self.b_text))
        # What a token adds to a group's string: inside its side, as A's last, as B's last.
        self.marks = [b"%d%s" % (i, m) for m in (b",", b"|", b";") for i in range(max(len(self.a_text), len(self.b_text)))]
        self.mark_len = np.array(list(map(len, self.marks)), dtype=np.int64)
        with open(a_path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec.get("pre_tokenizer") or {}
        joins = any(_MARK in self.b.id_to_piece(i).lstrip(_MARK) for i in range(self.b.get_piece_size()))
        self.by_part = pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space") and not spec.get("normalizer") and not joins
        self._forget()
        self.older = (self.known, self.rows, self.spelled, self.first, self.links)
        self.a_bytes, self.b_bytes = (np.frombuffer(b"".join(x), dtype=np.uint8) for x in (self.a_text, self.b_text))

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.rows, self.spelled = np.zeros((0, len(_COLS)), dtype=np.int64), []
        self.first, self.links = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        self.chars = 0

    def parts(self, text: str) -> list[str]:
        if not self.by_part:
            return [text]
        return text.split(" ") if _plain(text) else [u[1:] for u in _CUT.split(" " + text)]

    def _encoded(self, parts: list[str]) -> tuple[list, list]:
        """Ids of both sides over all parts: those that stay apart side by side are encoded in runs."""
        runs = []
        for at in range(0, len(parts), RUN_PARTS if self.by_part else 1):
            some = parts[at : at + (RUN_PARTS if self.by_part else 1)]
            whole = " ".join(some)
            runs += [whole] if whole and _plain(whole) else some
        return [e.ids for e in self.a.encode_batch_fast([" " + r for r in runs], add_special_tokens=False)], self.b.encode(runs, num_threads=1)

    def align(self, parts: list[str]) -> tuple[np.ndarray, list[bytes], np.ndarray]:
        """Numbers (``_COLS``), groups and links of each part; one that a side spells otherwise is bad."""
        rows = np.zeros((len(parts), len(_COLS)), dtype=np.int64)
        raw = [b" " + p.encode("utf-8", "surrogatepass") for p in parts]
        stops = np.cumsum(list(map(len, raw)))
        a_ids, b_ids = self._encoded(parts)
        a, b = self._side(a_ids, self.a_len, stops), self._side(b_ids, self.b_len, stops)
        whole = np.frombuffer(b"".join(raw), dtype=np.uint8)
        same = []
        for side, length, text in ((a, self.a_len, self.a_bytes), (b, self.b_len, self.b_bytes)):
            ids, end = side["id"].to_numpy(), side["end"].to_numpy()
            spelled = _gathered(text, (np.cumsum(length) - length)[ids], length[ids])
            same.append(np.array_equal(spelled, whole) and np.isin(stops, end).all())
        if not all(same):
            spells = lambda ids, text: b"".join(map(text.__getitem__, ids))
            # A part is spelled otherwise: each is tried alone, and those that are not go on.
            ids = zip(self.a.encode_batch_fast([" " + p for p in parts], add_special_tokens=False), self.b.encode(parts, num_threads=1))
            good = [k for k, (x, y) in enumerate(ids) if spells(x.ids, self.a_text) == raw[k] == spells(y, self.b_text)]
            if len(good) == len(parts):
                raise ValueError("parts join across their cuts")
            rows[:, _BAD] = 1
            spelled, links = [b""] * len(parts), self.links[:0]
            if good:
                rows[good], found, links = self.align([parts[k] for k in good])
                for k, x in zip(good, found):
                    spelled[k] = x
            return rows, spelled, links
        cols = ["unit", "start", "token"]
        forth = pd.merge_asof(a[cols], b[cols], on="start", by="unit", suffixes=("_a", "_b"))
        back = pd.merge_asof(b[cols], a[cols].assign(at=a["start"]), on="start", by="unit", suffixes=("_b", "_a"))
        inside = (back["at"] < back["start"]).to_numpy()  # equal starts are found from A's side
        left = np.concatenate([forth["token_a"].to_numpy(), back["token_a"].to_numpy()[inside]])
        right = np.concatenate([forth["token_b"].to_numpy(), back["token_b"].to_numpy()[inside]])
        order = np.argsort(left, kind="stable")
        left, right = left[order], right[order]
        a_id, b_id, a_unit = a["id"].to_numpy(), b["id"].to_numpy(), a["unit"].to_numpy()
        codes = (a_id[left] << 32) | b_id[right]
        owner = a_unit[left]
        upto = np.searchsorted(owner, np.arange(len(parts) + 1))
        a_end, b_end = a["end"].to_numpy(), b["end"].to_numpy()
        common = np.intersect1d(a_end, b_end, assume_unique=True)
        a_group, b_group = np.searchsorted(common, a_end), np.searchsorted(common, b_end)
        a_cut, b_cut = np.searchsorted(a_end, common, side="right"), np.searchsorted(b_end, common, side="right")
        # A's tokens of a group, then B's: each token's place and its string with what follows it.
        width = len(self.marks) // 3
        marks = np.empty(len(a_id) + len(b_id), dtype=np.int64)
        before = np.concatenate([[0], b_cut])
        marks[np.arange(len(a_id)) + before[a_group]] = a_id + width * (a_end == common[a_group])
        marks[np.arange(len(b_id)) + a_cut[b_group]] = b_id + 2 * width * (b_end == common[b_group])
        text = b"".join(map(self.marks.__getitem__, marks.tolist()))
        per = lambda x: np.bincount(x, minlength=len(parts))
        group_unit = a_unit[a_cut - 1]
        rows[:, :_BAD] = np.stack([per(a_unit), per(b["unit"].to_numpy()), per(group_unit), np.diff(upto)], axis=1)
        stop = np.concatenate([[0], np.cumsum(self.mark_len[marks])])[np.cumsum(rows[:, 0] + rows[:, 1])].tolist()
        return rows, [text[i : j - 1] for i, j in zip([0, *stop], stop)], codes

    @staticmethod
    def _side(ids: list[list[int]], length: np.ndarray, stops: np.ndarray) -> pd.DataFrame:
        """Tokens of all parts, their byte ranges counted on from part to part."""
        flat = np.fromiter(chain.from_iterable(ids), dtype=np.int64, count=sum(map(len, ids)))
        end = np.cumsum(length[flat])
        start = end - length[flat]
        return pd.DataFrame({"unit": np.searchsorted(stops, start, side="right"), "id": flat, "start": start, "end": end, "token": np.arange(len(flat))})

    def _learn(self, parts: list[str], rows: np.ndarray, spelled: list[bytes], links: np.ndarray) -> None:
        self.known.update(zip(parts, range(len(self.spelled), len(self.spelled) + len(parts))))
        many = rows[:, _LINKS]
        self.first = np.concatenate([self.first, len(self.links) + np.cumsum(many) - many])
        self.rows, self.links = np.concatenate([self.rows, rows]), np.concatenate([self.links, links])
        self.spelled += spelled
        self.chars += sum(map(len, parts))

    def documents(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """``(flat, stops)``: the places in ``rows``, ``spelled`` and ``links`` of every text's parts."""
        split = [self.parts(t) if t else [] for t in texts]
        if len(self.known) > CACHE_PARTS or self.chars > CACHE_CHARS:
            self.older = (self.known, self.rows, self.spelled, self.first, self.links)
            self._forget()
        older, rows, spelled, first, links = self.older
        asked = set().union(*split).difference(self.known)
        again = list(older.keys() & asked) if older is not self.known else []
        if again:
            at = list(map(older.__getitem__, again))
            self._learn(again, rows[at], list(map(spelled.__getitem__, at)), _gathered(links, first[at], rows[at, _LINKS]))
        new = sorted(asked.difference(again))
        if new:
            self._learn(new, *self.align(new))
        many = list(map(len, split))
        flat = np.fromiter(map(self.known.__getitem__, chain.from_iterable(split)), dtype=np.int64, count=sum(many))
        return flat, np.concatenate([[0], np.cumsum(many, dtype=np.int64)])


_ALIGNERS: dict[tuple, Aligner] = {}


def aligner_at(a_path: str, b_path: str) -> Aligner:
    """The worker's aligner; what it remembers serves all tasks of the worker."""
    key = (a_path, b_path)
    if key not in _ALIGNERS:
        _ALIGNERS[key] = Aligner(a_path, b_path)
    return _ALIGNERS[key]


def _groups(batch: pa.RecordBatch) -> Iterator[tuple[list, list]]:
    """Runs of rows of about ``GROUP_CHARS`` characters."""
    ids, texts, size = [], [], 0
    for i, t in zip(batch.column(0), batch.column(1)):
        ids.append(i)
        texts.append(t.as_py())
        size += len(texts[-1] or "")
        if size >= GROUP_CHARS:
            yield ids, texts
            ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def _gathered(values: np.ndarray, first: np.ndarray, many: np.ndarray) -> np.ndarray:
    """The runs of ``many`` values from ``first`` on, one after the other."""
    return values[np.repeat(first - np.cumsum(many) + many, many) + np.arange(many.sum())]


def _sums(column: np.ndarray, stops: np.ndarray) -> np.ndarray:
    upto = np.concatenate([[0], np.cumsum(column)])
    return upto[stops[1:]] - upto[stops[:-1]]


def _pairs(a_path: str, b_path: str, id_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = aligner_at(a_path, b_path)
        for batch in batches:
            for ids, texts in _groups(batch):
                flat, stops = aligner.documents(texts)
                rows = aligner.rows[flat]
                good = (_sums(rows[:, _BAD], stops) == 0) & (np.diff(stops) > 0)
                cols = [pa.array(np.where(good, _sums(rows[:, k], stops), 0)) for k in range(_BAD)]
                linked = _gathered(aligner.links, aligner.first[flat], rows[:, _LINKS])
                ends = np.concatenate([[0], np.cumsum(rows[:, _LINKS])])[stops].tolist()
                spelled, flat, stops = aligner.spelled.__getitem__, flat.tolist(), stops.tolist()
                sha, codes, times = [""] * len(ids), [], []
                for k, ok in enumerate(good.tolist()):
                    if ok:
                        sha[k] = hashlib.sha256(b";".join(map(spelled, flat[stops[k] : stops[k + 1]]))).hexdigest()
                    code, n = np.unique(linked[ends[k] : ends[k + 1] if ok else ends[k]], return_counts=True)
                    codes.append(code)
                    times.append(n)
                upto = pa.array(np.concatenate([[0], np.cumsum(list(map(len, codes)))]).astype(np.int32))
                lists = [pa.ListArray.from_arrays(upto, pa.array(np.concatenate(x).astype(t))) for x, t in ((codes, np.int64), (times, np.int32))]
                yield pa.RecordBatch.from_arrays([pa.array([i.as_py() for i in ids], type=id_type), *cols, pa.array(sha), *lists], names=[*_ROW, "codes", "times"])

    return run


def linked_pairs(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_a, n_b, n_groups, n_links, groups_sha256, codes, times)`` of every row: its
    distinct linked pairs, packed as A id << 32 | B id, and how often it links them."""
    prepare(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType
    schema = f"doc_id {kind.simpleString()}, " + ", ".join(f"{c} bigint" for c in _COLS[:_BAD]) + ", groups_sha256 string, codes array<bigint>, times array<int>"
    return rows.mapInArrow(_pairs(a_path, b_path, to_arrow_type(kind)), schema)


def pair_counts(pairs: DataFrame) -> DataFrame:
    """``(code, n, best)`` of every linked id pair: the number of documents that hold it, and
    whether that is the highest of its A id (``code >> 32``), ties included."""
    counts = cut(pairs.select(F.explode("codes").alias("code")).groupBy("code").agg(F.count("*").alias("n")), "pair-counts")
    a = F.shiftright("code", 32)
    top = counts.groupBy(a.alias("a")).agg(F.max("n").alias("top"))
    return counts.join(top, a == F.col("a")).select("code", "n", (F.col("n") == F.col("top")).alias("best"))


def _lookups(spark, counts: DataFrame, max_pairs: int) -> list:
    """Broadcast tables of at most about ``max_pairs`` pairs, cut by the A id."""
    n = counts.count()
    slices = max(1, -(-n // max_pairs))
    out = []
    for k in range(slices):
        part = counts if slices == 1 else counts.where(F.pmod(F.xxhash64(F.shiftright("code", 32)), F.lit(slices)) == k)
        t = part.orderBy("code").toArrow()
        out.append(spark.sparkContext.broadcast((t["code"].to_numpy(), t["n"].to_numpy(), t["best"].to_numpy())))
    return out


def _looked_up(codes: np.ndarray, lookups: list) -> tuple[np.ndarray, np.ndarray]:
    """The count of each code, and whether it is its A id's best."""
    n, best = np.zeros(len(codes), dtype=np.int64), np.zeros(len(codes), dtype=bool)
    for keys, counts, tops in lookups:
        if len(keys):
            at = np.minimum(np.searchsorted(keys, codes), len(keys) - 1)
            hit = keys[at] == codes
            n[hit], best[hit] = counts[at[hit]], tops[at[hit]]
    return n, best


def _scorer(lookups: list):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = [b.value for b in lookups]
        for batch in batches:
            lists, times = batch.column(len(_ROW)), batch.column(len(_ROW) + 1)
            n, best = _looked_up(lists.flatten().to_numpy(), tables)
            times = times.flatten().to_numpy()
            stops = lists.offsets.to_numpy().astype(np.int64)
            stops -= stops[0]
            sums = [pa.array(_sums(x * times, stops)) for x in (best.astype(np.int64), n)]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(_ROW)], *sums], names=[*_ROW, "n_best", "count_sum"])

    return run


def aligned(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text", max_pairs: int = MAX_PAIRS) -> DataFrame:
    """``(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)`` of every row."""
    spark = docs.sparkSession
    prepare(spark)
    pairs = cut(linked_pairs(docs, a_path, b_path, id_col, text_col), "linked-pairs")
    lookups = _lookups(spark, cut(pair_counts(pairs), "pairs"), max_pairs)
    numbers = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pairs.schema[: len(_ROW)])
    out = pairs.mapInArrow(_scorer(lookups), f"{numbers}, n_best bigint, count_sum bigint")
    return out.select("doc_id", *_COLS[:_BAD], "n_best", "count_sum", "groups_sha256")


def q_op11_alignment(spark, sf_dir) -> DataFrame:
    """Token groups and links of every document under a byte-level and a piece model."""
    import public_tokenizers

    a, b = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return aligned(table(spark, sf_dir, "documents"), a, b)
