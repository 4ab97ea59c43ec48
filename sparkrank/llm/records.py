"""Token ids in length-delimited binary records, with a separate offset index.

File format (``part-NNNNN.rec``, little-endian), one record per document in ascending id order:

    uint32 length of the payload    uint32 masked crc32 of those 4 bytes
    payload: the ids, ``width`` bytes each (2 where the vocabulary allows it, else 4)
    uint32 masked crc32 of the payload

A checksum is masked by a rotation and an added constant, as a checksum stored next to data
that itself holds checksums should be. The index (``index/``, Parquet) has one row per record:
``doc_id, part, offset, length, width, n_tokens, start``; ``start`` is the number of ids before
the document. A reader takes any set of index rows in any order, groups them by file and reads
the ranges, so shuffled epochs need no sequential scan; every length and checksum is verified.

Documents are range-partitioned by id (ties by text hash), sorted inside each partition, and
encoded and written by the task that holds them: nothing passes the driver but the ids' range
bounds. A task writes under a name of its own attempt and then moves the file into place, so a
retried or duplicated task leaves one whole file with the same bytes.

Encoding: where the tokenizer's file says that it lower-cases and splits words as ``PIECEWISE``
does, no token joins across white space, so a text's ids are those of its white-space-separated
pieces; each distinct piece is encoded once and remembered, up to ``CACHE_PIECES`` pieces per
generation and worker. New pieces that are plain words are given to the library many at once, set
apart by spaces, and told apart by the ids that end a word. Every other tokenizer is given whole texts. Ids take as many bytes as the
file's largest id needs.

Edge cases: a null or empty text is a record of the end id alone; null ids come first; repeated
rows are records of their own; an empty table gives an empty index and no record; a damaged or
truncated record raises; other columns are ignored.
"""

from __future__ import annotations

import json
import re
import struct
import sys
import zlib
from array import array
from collections.abc import Callable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import id_frame, prepare, table

CACHE_PIECES = 250_000
# The normaliser and pre-tokenizer under which pieces give the ids of whole texts.
PIECEWISE = {
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
}
# What such a tokenizer's model says of itself where a word's last token, and no other, ends in the suffix.
SUFFIXED = {"type": "BPE", "dropout": None, "unk_token": None, "fuse_unk": False, "byte_fallback": False, "ignore_merges": False}
WORDS_AT_ONCE = 256
READ_BYTES = 8 << 20
_BATCH_BYTES = 2 << 20
_MASK = 0xA282EAD8
_MARKS = re.compile("[̀-ͯ]")
# One word whatever the normaliser does: Latin letters that are composed and have one lower case.
_WORD = re.compile("[a-zÀ-ÖØ-öø-ÿ]+")
# Punctuation behind a letter, up to white space; the class comes first, for the scan to skip by it.
_TAIL = re.compile(rb"[.,;:!?](?<=[a-z].)[.,;:!?]*(?=[\x20\t-\r]|\Z)")


def masked(data: bytes) -> int:
    """Masked crc32: rotated right by 15 bits, plus a constant."""
    c = zlib.crc32(data)
    return ((c >> 15 | c << 17) + _MASK) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    size = struct.pack("<I", len(payload))
    return b"".join((size, struct.pack("<I", masked(size)), payload, struct.pack("<I", masked(payload))))


def unframe(record: bytes) -> bytes:
    """The verified payload of one record."""
    if len(record) < 12 or struct.unpack("<I", record[4:8])[0] != masked(record[:4]):
        raise ValueError("record length is damaged")
    payload = record[8:-4]
    if struct.unpack("<I", record[:4])[0] != len(payload) or struct.unpack("<I", record[-4:])[0] != masked(payload):
        raise ValueError("record is damaged")
    return payload


def _file_system(uri: str):
    from pyarrow.fs import FileSystem

    return FileSystem.from_uri(re.sub("^file:/+", "file:///", uri) if uri.startswith("file:") else uri)


def piecewise(spec: dict) -> bool:
    """Whether the tokenizer of this file's content gives a text the ids of its pieces."""
    marked = all("<|" in t["content"] for t in spec["added_tokens"])  # texts with this mark are given whole
    return marked and all(spec.get(k) == v for k, v in PIECEWISE.items())


def _spec(path: str) -> dict:
    with open(path, encoding="utf-8") as f:
        return json.load(f)


def _word_tokenizer(path: str, tokenizer):
    """``(tokenizer, ends)`` for words set apart by spaces: the model of ``tokenizer`` behind those of
    its steps that do something to such a word; ``ends`` marks ids that end one. None for other models."""
    from tokenizers import Tokenizer, normalizers, pre_tokenizers

    model = _spec(path)["model"]
    suffix = model.get("end_of_word_suffix")
    if not suffix or model.get("continuing_subword_prefix") or any(model.get(k, v) != v for k, v in SUFFIXED.items()):
        return None
    words = Tokenizer(tokenizer.model)
    words.normalizer = normalizers.Lowercase()
    words.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    vocab = words.get_vocab()
    ends = np.zeros(max(vocab.values()) + 1, dtype=bool)
    ends[[i for t, i in vocab.items() if t.endswith(suffix)]] = True
    return words, ends


def largest_id(path: str) -> int:
    from tokenizers import Tokenizer

    return max(Tokenizer.from_file(path).get_vocab(with_added_tokens=True).values(), default=0)


class PieceEncoder:
    """Ids of whole texts as packed bytes, by way of their distinct pieces where that is the same."""

    def __init__(self, path: str, width: int, by_piece: bool):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = False
        self.kind, self.by_piece = {2: "H", 4: "I"}[width], by_piece and piecewise(_spec(path))
        self.words = _word_tokenizer(path, self.tokenizer) if self.by_piece else None
        # Pieces of this and of the previous generation: what is used again moves up.
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def _encode(self, texts: list[str]) -> list[bytes]:
        packed = (array(self.kind, e.ids) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False))
        if sys.byteorder == "little":
            return [a.tobytes() for a in packed]
        return [struct.pack(f"<{len(a)}{self.kind}", *a) for a in packed]

    def _encode_words(self, words: list[str]) -> list[bytes]:
        """As ``_encode``, of plain words, many at once: the library's time is mostly spent a text."""
        tokenizer, ends = self.words
        joined = [" ".join(words[k : k + WORDS_AT_ONCE]) for k in range(0, len(words), WORDS_AT_ONCE)]
        flat = b"".join(array(self.kind, e.ids).tobytes() for e in tokenizer.encode_batch_fast(joined, add_special_tokens=False))
        ids = np.frombuffer(flat, dtype=self.kind)
        stops = ((np.flatnonzero(ends[ids]) + 1) * ids.itemsize).tolist()
        if len(stops) != len(words):  # a letter that the model does not know
            return self._encode(words)
        if sys.byteorder != "little":
            flat = ids.byteswap().tobytes()
        return [flat[i:j] for i, j in zip([0, *stops], stops)]

    def _encode_pieces(self, pieces: list[bytes]) -> Iterator[tuple[bytes, bytes]]:
        """Each piece with its ids."""
        plain, rest = [], []
        for p in pieces:
            t = p.decode()
            (plain if self.words and _WORD.fullmatch(t) else rest).append((p, t))
        for some, encode in ((plain, self._encode_words), (rest, self._encode)):
            if some:
                names, texts = zip(*some)
                yield from zip(names, encode(list(texts)))

    def __call__(self, texts: list[bytes]) -> list[bytes]:
        if not self.by_piece:
            return self._encode([t.decode() for t in texts])
        if len(self.known) > CACHE_PIECES:
            self.known, self.older = {}, self.known
        known, older = self.known, self.older
        found, gaps, asked = [], [], set()
        for t in texts:
            pieces = _pieces(t)
            ids = list(map(known.get, pieces))
            at = [k for k, x in enumerate(ids) if x is None]
            lacking = [pieces[k] for k in at]
            asked.update(lacking)
            found.append(ids)
            gaps.append((at, lacking))
        again = older.keys() & asked
        known.update((p, older[p]) for p in again)
        known.update(self._encode_pieces(list(asked - again)))
        out = []
        for ids, (at, lacking) in zip(found, gaps):
            for k, p in zip(at, lacking):
                ids[k] = known[p]
            out.append(b"".join(ids))
        return out


_ENCODERS: dict[tuple, PieceEncoder] = {}


def encoder_at(path: str, width: int, by_piece: bool) -> PieceEncoder:
    """The worker's encoder; what it remembers serves all tasks of the worker."""
    key = (path, width, by_piece)
    if key not in _ENCODERS:
        _ENCODERS[key] = PieceEncoder(path, width, by_piece)
    return _ENCODERS[key]


def _pieces(text: bytes) -> list[bytes]:
    # Special tokens can span pieces' punctuation: such texts are left to the library whole.
    if b"<|" in text:
        return [text]
    # The normaliser lower-cases after composing marks: lower first where nothing composes.
    if not (b"\xcc" in text or b"\xcd" in text) or not _MARKS.search(text.decode()):
        text = _TAIL.sub(rb" \g<0>", text.lower())
    return text.split()


def _batches(rows: Iterator[tuple], size: Callable[[tuple], int], limit: int) -> Iterator[list[tuple]]:
    out, n = [], 0
    for r in rows:
        out.append(r)
        n += size(r)
        if n >= limit:
            yield out
            out, n = [], 0
    if out:
        yield out


def _writer(root: str, tokenizer: str, end_id: int, width: int, by_piece: bool, id_type: pa.DataType):
    names = ["doc_id", "part", "offset", "length", "width", "n_tokens", "before"]
    kinds = [id_type, pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((i, t.as_py()) for b in batches for i, t in zip(b.column(0).to_pylist(), b.column(1)))
        first = list(islice(rows, 1))
        if not first:
            return
        fs, base = _file_system(root)
        encode, end = encoder_at(tokenizer, width, by_piece), end_id.to_bytes(width, "little")
        task = TaskContext.get()
        part, offset, before = task.partitionId(), 0, 0
        own = f"{base}/.part-{part:05d}.{task.taskAttemptId()}"
        fs.create_dir(base, recursive=True)
        with fs.open_output_stream(own) as out:
            for some in _batches((r for x in (first, rows) for r in x), lambda r: len(r[1]) + 64, _BATCH_BYTES):
                index = []
                for (doc_id, _), ids in zip(some, encode([t for _, t in some])):
                    record = frame(ids + end)
                    n = len(ids) // width + 1
                    index.append((doc_id, part, offset, len(record), width, n, before))
                    out.write(record)
                    offset, before = offset + len(record), before + n
                yield pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(zip(*index), kinds)], names=names)
        try:
            fs.move(own, f"{base}/part-{part:05d}.rec")
        except OSError:
            # Some file systems refuse to replace the file of an earlier attempt, which has the same bytes.
            if fs.get_file_info(f"{base}/part-{part:05d}.rec").size != offset:
                raise
            fs.delete_file(own)

    return run


def write_records(
    docs: DataFrame,
    root: str,
    tokenizer: str,
    end_id: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: int | None = None,
    by_piece: bool = True,
) -> None:
    """Encode, frame and write ``docs`` below ``root``, and the index below ``root``/index.

    ``vocabulary`` is one more than the largest id, read from the tokenizer's file if not given;
    ``by_piece=False`` has every text encoded whole.
    """
    spark = docs.sparkSession
    prepare(spark)
    rows = id_frame(docs, id_col, text_col).select("doc_id", F.col("text").cast("binary"))
    kind = rows.schema["doc_id"].dataType
    width = 2 if (vocabulary or max(largest_id(tokenizer), end_id) + 1) <= 1 << 16 else 4
    rows = rows.withColumn("tie", F.xxhash64("text"))
    ordered = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text")
    from pyspark.sql.pandas.types import to_arrow_type

    written = ordered.mapInArrow(
        _writer(f"{root}/data", tokenizer, end_id, width, by_piece, to_arrow_type(kind)),
        f"doc_id {kind.simpleString()}, part int, offset bigint, length bigint, width int, n_tokens bigint, before bigint",
    )
    written.write.parquet(f"{root}/parts")
    parts = spark.read.schema(written.schema).parquet(f"{root}/parts")
    totals = parts.groupBy("part").agg(F.sum("n_tokens").alias("n")).orderBy("part").collect()  # one row per file
    base, bases = 0, []
    for r in totals:
        bases.append((r["part"], base))
        base += r["n"]
    shift = spark.createDataFrame(bases, "part int, base bigint")
    parts.join(F.broadcast(shift), "part").select("doc_id", "part", "offset", "length", "width", "n_tokens", (F.col("base") + F.col("before")).alias("start")).write.parquet(
        f"{root}/index"
    )


def read_index(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(f"{root}/index")


def _reader(root: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _file_system(root)
        for b in batches:
            part, offset, length, width = (b.column(b.schema.names.index(c)).to_numpy() for c in ("part", "offset", "length", "width"))
            order = np.lexsort((offset, part))
            payloads: list = [None] * len(order)
            at = 0
            while at < len(order):
                first, stop = order[at], at + 1
                end = offset[first] + length[first]
                # Neighbouring records are read at once.
                while stop < len(order) and part[order[stop]] == part[first] and offset[order[stop]] == end and end - offset[first] < READ_BYTES:
                    end += length[order[stop]]
                    stop += 1
                with fs.open_input_file(f"{base}/part-{part[first]:05d}.rec") as f:
                    data = f.read_at(int(end - offset[first]), int(offset[first]))
                for k in order[at:stop]:
                    a = offset[k] - offset[first]
                    payloads[k] = np.frombuffer(unframe(data[a : a + length[k]]), dtype=f"<u{width[k]}").astype("<u4").tobytes()
                at = stop
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(payloads, type=pa.large_binary()).cast(pa.binary())], names=[*b.schema.names, "ids"])

    return run


def read_records(index: DataFrame, root: str) -> DataFrame:
    """The records of any index rows: their columns and ``ids``, little-endian 32-bit."""
    prepare(index.sparkSession)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in index.schema.fields)
    return index.mapInArrow(_reader(f"{root}/data"), f"{schema}, ids binary")


def q_op3_token_records(spark, sf_dir) -> DataFrame:
    """Write all documents as token records and read the files back through the index."""
    import public_tokenizers

    root = scratch_path(spark, "records")
    write_records(table(spark, sf_dir, "documents"), root, public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    index = read_index(spark, root)
    records = read_records(index.repartition("part"), root)
    return records.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
