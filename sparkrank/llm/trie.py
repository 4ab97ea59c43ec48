"""Prefix trie of conversations, and subtree totals by time-forward processing.

Nodes. A turn is known by two 64-bit hashes of role and text, a prefix by its depth and the
running exclusive-or of its turns' hashes, each taken with the turn's position (128 bits). Turns
are sorted by range of (conversation, order), so a conversation with a third of all turns spreads
over many tasks; what runs on across ranges is added from a table of at most two rows a range.
Nodes are the groups of equal prefixes (partial aggregation). Along a conversation the smallest
member only grows, so ``(conv_id, depth)`` with the smallest member names a node, and the parent
of a node is looked up on its smallest member's own path: no join on a hot parent.

Shards. A node with more than ``B`` members is a top node; below the last of them the subtrees have
at most ``B`` members. Both parts are cut into bands of ``BAND`` levels, counted from the root and
from the subtree's top. A shard holds whole pieces of one band, bounded by B times BAND nodes.

Totals. Every shard takes its nodes in reverse level order (sorted externally by Spark) and sends
each node's totals forward to its parent through a priority queue, which spills sorted runs to the
shared folder. Totals of piece roots leave the shard: those of pieces without a piece below are
summed per receiving piece, the others (at most one in ``BAND`` nodes, besides the top pieces) run
through one more queue over the piece roots. A second pass inside the shards starts with what the
piece roots sent.

Digests of a node's ending members: the sorted ids are joined in runs of ``RUN`` ids where they
lie, and only the runs of a node come together, streamed into one hash.

Edge cases: rows without a conversation id belong to no conversation and are left out; null roles
and texts are empty; turns are ordered by turn, nulls first, equal turns by a hash of role and
text; repeated rows are turns of their own; a conversation given without turns is a member of the
root alone; an empty table has no node; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import math
import uuid
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..session import broadcast_if_small, scratch_path
from .common import cut, prepare, table
from .records import _file_system

BAND = 512
MIN_MEMBERS = 64
RUN = 4096
QUEUE = 1_000_000
FEW = 200_000  # piece roots and sums sent to them are broadcast up to so many rows
#: Prefixes of more members than this (or a 100,000th of all conversations) are joined apart.
HOT_MEMBERS = 256
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


class SpillingQueue:
    """A priority queue of equally long tuples of 64-bit integers; beyond ``limit`` entries the
    entries held are sorted and written to ``folder`` as one run, read back in blocks."""

    def __init__(self, folder: str | None, limit: int = QUEUE, block: int = 8192):
        self.folder, self.limit, self.block = folder, limit, block
        self.heap: list[tuple] = []
        self.heads: list[tuple] = []  # the first entry of every run, with the run that goes on

    def push(self, item: tuple) -> None:
        heapq.heappush(self.heap, item)
        if len(self.heap) > self.limit:
            self._spill()

    def _spill(self) -> None:
        fs, base = _file_system(self.folder)
        path = f"{base}/run-{uuid.uuid4().hex}"
        fs.create_dir(base, recursive=True)
        rows = np.array(sorted(self.heap), dtype=np.int64)
        self.heap = []
        schema = pa.schema([(f"c{k}", pa.int64()) for k in range(rows.shape[1])])
        with fs.open_output_stream(path) as out, pa.ipc.new_stream(out, schema) as writer:
            for at in range(0, len(rows), self.block):
                some = rows[at : at + self.block]
                writer.write_batch(pa.RecordBatch.from_arrays([pa.array(c) for c in some.T], schema=schema))
        self._next(len(self.heads), self._read(fs, path))

    @staticmethod
    def _read(fs, path: str) -> Iterator[tuple]:
        with fs.open_input_stream(path) as source, pa.ipc.open_stream(source) as reader:
            for batch in reader:
                yield from zip(*(c.to_pylist() for c in batch.columns))
        fs.delete_file(path)

    def _next(self, number: int, run: Iterator[tuple]) -> None:
        item = next(run, None)
        if item is not None:
            heapq.heappush(self.heads, (item, uuid.uuid4().int, run))

    def first(self) -> tuple | None:
        a, b = self.heap[0] if self.heap else None, self.heads[0][0] if self.heads else None
        return a if b is None or (a is not None and a <= b) else b

    def pop(self) -> tuple:
        item = self.first()
        if self.heap and self.heap[0] is item:
            return heapq.heappop(self.heap)
        _, number, run = heapq.heappop(self.heads)
        self._next(number, run)
        return item


def forward(rows: Iterator[tuple], queue: SpillingQueue) -> Iterator[tuple]:
    """Time-forward processing of ``(depth, node, parent, sends, leaves, saved)`` rows, deepest
    first and by node: yields ``(leaves, saved)`` totals in the rows' order. ``sends`` is the depth
    of the parent, or None where the total leaves this shard."""
    for depth, node, parent, sends, leaves, saved in rows:
        while (head := queue.first()) is not None and head[:2] <= (-depth, node):
            if head[:2] != (-depth, node):
                raise ValueError(f"a message to node {head[:2]} found no such node")
            _, _, more, words = queue.pop()
            leaves, saved = leaves + more, saved + words
        if sends is not None:
            queue.push((-sends, parent, leaves, saved))
        yield leaves, saved
    if queue.first() is not None:
        raise ValueError("messages were left over")


def _forward(folder: str, limit: int):
    """``forward`` over sorted batches; ``leaves`` and ``saved`` become the totals."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queue = SpillingQueue(folder, limit)
        held: list[pa.RecordBatch] = []

        def rows():
            for b in batches:
                held.append(b)
                cols = [b.column(b.schema.get_field_index(c)).to_pylist() for c in ("depth", "node", "parent", "sends", "leaves", "saved")]
                yield from zip(*cols)
            held.append(None)

        totals: list[tuple] = []
        for t in forward(rows(), queue):
            totals.append(t)
            while held and held[0] is not None and len(totals) >= held[0].num_rows:
                b = held.pop(0)
                done, totals = totals[: b.num_rows], totals[b.num_rows :]
                if done:
                    for name, c in zip(("leaves", "saved"), zip(*done)):
                        b = b.set_column(b.schema.get_field_index(name), name, pa.array(c, type=pa.int64()))
                    yield b

    return run


def _time_forward(rows: DataFrame, folder: str, limit: int) -> DataFrame:
    """``rows``, already together by shard, with totals inside their shards."""
    ordered = rows.sortWithinPartitions(F.desc("depth"), "node")
    return ordered.mapInArrow(_forward(folder, limit), rows.schema)


def _running(names: list[str], xors: list[str], schema: pa.Schema):
    """Rows with their place and running values in this range, then one row (``edge``) with the
    totals of the range's first and of its last conversation."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket = TaskContext.get().partitionId()
        last, count, carry = None, 0, [0] * len(xors)
        edges: list[tuple] = []
        for b in batches:
            if not b.num_rows:
                continue
            conv = b.column(0).to_numpy(zero_copy_only=False)
            new = np.concatenate([[conv[0] != last], conv[1:] != conv[:-1]])
            at = np.maximum.accumulate(np.where(new, np.arange(len(conv)), 0))
            pos = np.arange(len(conv)) - at + 1
            goes_on = np.cumsum(new) == 0
            pos[goes_on] += count
            got = []
            for k, x in enumerate(xors):
                v = b.column(b.schema.get_field_index(x)).to_numpy(zero_copy_only=False)
                whole = np.bitwise_xor.accumulate(v)
                y = whole ^ (whole ^ v)[at]
                y[goes_on] ^= carry[k]
                got.append(y)
            if not edges:
                edges.append((int(conv[0]), 0, [0] * len(xors)))
            stays = np.nonzero(conv == edges[0][0])[0]
            if len(stays):
                k = stays[-1]
                edges[0] = (edges[0][0], int(pos[k]), [int(y[k]) for y in got])
            last, count, carry = int(conv[-1]), int(pos[-1]), [int(y[-1]) for y in got]
            mine = [pa.array(np.full(len(conv), bucket, dtype=np.int32)), pa.array(np.zeros(len(conv), dtype=bool)), pa.array(pos)]
            yield pa.RecordBatch.from_arrays([*b.columns, *mine, *map(pa.array, got)], names=names)
        if last is not None and last != edges[0][0]:
            edges.append((last, count, carry))
        for conv, n, xs in edges:
            values = {names[0]: conv, "bucket": bucket, "edge": True, "pos": n} | {f"x_{c}": x for c, x in zip(xors, xs)}
            yield pa.RecordBatch.from_pylist([values], schema=schema)

    return run


def running(rows: DataFrame, order: list[str], xors: list[str] = ()) -> DataFrame:
    """``rows`` (``conv_id`` first) with ``pos``, the place in the conversation from 1, and ``x_c``,
    the exclusive-or up to there, of each column ``c`` in ``xors``.

    The driver sees two totals a range, and adds up those of conversations that run across ranges.
    """
    spark = rows.sparkSession
    ordered = rows.repartitionByRange("conv_id", *order).sortWithinPartitions("conv_id", *order)
    extra = [("bucket", "int"), ("edge", "boolean"), ("pos", "bigint"), *[(f"x_{c}", "bigint") for c in xors]]
    kinds = [f"{f.name} {f.dataType.simpleString()}" for f in rows.schema] + [f"{c} {t}" for c, t in extra]
    kind = T.StructType.fromDDL(", ".join(kinds))
    got = cut(ordered.mapInArrow(_running(kind.names, list(xors), to_arrow_schema(kind)), kind), "running")
    totals = defaultdict(list)
    for r in got.where("edge").select("conv_id", "bucket", "pos", *[f"x_{c}" for c in xors]).toLocalIterator():
        totals[r[0]].append(tuple(r)[1:])
    offsets = []
    for conv, found in totals.items():
        before = [0] * (1 + len(xors))
        for bucket, n, *xs in sorted(found):
            if before[0]:
                offsets.append((conv, bucket, *before))
            before = [before[0] + n, *[x ^ y for x, y in zip(before[1:], xs)]]
    names = ["conv_id bigint", "bucket int", "off bigint", *[f"o_{c} bigint" for c in xors]]
    both = got.where("not edge").join(F.broadcast(spark.createDataFrame(offsets, ", ".join(names))), ["conv_id", "bucket"], "left")
    zero = F.lit(0).cast("long")
    whole = [F.col(f"x_{c}").bitwiseXOR(F.coalesce(f"o_{c}", zero)).alias(f"x_{c}") for c in xors]
    return both.select(*rows.columns, (F.col("pos") + F.coalesce("off", zero)).alias("pos"), *whole)


def numbered_turns(
    conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """``(conv_id, pos, d1, d2, chars)`` of every turn: its place, hashes, and text length."""
    prepare(conversations.sparkSession)
    role, text = F.coalesce(F.col(role_col), F.lit("")), F.coalesce(F.col(text_col), F.lit(""))
    rows = conversations.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv_id"),
        F.col(turn_col).alias("turn"),
        F.xxhash64(role, text).alias("d1"),
        F.xxhash64(text, role, F.lit(1)).alias("d2"),
        F.char_length(text).cast("long").alias("chars"),
    )
    return running(rows, ["turn", "d1", "d2"]).select("conv_id", "pos", "d1", "d2", "chars")


def with_shared_heads(turns: DataFrame, block: int = 100, most: int = 6) -> DataFrame:
    """``turns`` in which conversation c starts with the first h turns of conversation
    c - c % block and goes on with its own turns after its first h; h = crc32(c as text) % most."""
    head = F.col("conv_id") - F.col("conv_id") % block
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    convs = turns.select("conv_id").distinct().select("conv_id", head.alias("head"), h.alias("h"))
    firsts = turns.where((F.col("conv_id") % block == 0) & (F.col("pos") < most)).withColumnRenamed("conv_id", "head")
    lent = convs.join(broadcast_if_small(firsts), "head").where("pos <= h").select(*turns.columns)
    sizes = firsts.groupBy("head").agg(F.max("pos").alias("n"))  # at most most - 1: what can be lent
    own = turns.withColumn("head", head).withColumn("h", h).where("pos > h").join(broadcast_if_small(sizes), "head", "left")
    moved = F.col("pos") - F.col("h") + F.least("h", F.coalesce("n", F.lit(0)))
    return lent.unionByName(own.withColumn("pos", moved).select(*turns.columns))


def _paths(turns: DataFrame, n_convs: int) -> DataFrame:
    """``(conv_id, depth, m, n, chars)``: for each conversation and depth the node's smallest
    member, its number of members, and its last text's length."""
    place = F.col("depth")
    rows = turns.withColumnRenamed("pos", "depth").select(
        "conv_id", "depth", "chars", F.xxhash64(place, "d1", "d2").alias("h1"), F.xxhash64("d2", place, "d1").alias("h2")
    )
    rows = running(rows, ["depth"], ["h1", "h2"]).select("conv_id", "depth", "chars", "x_h1", "x_h2")
    key = ["depth", "x_h1", "x_h2"]
    nodes = cut(rows.groupBy(*key).agg(F.min("conv_id").alias("m"), F.count("*").alias("n")), "nodes")
    many = F.col("n") > max(HOT_MEMBERS, n_convs // 100_000)
    hot = nodes.where(many)
    few = rows.join(broadcast_if_small(hot.select(*key)), key, "left_anti").join(nodes.where(~many), key)
    both = few.unionByName(rows.join(broadcast_if_small(hot), key).select(*few.columns))
    return cut(both.select("conv_id", "depth", "m", "n", "chars"), "paths")


def _joined_runs(run_ids: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["m", "depth", "first", "ids"]
        key, ids, out = None, [], []

        def close():
            if ids:
                out.append((*key, ids[0], ",".join(map(str, ids))))

        for b in batches:
            for m, d, c in zip(*(x.to_pylist() for x in b.columns)):
                if (m, d) != key or len(ids) >= run_ids:
                    close()
                    key, ids = (m, d), []
                ids.append(c)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out)], names=names)
                out = []
        close()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out)], names=names)

    return run


def _hashed_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["m", "depth", "sha"]
    key, digest, out = None, None, []
    for b in batches:
        for m, d, ids in zip(*(b.column(k).to_pylist() for k in (0, 1, 3))):
            if (m, d) != key:
                if key:
                    out.append((*key, digest.hexdigest()))
                key, digest = (m, d), hashlib.sha256(ids.encode())
            else:
                digest.update(b"," + ids.encode())
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out)], names=names)
            out = []
    if key:
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in ([key[0]], [key[1]], [digest.hexdigest()])], names=names)


def ends_digests(ends: DataFrame, run_ids: int = RUN) -> DataFrame:
    """``(m, depth, sha)`` from ``ends (m, depth, conv_id)``: SHA-256 of each node's sorted ids."""
    sorted_ = ends.select("m", "depth", "conv_id").repartitionByRange("m", "depth", "conv_id").sortWithinPartitions("m", "depth", "conv_id")
    runs = sorted_.mapInArrow(_joined_runs(run_ids), "m bigint, depth bigint, first bigint, ids string")
    together = runs.repartition("m", "depth").sortWithinPartitions("m", "depth", "first")
    return together.mapInArrow(_hashed_runs, "m bigint, depth bigint, sha string")


_NODE = "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, ends_sha256 string"


def prefix_trie(turns: DataFrame, convs: DataFrame, band: int = BAND, members: int | None = None, queue: int = QUEUE, run_ids: int = RUN) -> DataFrame:
    """Nodes of the trie of ``turns`` (as from ``numbered_turns``): ``(conv_id, depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256)``.

    ``convs (conv_id)`` has every conversation once, those without turns too. ``members`` is B of
    the module's text, the root of the number of conversations (at least ``MIN_MEMBERS``) if None.
    """
    spark = turns.sparkSession
    prepare(spark)
    n_convs, least = convs.agg(F.count("*"), F.min("conv_id")).first()
    if not n_convs:
        return spark.createDataFrame([], _NODE)
    members = members or max(MIN_MEMBERS, math.isqrt(n_convs))
    path = _paths(turns, n_convs)
    long = lambda x: F.lit(x).cast("long")

    # Nodes with their parents and numbers of children.
    up = path.select("conv_id", (F.col("depth") + 1).alias("depth"), F.col("m").alias("parent"))
    own = path.where("conv_id = m").join(up, ["conv_id", "depth"], "left").withColumn("parent", F.coalesce("parent", long(least)))
    own = cut(own.select(F.col("conv_id").alias("node"), "depth", "parent", "n", "chars"), "own")
    kids = own.groupBy(F.col("parent").alias("node"), (F.col("depth") - 1).alias("depth")).agg(F.count("*").alias("kids"))
    root = spark.range(1).select(long(least).alias("node"), long(0).alias("depth"), long(None).alias("parent"), long(n_convs).alias("n"), long(0).alias("chars"))
    nodes = own.unionByName(root).join(kids, ["node", "depth"], "left").withColumn("kids", F.coalesce("kids", long(0)))

    # Shards: each conversation's first node that is no top node, with the subtree's owner.
    low = F.when(F.col("n") <= members, F.struct("depth", "m"))
    per = cut(path.groupBy("conv_id").agg(F.min(low).alias("low"), F.max(F.struct("depth", "m")).alias("end")), "conversations")
    trees = per.select(F.col("conv_id").alias("node"), F.col("low.depth").alias("k"), F.col("low.m").alias("tree"))
    placed = nodes.join(trees, "node", "left")
    if n_convs <= members:  # the root is no top node: all is one subtree
        placed = placed.withColumn("k", long(0)).withColumn("tree", long(least))
    else:  # conversations of top nodes alone, and the root
        placed = placed.withColumn("k", F.when(F.col("depth") == 0, long(1)).otherwise(F.coalesce("k", F.col("depth") + 1)))
    top = F.col("depth") < F.col("k")
    deep = F.when(top, F.col("depth")).otherwise(F.col("depth") - F.col("k"))
    leaves = (F.col("depth") == 0) | (deep % band == 0)  # the total leaves the piece
    above = F.when(~top & (deep == 0), F.floor((F.col("depth") - 1) / band) * band).otherwise(F.col("depth") - band)
    placed = placed.select(
        "node", "depth", "parent", "n", "kids",
        F.when(~leaves, F.col("depth") - 1).alias("sends"),
        F.when(leaves & (F.col("depth") > 0), above.cast("long")).alias("above"),
        F.when(F.col("kids") == 0, long(1)).otherwise(long(0)).alias("leaves"),
        ((F.col("n") - 1) * F.col("chars")).alias("saved"),
        F.when(top, long(least)).otherwise(F.col("tree")).alias("tree"),
        F.when(top, long(-1)).otherwise(F.col("k")).alias("k"),
        F.floor(deep / band).alias("band"),
    )
    placed = cut(placed, "placed")
    folder = scratch_path(spark, "queues")
    shards = lambda df: df.repartition("tree", "k", "band")

    # Within shards, across piece roots, and within shards once more.
    first = _time_forward(shards(placed), folder, queue)
    roots = first.where("sends is null").select("node", "depth", "parent", "above", "leaves", "saved")
    roots = cut(roots, "piece-roots")
    few = lambda df: broadcast_if_small(df, FEW)
    over = path.select(F.col("conv_id").alias("node"), F.col("depth").alias("above"), F.col("m").alias("to"))
    near = roots.where("above is null or above = 0").withColumn("to", F.when(F.col("above") == 0, long(least)))
    roots = near.unionByName(few(roots.where("above > 0")).join(over, ["node", "above"]).select(*near.columns))
    roots = cut(roots, "received")
    within = roots.where("above is not null").select(F.col("to").alias("node"), F.col("above").alias("depth")).distinct()
    within = few(cut(within, "receivers"))
    single = roots.join(within, ["node", "depth"], "left_anti")
    sums = [F.sum("leaves").alias("more"), F.sum("saved").alias("words")]
    sent = single.where("above is not null").groupBy(F.col("to").alias("node"), F.col("above").alias("depth")).agg(*sums)
    plus = lambda a, b: (F.col(a) + F.coalesce(b, long(0))).alias(a)
    inner = roots.join(within, ["node", "depth"], "left_semi").join(few(cut(sent, "sent")), ["node", "depth"], "left")
    inner = inner.select("node", "depth", F.col("parent").alias("below"), F.col("to").alias("parent"), F.col("above").alias("sends"), plus("leaves", "more"), plus("saved", "words"))
    inner = _time_forward(inner.repartition(1), folder, queue)
    totals = single.select("parent", "depth", "leaves", "saved").unionByName(inner.select(F.col("below").alias("parent"), "depth", "leaves", "saved"))
    given = totals.where("parent is not null").groupBy(F.col("parent").alias("node"), (F.col("depth") - 1).alias("depth")).agg(*sums)
    again = placed.join(few(cut(given, "given")), ["node", "depth"], "left")
    again = again.select(*[c for c in placed.columns if c not in ("leaves", "saved")], plus("leaves", "more"), plus("saved", "words"))
    done = _time_forward(shards(again), folder, queue)

    ends = per.select("end.m", "end.depth", "conv_id")
    if per.count() < n_convs:
        turnless = convs.join(per, "conv_id", "left_anti").select(long(least).alias("m"), long(0).alias("depth"), "conv_id")
        ends = ends.unionByName(turnless)
    sha = ends_digests(ends, run_ids).withColumnRenamed("m", "node")
    return done.join(sha, ["node", "depth"], "left").select(
        F.col("node").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), F.col("n").alias("n_convs"), F.col("kids").alias("n_children"),
        F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), F.coalesce("sha", F.lit(EMPTY_SHA)).alias("ends_sha256"),
    )


def conversation_trie(conversations: DataFrame, **how) -> DataFrame:
    """The prefix trie of conversations as they are."""
    turns = numbered_turns(conversations)
    return prefix_trie(turns, cut(turns.select("conv_id").distinct(), "convs"), **how)


def q_op12_trie(spark, sf_dir) -> DataFrame:
    """The prefix trie of all conversations, rebuilt on the shared heads of their blocks."""
    prepare(spark)
    turns = numbered_turns(table(spark, sf_dir, "conversations"))
    convs = cut(turns.select("conv_id").distinct(), "convs")
    return prefix_trie(with_shared_heads(turns), convs)
