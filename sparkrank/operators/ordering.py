"""Ranking and order-statistics helpers shared by every ranked operator.

* ``top_k``: canonical per-group top-k. ``row_number() <= k`` over a *partitioned* window, which
  Catalyst turns into a partial ``WindowGroupLimit`` before the shuffle and a final one after,
  so at most k rows per group per map task cross the network.
* ``best_in_tasks``: before a ``top_k`` over very many scored rows, what is left of each task's rows
  without sorting them: those that its k best so far do not rule out.
* ``prefix_positions``: exact positions in a value order **without** a global window (a window
  with no PARTITION BY would pull every row into one task).
* ``exact_percentiles``: linear-interpolated percentiles from ``prefix_positions``; only the
  rows bracketing each requested rank are ever selected, never a whole group.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import RANK_DECIMALS, rank_key
from ..session import broadcast_if_bounded, broadcast_if_small, ship_package

# Rows that a task holds before it drops those ruled out, and after dropping before it hands them on.
HELD_ROWS = 65_536
MAX_HELD_ROWS = 1_000_000
# Scores further apart than this differ after rounding to RANK_DECIMALS.
_NEAR = 2 * 10.0**-RANK_DECIMALS


def top_k(
    df: DataFrame,
    k: int,
    by: Sequence[str] = ("qid",),
    score: str = "score",
    ascending: bool = False,
    tie: str = "doc_id",
    rank_col: str = "rank",
) -> DataFrame:
    """Keep the k best rows per ``by`` group, ranked by quantised ``score`` then ``tie``."""
    key = rank_key(score)
    order = [key.asc() if ascending else key.desc(), F.col(tie).asc()]
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= k)


def _ruled_out(group: np.ndarray, tie: np.ndarray, scores: np.ndarray, k: int, kth: np.ndarray) -> np.ndarray:
    """Which rows cannot be among the k best of their group by any score; raises ``kth``, the k-th best
    score seen of each group. Of rows with one and the same score k are left, those first by ``tie``."""
    out = ~np.isnan(scores).any(axis=1)
    place = np.arange(len(group))
    for j in range(scores.shape[1]):
        order = np.lexsort((tie, -scores[:, j], group))
        g, s = group[order], scores[order, j]
        new = np.r_[True, g[1:] != g[:-1]]
        pos = place - np.maximum.accumulate(np.where(new, place, 0))
        run = place - np.maximum.accumulate(np.where(new | np.r_[True, s[1:] != s[:-1]], place, 0))
        at = (pos == k - 1) & ~np.isnan(s)
        kth[g[at], j] = np.maximum(kth[g[at], j], s[at])
        out[order] &= (run >= k) | (s < kth[g, j] - _NEAR)
    return out


def _keeper(group: str, scores: list[str], tie: str, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes: dict = {}
        kth = np.empty((0, len(scores)))
        held: list[tuple[pa.RecordBatch, np.ndarray]] = []
        count, limit = 0, HELD_ROWS

        def matrix(b):
            return np.column_stack([b.column(c).to_numpy(zero_copy_only=False) for c in scores]).astype(np.float64, copy=False)

        for b in batches:
            coded = b.column(group).dictionary_encode(null_encoding="encode")
            code = np.array([codes.setdefault(v, len(codes)) for v in coded.dictionary.to_pylist()], dtype=np.int64)[coded.indices.to_numpy()]
            if len(codes) > len(kth):
                kth = np.concatenate([kth, np.full((2 * len(codes) - len(kth), len(scores)), -np.inf)])
            keep = ~(matrix(b) < kth[code] - _NEAR).all(axis=1)  # a NaN is kept
            if not keep.any():
                continue
            held.append((b.filter(pa.array(keep)), code[keep]))
            count += len(held[-1][1])
            if count < limit:
                continue
            rows = pa.Table.from_batches([x for x, _ in held]).combine_chunks().to_batches()[0]
            code = np.concatenate([c for _, c in held])
            order = pc.rank(rows.column(tie), sort_keys="ascending", null_placement="at_start", tiebreaker="dense").to_numpy()
            keep = ~_ruled_out(code, order, matrix(rows), k, kth)
            held, count = [(rows.filter(pa.array(keep)), code[keep])], int(keep.sum())
            if count > MAX_HELD_ROWS:  # what they rule out stays ruled out
                yield held.pop()[0]
                count = 0
            limit = max(HELD_ROWS, 2 * count)
        yield from (x for x, _ in held)

    return run


def best_in_tasks(df: DataFrame, k: int, scores: Sequence[str] = ("score",), group: str = "qid", tie: str = "doc_id") -> DataFrame:
    """Rows of ``df``, all that are among the k best of their ``group`` by any of ``scores`` (higher is
    better, ranked as ``top_k`` does) among them; ``(group, tie)`` is unique.

    Each task reads its rows as they come and holds those that its k best so far do not rule out: no
    sort, and memory that grows with groups and k, up to a bound, not with rows. ``top_k`` follows."""
    ship_package(df.sparkSession)
    return df.mapInArrow(_keeper(group, list(scores), tie, k), df.schema)


def prefix_positions(
    df: DataFrame,
    value: str,
    count: str | None = None,
    group: Sequence[str] = (),
    buckets: int | None = None,
    rows_per_bucket: int = 1_000_000,
) -> DataFrame:
    """Add ``__start``: number of rows of the same ``group`` ordered strictly before each row.

    ``df`` must have unique ``(group, value)`` rows of any orderable type; ``count`` (default 1)
    is each row's multiplicity. Rows are range-partitioned by their full (group, value), at
    boundaries sampled from the data, into about ``rows_per_bucket`` rows each, so a group that
    holds a third of all rows, or values that share any prefix, spread over many tasks. The
    running sum is a window per (group, bucket) and the bucket offsets come from a small
    per-(group, bucket) table. The bucket of each row is frozen with a reliable checkpoint so
    both consumers see the same buckets even after a task retry.
    """
    group = list(group)
    c = F.col(count) if count else F.lit(1).cast("long")
    base = df.withColumn("__c", c.cast("long"))
    if buckets is None:
        buckets = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-base.count() // rows_per_bucket))
    tagged = base.repartitionByRange(buckets, *group, value).withColumn("__bucket", F.spark_partition_id()).checkpoint(eager=True)
    tot = tagged.groupBy(*group, "__bucket").agg(F.sum("__c").alias("__tot"))
    wb = Window.partitionBy(*group).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = tot.withColumn("__off", F.coalesce(F.sum("__tot").over(wb), F.lit(0).cast("long"))).drop("__tot")
    wr = Window.partitionBy(*group, "__bucket").orderBy(F.col(value)).rowsBetween(Window.unboundedPreceding, 0)
    return (
        tagged.withColumn("__run", F.sum("__c").over(wr))
        .join(broadcast_if_small(offsets), [*group, "__bucket"])
        .withColumn("__start", F.col("__off") + F.col("__run") - F.col("__c"))
        .drop("__bucket", "__run", "__off")
    )


def exact_percentiles(
    df: DataFrame, value: str, percents: dict[str, float], group: Sequence[str] = ()
) -> DataFrame:
    """Percentiles with linear interpolation between closest ranks (numpy's default method).

    Returns one row per group with one column per entry of ``percents`` (name -> fraction).
    Work: a partial aggregation to distinct values, then ``prefix_positions``; only the rows
    that hold a wanted rank are selected (at most two per percentile and group).
    """
    group = list(group) or []
    synthetic = not group
    vals = df.select(*group, value).filter(F.col(value).isNotNull())
    if synthetic:
        vals = vals.withColumn("__g", F.lit(0))
        group = ["__g"]
    distinct_vals = vals.groupBy(*group, value).agg(F.count(F.lit(1)).alias("__cnt"))
    positioned = prefix_positions(distinct_vals, value, "__cnt", group)
    counts = distinct_vals.groupBy(*group).agg(F.sum("__cnt").alias("__n"))
    wanted = counts
    for name, p in percents.items():
        h = (F.col("__n") - 1) * F.lit(float(p))
        wanted = wanted.withColumn(f"__lo_{name}", F.floor(h).cast("long")).withColumn(
            f"__fr_{name}", h - F.floor(h)
        )
    lo_cols = [F.col(f"__lo_{name}") for name in percents]
    hi_cols = [F.least(F.col(f"__lo_{name}") + 1, F.col("__n") - 1) for name in percents]
    targets = wanted.select(*group, F.array_distinct(F.array(*lo_cols, *hi_cols)).alias("__t"))
    picked = (
        positioned.join(broadcast_if_small(targets), group)
        .select(
            *group,
            F.col(value).alias("__v"),
            F.filter(
                F.col("__t"), lambda t: (t >= F.col("__start")) & (t < F.col("__start") + F.col("__c"))
            ).alias("__hit"),
        )
        .filter(F.size("__hit") > 0)
        .select(*group, F.explode("__hit").alias("__pos"), "__v")
    )
    # At most 2 * len(percents) rows per group survive: gather them into a map per group.
    by_pos = picked.groupBy(*group).agg(F.map_from_entries(F.collect_list(F.struct("__pos", "__v"))).alias("__m"))
    out = wanted.join(by_pos, group)
    sel = []
    for name in percents:
        lo = F.col(f"__lo_{name}")
        hi = F.least(lo + 1, F.col("__n") - 1)
        v_lo = F.element_at(F.col("__m"), lo)
        v_hi = F.element_at(F.col("__m"), hi)
        sel.append((v_lo + (v_hi - v_lo) * F.col(f"__fr_{name}")).alias(name))
    keep = [] if synthetic else group
    return out.select(*keep, *sel)


def first_n_by(df: DataFrame, n: int, order: str) -> DataFrame:
    """Rows whose ``order`` value is among the n smallest (``order`` unique): the reference's
    "first n". A sort with a limit keeps n rows per task and merges those."""
    ids = df.select(order).orderBy(order).limit(n)
    return df.join(broadcast_if_bounded(ids, n), order, "left_semi")
