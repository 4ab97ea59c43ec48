"""Span lists as columns: ``array<struct<kind, start, stop, ...>>`` to the digest strings."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def joined(spans: str | Column, kinds: Sequence[str] | None = None) -> Column:
    """``kind:start:stop`` of the spans (of some kinds), comma-joined in their order."""
    spans = F.col(spans) if isinstance(spans, str) else spans
    if kinds is not None:
        spans = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def count_of(spans: str, kind: str) -> Column:
    return F.size(F.filter(F.col(spans), lambda s: s["kind"] == kind)).cast("long")


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def running_sums(counts: Column) -> Column:
    """``array<int>``: the sum of the counts up to each one.

    Sums are made in blocks of about the root of their number, so no long array grows element by
    element.
    """
    none = F.array().cast("array<int>")

    def of(ns: Column) -> Column:
        size = F.greatest(F.ceil(F.sqrt(F.size(ns))).cast("int"), F.lit(1))
        blocks = F.transform(F.sequence(F.lit(0), F.greatest(F.ceil(F.size(ns) / size).cast("int") - 1, F.lit(0))), lambda j: F.slice(ns, j * size + 1, size))
        one = lambda acc, n: F.struct((acc["at"] + n).alias("at"), F.concat(acc["out"], F.array(acc["at"] + n)).alias("out"))

        def block(acc: Column, some: Column) -> Column:
            done = F.aggregate(some, F.struct(acc["at"].alias("at"), none.alias("out")), one)
            return let(done, lambda d: F.struct(d["at"].alias("at"), F.concat(acc["out"], F.array(d["out"])).alias("out")))

        zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<array<int>>").alias("out"))
        return F.flatten(F.aggregate(blocks, zero, block, lambda acc: acc["out"]))

    return let(counts, of)
