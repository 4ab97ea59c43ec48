"""Mixing sources to target weights by repetition rates.

Sizes (words) are summed per source; sources in code-point order, null last, take the weights in
turn and share a given multiple of all words. A source's target stops at a multiple of its own
size, and what is above is shared again by weight until no target is above. The repetition rate
of a source is target / size: every document is taken floor(rate) times, and once more where a
number drawn from a hash of the seed, its id and its text's hash is below the rate's fraction.

Text is read once; ids, sources and sizes are written and used from there. Sums have a partial
step in every task, so a source with a third of all rows is no hot key; the table of sources is
joined by broadcast up to a measured number of rows and by the planner's shuffle join beyond.
Rates are found from sums over all sources, of which only three numbers a round reach the driver.

All steps to a target are integer sums and one division, so engines agree to the last bit.

Edge cases: a null text has no words; a source of no words has target 0; a null source is a source
of its own, after all others; a null id draws by its text alone; equal rows (id and text) draw the
same number, so they are taken equally often; an empty table gives an empty result; input columns
of other names are ignored by ``mixed`` and kept by ``emitted``.
"""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import broadcast_if_small
from .common import cut, prepare, table

WORD = r"[^\x20\x09-\x0D]+"
#: Fixed by the contract: weights in turn, share of all words, most repetitions of a source.
WEIGHTS = (3, 1, 2)
SHARE = Fraction(3, 2)
MOST = 2
SEED = 42
_HEX = 13  # digits of a draw: 52 bits, exact in double precision


def draw(seed: int, *cols: F.Column | str) -> F.Column:
    """A number in [0, 1) from the md5 of the seed and the columns, as text."""
    text = F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, _HEX), 16, 10).cast("double") / float(16**_HEX)


def _numbered(sources: DataFrame) -> DataFrame:
    """``sources`` with ``place``: the number of sources ordered before, null last.

    Sources are sorted by range, numbered inside each range, and the ranges' offsets added: no
    window takes all sources into one task."""
    last = F.col("source").isNull()
    sorted_ = sources.withColumn("last", last).repartitionByRange("last", "source").withColumn("bucket", F.spark_partition_id())
    rows = cut(sorted_, "sources")
    # One row a range: the window without a partition sees as many rows as there are ranges.
    upto = F.sum("n").over(Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    start = rows.groupBy("bucket").agg(F.count("*").alias("n")).select("bucket", F.coalesce(upto, F.lit(0)).alias("start"))
    inside = F.row_number().over(Window.partitionBy("bucket").orderBy("last", "source")) - 1
    return rows.withColumn("inside", inside).join(broadcast_if_small(start), "bucket").select("source", "source_size", (F.col("start") + F.col("inside")).alias("place"))


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: Fraction = SHARE, most: int = MOST) -> DataFrame:
    """``(source, source_size, target)`` from ``sizes (source, source_size)``, one row a source.

    Each round shares what the capped sources leave among the others by weight, and caps those
    now above; it ends when none is, after at most as many rounds as there are sources.
    """
    if share > most:
        raise ValueError("the share asks for more than the most that all sources may give")
    pattern = F.array(*[F.lit(int(w)) for w in weights])
    rows = cut(_numbered(sizes).withColumn("weight", pattern[(F.col("place") % len(weights)).cast("int")]), "weights")
    total = rows.agg(F.sum("source_size")).first()[0] or 0
    p, q = share.numerator, share.denominator
    # A source is capped where left * weight > most * size * q * open, in whole numbers.
    capped = F.lit(False)
    before = -1
    big = lambda c: F.col(c).cast("decimal(38,0)")
    while True:
        n, kept, open_ = rows.agg(
            F.count_if(capped),
            F.coalesce(F.sum(F.when(capped, F.col("source_size"))), F.lit(0)),
            F.coalesce(F.sum(F.when(~capped, F.col("weight"))), F.lit(0)),
        ).first()
        left = p * total - most * q * kept  # q times the words to share among the open sources
        if n == before or not open_:
            break
        before = n
        # What is left to a unit of weight never falls, so the sources capped before are among these.
        capped = big("weight") * F.lit(left).cast("decimal(38,0)") > big("source_size") * F.lit(most * q * open_).cast("decimal(38,0)")
    own = F.col("source_size").cast("double") * most
    if not open_:
        return rows.select("source", "source_size", own.alias("target"))
    # Of a small ``left`` the literal is an int, whose product with an int weight overflows.
    shared = (big("weight") * F.lit(left).cast("decimal(38,0)")).cast("double") / F.lit(float(q * open_))
    return rows.select("source", "source_size", F.when(capped, own).otherwise(shared).alias("target"))


def mixed(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    share: Fraction = SHARE,
    most: int = MOST,
    seed: int = SEED,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """``(doc_id, source, h, size, source_size, target, copies, taken)`` of every row; ``h`` is
    the text's hash and ``copies`` how often the mix takes the row."""
    prepare(docs.sparkSession)
    text = F.coalesce(F.col(text_col), F.lit(""))
    narrow = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).alias("source"),
        F.md5(text.cast("binary")).alias("h"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
    )
    rows = cut(narrow, "sizes")
    per_source = targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most)
    per_source = broadcast_if_small(per_source.withColumnRenamed("source", "of"))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    fraction = rate - F.floor(rate)
    copies = F.floor(rate).cast("long") + F.when(draw(seed, "doc_id", "h") < fraction, 1).otherwise(0)
    out = rows.join(per_source, F.col("source").eqNullSafe(F.col("of"))).withColumn("copies", copies)
    return out.select("doc_id", "source", "h", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def emitted(docs: DataFrame, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **how) -> DataFrame:
    """``docs``, each row as often as the mix takes it, in its own columns.

    The rows' numbers of copies come from the written narrow table; a row draws again here from
    its own id and text, so no text is shuffled and no row looked up.
    """
    found = mixed(docs, seed=seed, id_col=id_col, text_col=text_col, source_col=source_col, **how)
    names = set(docs.columns)
    free = lambda c: c if c not in names else free(c + "_")
    of, rate, n = free("of"), free("rate"), free("n")
    rates = found.where("source_size > 0").groupBy("source").agg(F.first(F.col("target") / F.col("source_size")).alias(rate))
    rates = broadcast_if_small(rates.withColumnRenamed("source", of))
    h = free("h")
    drawn = draw(seed, id_col, h)
    rows = docs.withColumn(h, F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary")))
    copies = F.floor(rate).cast("int") + F.when(drawn < F.col(rate) - F.floor(rate), 1).otherwise(0)
    joined = rows.join(rates, F.col(source_col).eqNullSafe(F.col(of))).withColumn(n, copies).where(F.col(n) > 0)
    return joined.withColumn(n, F.explode(F.sequence(F.lit(1), F.col(n)))).select(*docs.columns)


def q_op13_mixing(spark, sf_dir) -> DataFrame:
    """How often the mix of all sources takes each document."""
    out = mixed(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", "target", "taken")


#: The same targets in closed form: sources by the size per weight at which they are capped; the
#: open ones share what the others leave.
ORACLE_OP13 = r"""
WITH d AS (
  SELECT doc_id, source, md5(coalesce(text, '')) AS h,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS HUGEINT) AS sz FROM d GROUP BY source),
w AS (SELECT source, sz, CAST([3, 1, 2][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS HUGEINT) AS wt FROM s),
t AS (SELECT sum(sz) AS total FROM w),
r AS (
  SELECT a.source, a.sz, a.wt,
         3 * any_value(t.total) - 4 * coalesce(sum(b.sz) FILTER (WHERE b.sz * a.wt < a.sz * b.wt), 0) AS rest,
         coalesce(sum(b.wt) FILTER (WHERE b.sz * a.wt >= a.sz * b.wt), 0) AS open_wt
  FROM w a CROSS JOIN w b CROSS JOIN t GROUP BY a.source, a.sz, a.wt),
c AS (SELECT *, wt * rest > 4 * sz * open_wt AS capped FROM r),
lv AS (SELECT 3 * any_value(t.total) - 4 * coalesce(sum(sz) FILTER (WHERE capped), 0) AS rest,
              coalesce(sum(wt) FILTER (WHERE NOT capped), 0) AS open_wt FROM c CROSS JOIN t),
g AS (
  SELECT c.source, CAST(c.sz AS BIGINT) AS source_size,
         CASE WHEN capped OR lv.open_wt = 0 THEN CAST(c.sz AS DOUBLE) * 2
              ELSE CAST(c.wt * lv.rest AS DOUBLE) / CAST(2 * lv.open_wt AS DOUBLE) END AS target
  FROM c CROSS JOIN lv),
x AS (
  SELECT d.doc_id, d.size, g.source_size, g.target,
         CASE WHEN g.source_size > 0 THEN g.target / g.source_size ELSE 0 END AS rate,
         CAST(CAST('0x' || substr(md5('42:' || coalesce(CAST(d.doc_id AS VARCHAR), '') || ':' || d.h), 1, 13) AS BIGINT) AS DOUBLE) / 4503599627370496.0 AS u
  FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target,
       CAST(size * (floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM x
"""
