"""Secret scan: patterns, then character Markov models; DataFrame operations only.

Base kinds are matched by their patterns. The method adds ``random`` spans: long runs of key
characters outside base spans are scored by two first-order character models, one of random
strings and one of ordinary identifiers, and are reported when the log-likelihood ratio is at
least ``MIN_RATIO`` nats. The models are trained on all rows: ``training_samples`` takes every
distinct identifier as ordinary, and digests of the same identifiers in the usual encodings,
with the values the base patterns found, as random. A model is a table of at most
``(len(ALPHABET) + 1) ** 2`` cells, so it travels as a literal; every text is scanned whole,
and only distinct identifiers are shuffled, while training.

Match positions come from splitting a text by a pattern: the pieces and the matches alternate,
and their code-point lengths add up to the offsets.

Edge cases: a null text is empty; an empty text has no spans; characters outside the alphabet
never occur in a candidate; without any sample both models are uniform and nothing is added;
repeated rows get equal results; other columns, whatever their names, pass through.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, table
from .spans import count_of, joined, let

BASE = ("assign", "access", "hex")
KINDS = (*BASE, "random")
ASSIGN = (
    r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
#: A run is taken whole, so asking for its least length in the pattern drops no other match.
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
MIN_ASSIGNED = 6
MIN_RATIO = 12.0
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
_CELLS = len(ALPHABET) + 1  # index 0: anything else


def _placed(found: Column, empty: Column) -> Column:
    """Offsets of matches, in blocks of about the root of their number: arrays that grow match by
    match stay short, so a text with very many matches costs little more than linear time."""
    size = F.greatest(F.ceil(F.sqrt(F.size(found))).cast("int"), F.lit(1))
    blocks = F.transform(F.sequence(F.lit(0), F.greatest(F.ceil(F.size(found) / size).cast("int") - 1, F.lit(0))), lambda j: F.slice(found, j * size + 1, size))

    def one(acc: Column, m: Column) -> Column:
        start, stop = acc["at"] + m["gap"], acc["at"] + m["gap"] + m["size"]
        span = F.struct(start.alias("start"), stop.alias("stop"), m["value"].alias("value"))
        return F.struct(stop.alias("at"), F.concat(acc["out"], F.array(span)).alias("out"))

    def block(acc: Column, some: Column) -> Column:
        done = F.aggregate(some, F.struct(acc["at"].alias("at"), empty.alias("out")), one)
        return let(done, lambda d: F.struct(d["at"].alias("at"), F.concat(acc["out"], F.array(d["out"])).alias("out")))

    nothing = F.array().cast("array<array<struct<start:int,stop:int,value:string>>>")
    return F.aggregate(blocks, F.struct(F.lit(0).alias("at"), nothing.alias("out")), block, lambda acc: acc["out"])


def matches(text: Column, pattern: str, group: int = 0) -> Column:
    """``array<struct<start, stop, value>>`` of all matches; ``value`` is the given group."""
    empty = F.array().cast("array<struct<start:int,stop:int,value:string>>")
    gaps = F.split(text, pattern)
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    rows = F.transform(
        F.arrays_zip(F.slice(gaps, 1, F.size(whole)).alias("gap"), whole.alias("whole"), value.alias("value")),
        lambda m: F.struct(F.length(m["gap"]).alias("gap"), F.length(m["whole"]).alias("size"), m["value"].alias("value")),
    )
    placed = let(rows, lambda found: F.flatten(_placed(found, empty)))
    return F.when(text.rlike(pattern), placed).otherwise(empty)


def base_spans(text: Column) -> Column:
    """``array<struct<start, rank, kind, stop, value>>``, sorted by start and kind."""

    def of(kind: str, found: Column) -> Column:
        return F.transform(
            found,
            lambda m: F.struct(
                m["start"].alias("start"), F.lit(KINDS.index(kind)).alias("rank"), F.lit(kind).alias("kind"), m["stop"].alias("stop"), m["value"].alias("value")
            ),
        )

    assigned = F.filter(matches(text, ASSIGN, 2), lambda m: F.length(m["value"]) >= MIN_ASSIGNED)
    return F.concat(of("assign", assigned), of("access", matches(text, ACCESS)), of("hex", matches(text, HEX)))


def training_samples(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``(sample, random)``: labelled strings from all rows."""
    every = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    # Base matches are blanked out of what counts as ordinary.
    plain = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.col("t"), ASSIGN, " "), ACCESS, " "), HEX, " ")
    names = every.select(F.explode(F.array_distinct(F.regexp_extract_all(plain, F.lit("[A-Za-z][A-Za-z0-9_-]{4,}"), F.lit(0)))).alias("sample")).distinct()
    names = cut(names, "identifiers")  # counted as they are and once more as digests
    digest = F.unhex(F.sha2("sample", 256))
    made = names.select(F.explode(F.array(F.base64(digest), F.sha2("sample", 256), F.upper(F.md5("sample")), F.translate(F.base64(digest), "+/", "-_"))).alias("sample"))
    found = every.select(F.explode(F.transform(base_spans(F.col("t")), lambda s: s["value"])).alias("sample"))
    return names.withColumn("random", F.lit(False)).unionByName(made.unionByName(found).withColumn("random", F.lit(True)))


def train(samples: DataFrame, alpha: float = 0.5) -> list[float]:
    """Log-likelihood ratios (random over ordinary) of each character after each other one.

    Counts are aggregated in Spark; at most ``2 * _CELLS ** 2`` rows reach the driver.
    """
    # Pairs are counted as they are, and once more by cell: characters outside the alphabet share one.
    pairs = samples.where("length(sample) > 1").select("random", F.explode(F.expr("transform(sequence(1, length(sample) - 1), i -> substr(sample, i, 2))")).alias("pair"))
    index = lambda i: F.expr(f"locate(substr(pair, {i}, 1), '{ALPHABET}')")
    cells = pairs.groupBy("random", "pair").agg(F.count("*").alias("n")).withColumn("cell", index(1) * _CELLS + index(2))
    counted = cells.groupBy("random", "cell").agg(F.sum("n").alias("n")).collect()
    counts = {side: [0] * _CELLS**2 for side in (True, False)}
    for r in counted:
        counts[r["random"]][r["cell"]] = r["n"]
    logs = {}
    for side, c in counts.items():
        totals = [sum(c[a * _CELLS : (a + 1) * _CELLS]) for a in range(_CELLS)]
        logs[side] = [math.log((x + alpha) / (totals[k // _CELLS] + alpha * _CELLS)) for k, x in enumerate(c)]
    return [round(a - b, 6) for a, b in zip(logs[True], logs[False])]


def log_ratio(value: Column, model: list[float]) -> Column:
    """Sum of the model over the adjacent characters of ``value``."""
    cells = F.expr(f"array({', '.join(f'{x}D' for x in model)})")  # folded to one constant
    index = F.transform(F.split(value, ""), lambda c: F.instr(F.lit(ALPHABET), c))

    def total(ix: Column) -> Column:
        pairs = F.zip_with(F.slice(ix, 1, F.size(ix) - 1), F.slice(ix, 2, F.size(ix) - 1), lambda a, b: F.element_at(cells, a * _CELLS + b + 1))
        return F.aggregate(pairs, F.lit(0.0), lambda acc, x: acc + x)

    return let(index, total)


def find_secrets(docs: DataFrame, model: list[float], text_col: str = "text", out: str = "spans", min_ratio: float = MIN_RATIO) -> DataFrame:
    """``docs`` with ``out``: ``array<struct<start, rank, kind, stop, value, ratio>>``."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    kept = [F.col(f"`{c}`") for c in docs.columns]
    rows = docs.select(F.struct(*kept).alias("row"), text.alias("t"))
    rows = rows.select("row", base_spans(F.col("t")).alias("base"), matches(F.col("t"), CANDIDATE).alias("runs"))
    free = F.filter("runs", lambda c: ~F.exists("base", lambda b: (b["start"] < c["stop"]) & (b["stop"] > c["start"])))
    scored = F.transform(
        free,
        lambda c: F.struct(
            c["start"].alias("start"),
            F.lit(KINDS.index("random")).alias("rank"),
            F.lit("random").alias("kind"),
            c["stop"].alias("stop"),
            c["value"].alias("value"),
            log_ratio(c["value"], model).alias("ratio"),
        ),
    )
    added = F.filter(scored, lambda s: s["ratio"] >= min_ratio)
    base = F.transform("base", lambda s: F.struct(*(s[f].alias(f) for f in ("start", "rank", "kind", "stop", "value")), F.lit(None).cast("double").alias("ratio")))
    return rows.select("row.*", F.array_sort(F.concat(base, added)).alias(out))


def q_op6_secrets(spark, sf_dir) -> DataFrame:
    """Secrets of every document: counts, digest of the base spans and all spans."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_secrets(docs, train(training_samples(docs))).select("doc_id", "spans")
    return found.select(
        "doc_id",
        *(count_of("spans", k).alias(f"n_{k}") for k in BASE),
        F.sha2(joined("spans", BASE), 256).alias("base_sha256"),
        joined("spans").alias("spans"),
    )
