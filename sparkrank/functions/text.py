"""Scalar text functions (column expressions only; everything stays JVM-side and codegen'd).

T1 tokenize, T2 document length, T3 per-document term frequencies, T4 snippet,
T5 score rounding, T7 blank-query test, T8 id-list display.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: a token is a maximal run of Unicode letters, digits and underscore after
# lower-casing (the same class both Spark's Java regex and DuckDB's RE2 accept).
TOKEN_PATTERN = r"[\p{L}\p{N}_]+"
SEPARATOR_PATTERN = r"[^\p{L}\p{N}_]+"

# Fixed values of the response format.
SNIPPET_CHARS = 200
SNIPPET_ELLIPSIS = "..."
DISPLAY_DECIMALS = 4

# Ranking scores are quantised to this many decimals before ordering (engine-independent ties).
RANK_DECIMALS = 9
# Scores are emitted with this many decimals for stable comparison across engines.
OUTPUT_DECIMALS = 6


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tokenize(text) -> Column:
    """Lower-case, then every run of letters/digits/underscore, in order (duplicates kept).

    Written as a split on separator runs minus the empty edge pieces: the same tokens as
    extracting every TOKEN_PATTERN match, about twice as fast. A null text has no tokens.
    """
    lowered = F.lower(F.coalesce(_col(text), F.lit("")))
    return F.array_remove(F.split(lowered, SEPARATOR_PATTERN), "")


def doc_length(tokens) -> Column:
    """Number of tokens (0 for an empty or punctuation-only text)."""
    return F.size(_col(tokens))


def with_term_frequencies(df, tokens: str = "tokens", out: str = "tfs"):
    """Add ``out`` = ``array<struct<term, tf>>`` of the distinct terms of each row's tokens,
    sorted by term.

    Computed inside the row (sort, then run lengths), so building postings needs no shuffle:
    every posting of a document is produced by the task that read the document. Built in
    steps so the sorted array and the run starts are evaluated once per row.
    """
    s, st = F.col("__sorted"), F.col("__starts")
    # Each step of a lambda is interpreted, so there are few; what is no start is removed natively.
    starts = F.array_remove(F.transform(s, lambda x, i: F.when(x.eqNullSafe(F.get(s, i - 1)), F.lit(-1)).otherwise(i)), -1)
    pairs = F.transform(
        st,
        lambda a, j: F.struct(F.get(s, a).alias("term"), (F.coalesce(F.get(st, j + 1), F.size(s)) - a).alias("tf")),
    )
    return (
        df.withColumn("__sorted", F.sort_array(F.col(tokens)))  # natively; array_sort compares by a lambda
        .withColumn("__starts", starts)
        .withColumn(out, pairs)
        .drop("__sorted", "__starts")
    )


def snippet(text, max_chars: int = SNIPPET_CHARS) -> Column:
    """T4: the text if short enough, else its first ``max_chars`` characters cut back to the
    last space, plus an ellipsis (no space: all ``max_chars`` characters)."""
    t = _col(text)
    head = F.substring(t, 1, max_chars)
    cut = F.regexp_replace(head, r" [^ ]*\z", "")
    return F.when(F.length(t) <= max_chars, t).otherwise(F.concat(cut, F.lit(SNIPPET_ELLIPSIS)))


def display_score(score, decimals: int = DISPLAY_DECIMALS) -> Column:
    """T5: score rounded for display."""
    return F.round(_col(score), decimals)


def is_blank(text) -> Column:
    """A query that is empty after trimming whitespace (or null)."""
    t = _col(text)
    return t.isNull() | (F.length(F.regexp_replace(t, r"(?U)^\s+|\s+$", "")) == 0)


def join_first_ids(ids, n: int = 3, sep: str = ", ") -> Column:
    """The first ``n`` ids (in sorted order, for determinism) joined for display."""
    return F.array_join(F.slice(F.array_sort(_col(ids)).cast("array<string>"), 1, n), sep)


def rank_key(score) -> Column:
    """Quantised score used for ordering (see RANK_DECIMALS)."""
    return F.round(_col(score), RANK_DECIMALS)


def out_score(score) -> Column:
    return F.round(_col(score), OUTPUT_DECIMALS)
