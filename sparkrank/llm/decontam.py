"""Benchmark decontamination: a prefix-filtered set join, DataFrame operations only.

A benchmark item is cut into windows of ``WINDOW_WORDS`` consecutive words (a shorter item is
one window). A window is the set of its positioned word shingles. The documents' shingles are
matched with the benchmark's shingles once; the matches carry the document's length and the
position. Shingles are ordered by rarity over all documents, and each window is looked up by
its necessary prefix alone: containment asks for every shingle, so the prefix is the single
rarest one, and a window with a shingle that no document has is dropped. The offset of the
prefix shingle fixes where the window would start (positional bound), it must fit into the
document (length bound), and the candidate is verified by the presence of each of its shingles
at its position, which is equality word by word.

The text is read once and never shuffled: only matches travel. The benchmark's shingles are
broadcast when their measured size is below ``MAX_BROADCAST_BYTES`` and are joined by a shuffle
otherwise. A passage that very many documents hold costs rows in proportion to its occurrences.

Edge cases: a null or word-less document has no words and is clean; a null, empty or word-less
item has no window; items of one or two words are windows of that length; repeated document
rows each get the result; repeated items and items with equal windows are all named; an item
without an id marks words and is named by the empty string; rows are told apart by id and text
hash, so a null ``doc_id`` is allowed; empty tables give empty or clean results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, table

WINDOW_WORDS = 13
SHINGLE_WORDS = 4
MAX_BROADCAST_BYTES = 32 << 20
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_NOT_A_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: str) -> Column:
    """The words of a text: runs of ASCII letters (lower-cased), digits and non-ASCII."""
    lowered = F.translate(F.coalesce(F.col(text), F.lit("")), _UPPER, _LOWER)
    return F.filter(F.split(lowered, _NOT_A_WORD), lambda w: w != "")


def shingles(words_col: str, width: int) -> Column:
    """All ``width``-word shingles in order, space-joined; trailing nulls fill the array."""
    out = F.col(words_col)
    for k in range(1, width):
        rest = F.slice(F.col(words_col), k + 1, F.greatest(F.size(words_col) - k, F.lit(0)))
        out = F.zip_with(out, rest, lambda a, b: F.concat(a, F.lit(" "), b))
    return out


def _numbered(df: DataFrame, name: str, number: str) -> DataFrame:
    # Numbers are given once and written, so a later retry sees the same ones.
    return cut(df.withColumn(number, F.monotonically_increasing_id()), name)


def _hinted(df: DataFrame, size_of: str) -> DataFrame:
    n = df.agg(F.sum(F.octet_length(size_of) + 48)).first()[0] or 0
    return F.broadcast(df) if n <= MAX_BROADCAST_BYTES else df


def _benchmark(items: DataFrame, item_id: str, item_text: str, window: int, width: int):
    rows = items.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item_id"), words(item_text).alias("w")).where("size(w) > 0")
    cuts = F.transform(F.sequence(F.lit(1), F.greatest(F.size("w") - window + 1, F.lit(1))), lambda i: F.slice(F.col("w"), i, window))
    named = rows.select("item_id", F.explode(cuts).alias("w")).select("item_id", F.array_join("w", " ").alias("window")).distinct()
    named = cut(named, "windows")
    wins = _numbered(named.select("window").distinct(), "window-ids", "win_id")
    win_items = cut(named.join(wins, "window").select("win_id", "item_id"), "window-items")
    split = wins.select("win_id", F.split("window", " ").alias("w"))
    split = split.withColumn("len", F.size("w")).withColumn("width", F.least("len", F.lit(width)))
    parts = None
    for k in range(1, width + 1):
        own = split.where(F.col("width") == k).select("win_id", "len", F.lit(k).alias("width"), F.posexplode(shingles("w", k)).alias("off", "shingle"))
        parts = own if parts is None else parts.unionByName(own)
    parts = cut(parts.where("shingle is not null"), "window-shingles")
    ids = _numbered(parts.select("shingle").distinct(), "shingle-ids", "tok")
    return win_items, cut(parts.join(ids, "shingle").drop("shingle"), "window-tokens"), ids


def contamination(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW_WORDS,
    width: int = SHINGLE_WORDS,
) -> DataFrame:
    """``(doc_id, h, n_words, n_hit, items)``: one row per document row; ``h`` is the hash of
    the text, ``n_hit`` the number of words inside window occurrences and ``items`` the sorted
    ids, as strings, of the items whose windows occur."""
    win_items, win_toks, ids = _benchmark(items, item_id, item_text, window, min(width, window))
    widths = sorted(r[0] for r in win_toks.select("width").distinct().collect())  # at most ``width`` values
    key = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.col(text_col)).alias("h"), words(text_col).alias("w"))
    key = key.withColumn("n_words", F.size("w"))
    # One row at position -1 stands for the document itself; it joins with the token -1.
    lists = [F.transform(shingles("w", k), lambda s, i: F.struct(i.alias("pos"), s.alias("shingle"))) for k in widths]
    own = F.array(F.struct(F.lit(-1).alias("pos"), F.lit("").alias("shingle")))
    every = key.select("doc_id", "h", "n_words", F.explode_outer(F.concat(own, *lists)).alias("s")).select("doc_id", "h", "n_words", "s.*")
    itself = ids.sparkSession.range(1).select(F.lit("").alias("shingle"), F.lit(-1).cast("long").alias("tok"))
    wanted = ids.unionByName(itself)
    found = cut(every.join(_hinted(wanted, "shingle"), "shingle").drop("shingle"), "matches")

    hits = found.where("pos >= 0")
    rarity = hits.groupBy("tok").agg(F.count("*").alias("freq"))
    prefix = (
        win_toks.join(rarity, "tok", "left")
        .groupBy("win_id", "len")
        .agg(F.min(F.coalesce("freq", F.lit(0))).alias("least"), F.min(F.struct("freq", "tok", "off")).alias("p"))
        .where("least > 0")
        .select("win_id", "len", F.col("p.tok").alias("tok"), F.col("p.off").alias("off"))
    )
    prefix = cut(prefix, "prefixes")
    candidates = (
        hits.join(prefix, "tok")
        .where("pos >= off and pos - off + len <= n_words")
        .select("doc_id", "h", "win_id", "len", (F.col("pos") - F.col("off")).alias("start"))
        .distinct()
    )
    asked = candidates.join(win_toks.select("win_id", "tok", "off", "width"), "win_id").withColumn("pos", F.col("start") + F.col("off"))
    asked, seen = asked.alias("a"), hits.select("doc_id", "h", "pos", "tok").distinct().alias("m")
    same = F.expr("a.doc_id <=> m.doc_id and a.h = m.h and a.pos = m.pos and a.tok = m.tok")
    occurs = (
        asked.join(seen, same, "left_semi")
        .groupBy("doc_id", "h", "win_id", "len", "width", "start")
        .agg(F.count("*").alias("n"))
        .where("n = len - width + 1")
        .select("doc_id", "h", "win_id", "start", (F.col("start") + F.col("len")).alias("stop"))
    )
    occurs = cut(occurs, "occurrences")
    before = "coalesce(max(stop) over (partition by doc_id, h order by start, stop rows between unbounded preceding and 1 preceding), 0)"
    spans = occurs.select("doc_id", "h", "start", "stop").distinct()
    covered = (
        spans.withColumn("seen", F.expr(before))
        .groupBy("doc_id", "h")
        .agg(F.sum(F.greatest(F.lit(0), F.col("stop") - F.greatest("start", "seen"))).alias("n_hit"))
    )
    named = (
        occurs.select("doc_id", "h", "win_id").distinct().join(win_items, "win_id")
        .select("doc_id", "h", "item_id").distinct()
        .groupBy("doc_id", "h").agg(F.array_sort(F.collect_list("item_id")).alias("items"))
    )
    result = covered.alias("c").join(named.alias("n"), F.expr("c.doc_id <=> n.doc_id and c.h = n.h")).select("c.*", "n.items")
    d, r = found.where("pos < 0").alias("d"), result.alias("r")
    return d.join(r, F.expr("d.doc_id <=> r.doc_id and d.h = r.h"), "left").select(
        "d.doc_id",
        "d.h",
        F.col("d.n_words").cast("long").alias("n_words"),
        F.coalesce("r.n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("r.items", F.array().cast("array<string>")).alias("items"),
    )


def contaminated() -> Column:
    """The rule: some word is hit, and at least one word in twenty."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def q_op9_decontamination(spark, sf_dir) -> DataFrame:
    """Contamination of every document by the windows of every benchmark item."""
    out = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        contaminated().alias("contaminated"),
    )


#: Windows are joined with the documents' runs of as many words, starting anywhere.
ORACLE_OP9 = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w
  FROM documents),
items AS (
  SELECT coalesce(item_id::VARCHAR, '') AS item_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w
  FROM benchmark),
wins AS (
  SELECT DISTINCT item_id, array_to_string(list_slice(w, i, i + 12), ' ') AS win, least(len(w), 13) AS n
  FROM (SELECT item_id, w, unnest(generate_series(1, greatest(len(w) - 12, 1))) AS i FROM items WHERE len(w) > 0)),
lens AS (SELECT DISTINCT n FROM wins),
runs AS (
  SELECT r, i, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS win
  FROM (SELECT r, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM docs, lens WHERE len(w) >= n)),
occ AS (SELECT runs.r, runs.i, runs.n, wins.item_id FROM runs JOIN wins USING (win, n)),
hit AS (
  SELECT r, count(DISTINCT p) AS n_hit
  FROM (SELECT r, unnest(generate_series(i, i + n - 1)) AS p FROM (SELECT DISTINCT r, i, n FROM occ)) GROUP BY r),
named AS (SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT r, item_id FROM occ) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN hit USING (r) LEFT JOIN named USING (r)
"""
