"""DuckDB SQL twins of the registered queries (the differential-test oracle).

Each string runs on DuckDB with the driver's tables registered as views. The SQL is a direct,
unoptimised statement of each operator's definition (nested loops, full scans), so it is an
independent check of the Spark plans, which are written for scale instead. Fragments are
composed as CTEs; every computed column is aliased to the Spark column name.
"""

from __future__ import annotations

TOKEN = r"'[\p{L}\p{N}_]+'"
K1, B = 1.2, 0.75
DIM = 64


def tok(x: str) -> str:
    return f"regexp_extract_all(lower({x}), {TOKEN}, 0)"


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes if c.strip()) + "\n"


# ---- lexical ---------------------------------------------------------------------------
LEX = f"""
d_tok AS (SELECT doc_id, {tok('text')} AS toks FROM documents),
doc_stats AS (SELECT doc_id, len(toks)::INT AS dl FROM d_tok),
corpus_stats AS (SELECT count(*) AS n, coalesce(sum(dl), 0)::BIGINT AS total_dl,
                 CASE WHEN count(*) > 0 THEN sum(dl) / count(*) ELSE 0.0 END AS avgdl FROM doc_stats),
post0 AS (SELECT doc_id, term, count(*)::INT AS tf FROM (SELECT doc_id, unnest(toks) AS term FROM d_tok) GROUP BY ALL),
postings AS (SELECT p.doc_id, p.term, p.tf, s.dl FROM post0 p JOIN doc_stats s USING (doc_id)),
term_stats AS (SELECT term, count(*) AS df FROM postings GROUP BY term)
"""

QUERIES = "queries AS (SELECT item_id AS qid, text FROM benchmark)"


def bm25_scores(name: str = "bm25_scores", k1: float = K1, b: float = B, queries: str = "queries") -> str:
    return f"""
{name}_qt AS (SELECT DISTINCT qid, unnest({tok('text')}) AS term FROM {queries}),
{name} AS (
  SELECT qt.qid, p.doc_id,
         sum(ln(1 + (cs.n - ts.df + 0.5) / (ts.df + 0.5)) * (p.tf * ({k1} + 1)) /
             (p.tf + {k1} * (1 - {b} + {b} * p.dl / cs.avgdl))) AS score
  FROM {name}_qt qt JOIN term_stats ts USING (term) JOIN postings p USING (term) CROSS JOIN corpus_stats cs
  GROUP BY ALL)
"""


def topk(name: str, src: str, k: int, score: str = "score", asc: bool = False, by: str = "qid") -> str:
    direction = "ASC" if asc else "DESC"
    return f"""
{name} AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY {by} ORDER BY round({score}, 9) {direction}, doc_id) AS rank FROM {src})
  WHERE rank <= {k})
"""


def bm25_run(name: str, k: int) -> str:
    return bm25_scores(f"{name}_s") + "," + topk(f"{name}_t", f"{name}_s", k) + f""",
{name} AS (SELECT qid, doc_id, round(score, 9) AS score, rank FROM {name}_t)"""


# ---- dense -------------------------------------------------------------------------------
def hash_vectors(name: str, src: str, id_col: str) -> str:
    """Long-form normalised hashed vectors ``(id, bucket, weight)`` (non-zero buckets)."""
    return f"""
{name}_tf AS (SELECT {id_col} AS id, term, count(*) AS tf FROM (SELECT {id_col}, unnest({tok('text')}) AS term FROM {src}) GROUP BY ALL),
{name}_b AS (
  SELECT id, (('0x' || substr(md5(term), 1, 8))::BIGINT % {DIM})::INT AS bucket,
         sum(CASE WHEN substr(md5(term), 9, 1) IN ('0','1','2','3','4','5','6','7') THEN 1 ELSE -1 END * tf)::DOUBLE AS w
  FROM {name}_tf GROUP BY ALL),
{name}_n AS (SELECT id, sqrt(sum(w * w)) AS nrm FROM {name}_b GROUP BY id),
{name} AS (SELECT id, bucket, CASE WHEN nrm > 0 THEN w / nrm ELSE 0.0 END AS weight FROM {name}_b JOIN {name}_n USING (id))
"""


def hash_dense_run(name: str, k: int) -> str:
    """Exact squared-L2 top-k between hashed query and document vectors (sparse long form)."""
    return (
        hash_vectors(f"{name}_dv", "documents", "doc_id")
        + ","
        + hash_vectors(f"{name}_qv", "benchmark", "item_id")
        + f""",
{name}_dn AS (SELECT id AS doc_id, sum(weight * weight) AS nn FROM {name}_dv GROUP BY id),
{name}_alld AS (SELECT doc_id, coalesce(nn, 0.0) AS nn FROM documents LEFT JOIN {name}_dn USING (doc_id)),
{name}_qn AS (SELECT id AS qid, sum(weight * weight) AS nn FROM {name}_qv GROUP BY id),
{name}_allq AS (SELECT item_id AS qid, coalesce(nn, 0.0) AS nn FROM benchmark LEFT JOIN {name}_qn ON item_id = qid),
{name}_dot AS (
  SELECT q.id AS qid, d.id AS doc_id, sum(q.weight * d.weight) AS dot
  FROM {name}_qv q JOIN {name}_dv d USING (bucket) GROUP BY ALL),
{name}_dist AS (
  SELECT q.qid, d.doc_id, greatest(q.nn + d.nn - 2 * coalesce(x.dot, 0.0), 0.0) AS distance
  FROM {name}_allq q CROSS JOIN {name}_alld d LEFT JOIN {name}_dot x ON x.qid = q.qid AND x.doc_id = d.doc_id)
"""
        + ","
        + topk(f"{name}_t", f"{name}_dist", k, "distance", asc=True)
        + f""",
{name} AS (SELECT qid, doc_id, round(distance, 9) AS distance, rank FROM {name}_t)"""
    )


def vec_knn_run(name: str, k: int) -> str:
    return f"""
{name}_d AS (
  SELECT q.vec_id AS qid, d.vec_id AS doc_id,
         list_sum(list_transform(list_zip(q.embedding, d.embedding), lambda x: (x[1]::DOUBLE - x[2]::DOUBLE) ** 2)) AS distance
  FROM embeddings q CROSS JOIN embeddings d WHERE q.vec_id % 50 = 0)
,""" + topk(f"{name}_t", f"{name}_d", k, "distance", asc=True) + f""",
{name} AS (SELECT qid, doc_id, round(distance, 9) AS distance, rank FROM {name}_t)"""


# ---- fusion ------------------------------------------------------------------------------
def fuse(name: str, lex: str, den: str, alpha: float, k: int, method: str) -> str:
    if method == "rrf":
        a = f"SELECT qid, doc_id, 1.0 / (rank - 1 + 60) AS norm FROM {lex}"
        b = f"SELECT qid, doc_id, 1.0 / (rank - 1 + 60) AS norm FROM {den}"
    else:
        a = f"""SELECT qid, doc_id, CASE WHEN max(round(score, 9)) OVER w = min(round(score, 9)) OVER w THEN 1.0
                ELSE (round(score, 9) - min(round(score, 9)) OVER w) / (max(round(score, 9)) OVER w - min(round(score, 9)) OVER w) END AS norm
                FROM {lex} WINDOW w AS (PARTITION BY qid)"""
        b = f"""SELECT qid, doc_id, CASE WHEN max(round(distance, 9)) OVER w = min(round(distance, 9)) OVER w THEN 1.0
                ELSE (max(round(distance, 9)) OVER w - round(distance, 9)) / (max(round(distance, 9)) OVER w - min(round(distance, 9)) OVER w) END AS norm
                FROM {den} WINDOW w AS (PARTITION BY qid)"""
    return f"""
{name}_a AS ({a}),
{name}_b AS ({b}),
{name}_f AS (
  SELECT coalesce(a.qid, b.qid) AS qid, coalesce(a.doc_id, b.doc_id) AS doc_id,
         {alpha} * coalesce(a.norm, 0.0) + (1.0 - {alpha}) * coalesce(b.norm, 0.0) AS score
  FROM {name}_a a FULL OUTER JOIN {name}_b b ON a.qid = b.qid AND a.doc_id = b.doc_id)
,""" + topk(f"{name}_t", f"{name}_f", k) + f""",
{name} AS (SELECT qid, doc_id, round(score, 9) AS score, rank FROM {name}_t)"""


# ---- evaluation --------------------------------------------------------------------------
TEXT_QRELS = """
qrels AS (SELECT b.item_id AS qid, d.doc_id, 1 AS rel FROM documents d JOIN benchmark b ON contains(d.text, b.text))
"""


def per_query(name: str, run: str, qrels: str = "qrels", system: str | None = None, k_ndcg=10, k_mrr=10, k_recall=100) -> str:
    sys_col = f"'{system}' AS system, " if system else ""
    return f"""
{name}_rel AS (SELECT DISTINCT qid, doc_id FROM {qrels} WHERE rel > 0),
{name}_j AS (SELECT qid, count(*) AS n_rel FROM {name}_rel GROUP BY qid),
{name}_h AS (
  SELECT r.qid, r.rank, j.n_rel, (x.doc_id IS NOT NULL) AS hit
  FROM {run} r JOIN {name}_j j USING (qid) LEFT JOIN {name}_rel x ON x.qid = r.qid AND x.doc_id = r.doc_id),
{name}_a AS (
  SELECT qid, n_rel,
         sum(CASE WHEN hit AND rank <= {k_ndcg} THEN 1.0 / log2(rank + 1) ELSE 0.0 END) AS dcg,
         count(CASE WHEN hit AND rank <= {k_ndcg} THEN 1 END) AS h,
         min(CASE WHEN hit AND rank <= {k_mrr} THEN rank END) AS first_hit,
         count(CASE WHEN hit AND rank <= {k_recall} THEN 1 END) AS rh
  FROM {name}_h GROUP BY qid, n_rel),
{name} AS (
  SELECT {sys_col}qid,
         CASE WHEN h > 0 THEN dcg / list_sum(list_transform(range(1, h + 1), lambda j: 1.0 / log2(j + 1))) ELSE 0.0 END AS ndcg,
         coalesce(1.0 / first_hit, 0.0) AS mrr,
         rh / n_rel AS recall
  FROM {name}_a)
"""


def macro(name: str, per_query_cte: str, qrels: str = "qrels", group: str = "system") -> str:
    return f"""
{name}_n AS (SELECT count(DISTINCT qid) AS n FROM {qrels} WHERE rel > 0),
{name} AS (
  SELECT {group}, coalesce(sum(ndcg) / nullif(n, 0), 0.0) AS ndcg, coalesce(sum(mrr) / nullif(n, 0), 0.0) AS mrr,
         coalesce(sum(recall) / nullif(n, 0), 0.0) AS recall, n AS n_queries
  FROM {per_query_cte} CROSS JOIN {name}_n GROUP BY {group}, n)
"""


def r6(cols: list[str]) -> str:
    return ", ".join(f"round({c}, 6) AS {c}" for c in cols)


def per_query_grouped(name: str, run: str, grp: list[str], qrels: str = "qrels", k_ndcg=10, k_mrr=10, k_recall=100) -> str:
    """Per-query metrics of a run carrying extra grouping columns (alpha, k1, b, ...)."""
    g = ", ".join(grp)
    rg = ", ".join(f"r.{c}" for c in grp)
    return f"""
{name}_rel AS (SELECT DISTINCT qid, doc_id FROM {qrels} WHERE rel > 0),
{name}_j AS (SELECT qid, count(*) AS n_rel FROM {name}_rel GROUP BY qid),
{name}_h AS (
  SELECT {rg}, r.qid, r.rank, j.n_rel, (x.doc_id IS NOT NULL) AS hit
  FROM {run} r JOIN {name}_j j USING (qid) LEFT JOIN {name}_rel x ON x.qid = r.qid AND x.doc_id = r.doc_id),
{name}_a AS (
  SELECT {g}, qid, n_rel,
         sum(CASE WHEN hit AND rank <= {k_ndcg} THEN 1.0 / log2(rank + 1) ELSE 0.0 END) AS dcg,
         count(CASE WHEN hit AND rank <= {k_ndcg} THEN 1 END) AS h,
         min(CASE WHEN hit AND rank <= {k_mrr} THEN rank END) AS first_hit,
         count(CASE WHEN hit AND rank <= {k_recall} THEN 1 END) AS rh
  FROM {name}_h GROUP BY {g}, qid, n_rel),
{name} AS (
  SELECT {g}, qid,
         CASE WHEN h > 0 THEN dcg / list_sum(list_transform(range(1, h + 1), lambda j: 1.0 / log2(j + 1))) ELSE 0.0 END AS ndcg,
         coalesce(1.0 / first_hit, 0.0) AS mrr,
         rh / n_rel AS recall
  FROM {name}_a)
"""


def best_marked(name: str, src: str, keys: list[str]) -> str:
    """Flag the first maximum of the raw nDCG (ties: smallest keys), then round to 6 places."""
    k = ", ".join(keys)
    return f"""
{name}_r AS (SELECT *, (row_number() OVER (ORDER BY round(ndcg, 9) DESC, {k}) = 1) AS is_best FROM {src}),
{name} AS (SELECT {k}, round(ndcg, 6) AS ndcg, round(mrr, 6) AS mrr, round(recall, 6) AS recall, is_best FROM {name}_r)
"""


def latency_sql() -> str:
    return """SELECT event_type AS system, round(avg(value), 6) AS mean_ms, round(quantile_cont(value, 0.5), 6) AS median_ms,
       round(quantile_cont(value, 0.95), 6) AS p95_ms, round(quantile_cont(value, 0.99), 6) AS p99_ms,
       round(1000.0 / avg(value), 6) AS qps
FROM events WHERE value IS NOT NULL GROUP BY event_type"""


def snippet_sql(col: str = "text") -> str:
    return f"CASE WHEN length({col}) <= 200 THEN {col} ELSE regexp_replace(substring({col}, 1, 200), ' [^ ]*$', '') || '...' END"


def first3(list_expr: str) -> str:
    return f"array_to_string(list_sort({list_expr})[1:3], ', ')"
