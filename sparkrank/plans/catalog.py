"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator of the
inventory, over the driver's tables (role mapping in FIXTURES.md), and their DuckDB twins.

Every query reads whole tables; nothing is sampled or capped except where a limit is the
operator itself (top-k lists, "first n queries", a corpus target size).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import display_score, is_blank, out_score, snippet, tokenize
from ..operators import dense as D
from ..operators import evaluate as E
from ..operators import corpus as P
from ..operators import fusion as FU
from ..operators.lexical import LexicalIndex
from ..operators.ivf import IVFIndex
from ..session import scratch_path, with_text, written
from ..sources import collections as C
from ..sources import files as FS
from ..sources import index_store as IS
from ..sources.document_store import DocumentStore
from ..sources.formats import Field, read_collection, write_lines
from ..sources.segment_store import SegmentStore
from ..streaming.indexing import stream_index, stream_responses, stream_search, stream_segments
from . import search as S
from . import experiments as X
from . import oracle as O

TOPK = 10
DEPTH = 100  # E5: max(k_ndcg=10, k_mrr=10, k_recall=100)


# ---- shared building blocks ---------------------------------------------------------------
def lexical_index(spark: SparkSession, sf: str) -> LexicalIndex:
    # Persisted: runs, qrels and statistics of one query share a single tokenisation.
    return LexicalIndex.build(C.corpus(spark, sf), persist=True)


def text_qrels(spark: SparkSession, sf: str, idx: LexicalIndex | None = None) -> DataFrame:
    idx = idx or lexical_index(spark, sf)
    return C.text_qrels(C.corpus(spark, sf), C.queries(spark, sf), idx.postings, idx.term_stats)


def saved_index(spark: SparkSession, sf: str) -> LexicalIndex:
    """The index written and opened again: runs, judgments and grids read files, not a cache."""
    corpus = C.corpus(spark, sf)
    return saved(corpus, LexicalIndex.build(corpus))


def block_index(spark: SparkSession, sf: str) -> LexicalIndex:
    """The documents' terms written in buckets, searched in blocks; nothing is cached."""
    corpus = C.corpus(spark, sf)
    return IS.write_documents(corpus, scratch_path(spark, "documents-terms"), buckets_of(corpus))


def buckets_of(corpus: DataFrame) -> int:
    return IS.buckets_for(corpus.count(), int(corpus.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def saved(corpus: DataFrame, index: LexicalIndex) -> LexicalIndex:
    spark = corpus.sparkSession
    path = scratch_path(spark, "lexical")
    IS.save_lexical(index, path, buckets=buckets_of(corpus))
    return IS.load_lexical(spark, path)


def judgments(spark: SparkSession, sf: str, idx: LexicalIndex) -> DataFrame:
    """The text judgments, found once and written."""
    return written(text_qrels(spark, sf, idx), "text-qrels")


def bm25_run(spark: SparkSession, sf: str, k: int, idx: LexicalIndex | None = None) -> DataFrame:
    idx = idx or lexical_index(spark, sf)
    return idx.search(C.queries(spark, sf), k=k)


def dense_text_run(spark: SparkSession, sf: str, k: int) -> DataFrame:
    # k-NN reads the vectors once, so they are encoded in its own scan.
    dv = D.hash_encode(C.corpus(spark, sf), "doc_id")
    qv = D.hash_encode(C.queries(spark, sf), "qid")
    return D.knn(dv, qv, k)


#: Documents in one file of a stream's input, about.
DOCS_PER_FILE = 20_000


def arriving(docs: DataFrame, path: str, batches: int) -> int:
    """``docs`` written as a stream's input files, as many for each of ``batches`` as their number
    asks for; returns the files of a batch."""
    each = max(1, -(-docs.count() // (batches * DOCS_PER_FILE)))
    docs.repartition(batches * each).write.parquet(path)
    return each


def shown(run: DataFrame, *cols: str) -> DataFrame:
    """Rounded to the output precision; everything before works on ranking precision."""
    return run.select(*(out_score(c).alias(c) if c in cols else c for c in run.columns))


# ---- T1-T3, B1-B5 ------------------------------------------------------------------------
def q_tokenize_stats(spark, sf):
    toks = C.corpus(spark, sf).select("doc_id", tokenize("text").alias("t"))
    return toks.select("doc_id", F.size("t").alias("dl"), F.size(F.array_distinct("t")).alias("n_terms"))


def q_postings(spark, sf):
    return lexical_index(spark, sf).postings


def q_term_stats(spark, sf):
    return lexical_index(spark, sf).term_stats


def q_corpus_stats(spark, sf):
    return lexical_index(spark, sf).corpus_stats.select("n", "total_dl", out_score("avgdl").alias("avgdl"))


def q_bm25_idf(spark, sf):
    return lexical_index(spark, sf).idf().select("term", out_score("idf").alias("idf"))


def q_bm25_topk(spark, sf):
    return shown(bm25_run(spark, sf, TOPK), "score")


def q_text_qrels(spark, sf):
    return text_qrels(spark, sf)


# ---- D1-D4, D6, D7 -----------------------------------------------------------------------
def q_hash_encode(spark, sf):
    v = D.hash_encode(C.corpus(spark, sf), "doc_id")
    return (
        v.select("doc_id", F.posexplode_outer("embedding").alias("bucket", "weight"))
        .filter(F.col("weight").isNotNull() & (F.col("weight") != 0))
        .select("doc_id", F.col("bucket").cast("int").alias("bucket"), out_score("weight").alias("weight"))
    )


def letter_model():
    """A deterministic model: how often each letter of a to z occurs in a text."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    return lambda texts: [[t.count(c) for c in letters] for t in texts]


def q_model_encode(spark, sf):
    """An external model's vectors (here a deterministic stand-in), float32, one model a worker."""
    v = D.predict_encode(C.corpus(spark, sf), letter_model)
    cells = v.select("doc_id", F.posexplode_outer("embedding").alias("bucket", "weight"))
    return cells.where("weight != 0").select("doc_id", "bucket", F.col("weight").cast("double").alias("weight"))


def q_knn_l2_topk(spark, sf):
    return shown(D.knn(C.vectors(spark, sf), C.vector_queries(spark, sf), TOPK), "distance")


def q_dense_text_topk(spark, sf):
    return shown(dense_text_run(spark, sf, TOPK), "distance")


def q_dense_summary(spark, sf):
    return D.summary(D.valid_vectors(C.vectors(spark, sf)))


# ---- F1-F5 --------------------------------------------------------------------------------
def two_runs(spark, sf):
    """The two runs to fuse, written one after the other: their Python workers do not add up."""
    return written(bm25_run(spark, sf, TOPK, block_index(spark, sf)), "run-bm25"), written(dense_text_run(spark, sf, TOPK), "run-dense")


def q_fuse_rrf_weighted(spark, sf):
    return shown(FU.hybrid(*two_runs(spark, sf), alpha=0.5, k=TOPK, method="rrf"), "score")


def q_fuse_minmax(spark, sf):
    return shown(FU.hybrid(*two_runs(spark, sf), alpha=0.3, k=TOPK, method="min_max"), "score")


def q_rrf(spark, sf):
    return shown(FU.rrf([*two_runs(spark, sf)], k=TOPK), "score")


# ---- E1-E6 -------------------------------------------------------------------------------
def q_eval_per_query(spark, sf):
    runs, qrels = text_runs(spark, sf, DEPTH)
    pq = E.per_query(X.runs_union(runs), qrels, C.queries(spark, sf))
    return pq.select("system", "qid", *[out_score(c).alias(c) for c in ("ndcg", "mrr", "recall")])


def q_eval_macro(spark, sf):
    runs, qrels = text_runs(spark, sf, DEPTH)
    m = E.macro(X.runs_union(runs), qrels, C.queries(spark, sf))
    return m.select("system", *[out_score(c).alias(c) for c in ("ndcg", "mrr", "recall")], "n_queries")


# ---- X1-X6, X9 ------------------------------------------------------------------------------
def text_runs(spark, sf, k: int, alpha: float = 0.5, method: str = "rrf", idx: LexicalIndex | None = None, judged: bool = True):
    """The three systems' runs and the judgments, each written once: experiments read them several
    times over."""
    idx = idx or saved_index(spark, sf)
    bm25 = written(bm25_run(spark, sf, k, idx), "run-bm25")
    dense = written(dense_text_run(spark, sf, k), "run-dense")
    qrels = judgments(spark, sf, idx) if judged else None
    hybrid = written(FU.hybrid(bm25, dense, alpha=alpha, k=k, method=method), "run-hybrid")
    return {"bm25": bm25, "dense": dense, "hybrid": hybrid}, qrels


def q_baseline_comparison(spark, sf):
    runs, qrels = text_runs(spark, sf, DEPTH)
    return X.baseline(runs, qrels, C.queries(spark, sf))


def q_alpha_sweep(spark, sf):
    runs, qrels = text_runs(spark, sf, DEPTH)
    return X.alpha_sweep(runs["bm25"], runs["dense"], qrels, C.queries(spark, sf), k=DEPTH)


def q_bm25_grid(spark, sf):
    idx = saved_index(spark, sf)
    return X.bm25_grid(idx, judgments(spark, sf, idx), C.queries(spark, sf), k=DEPTH)


def q_latency_summary(spark, sf):
    return X.latency_summary(C.latency(spark, sf))


def q_failure_analysis(spark, sf):
    runs, qrels = text_runs(spark, sf, TOPK)
    return X.failure_analysis(runs, qrels, C.queries(spark, sf))


def q_disagreements(spark, sf):
    runs, _ = text_runs(spark, sf, TOPK, judged=False)
    return X.disagreements(runs["bm25"], runs["dense"], runs["hybrid"])


def q_report_summary(spark, sf):
    runs, qrels = text_runs(spark, sf, DEPTH)
    qs = C.queries(spark, sf)
    base = X.baseline(runs, qrels, qs)
    sweep = X.alpha_sweep(runs["bm25"], runs["dense"], qrels, qs, k=DEPTH)
    lat = X.latency_summary(C.latency(spark, sf))
    return X.report_summary(base, sweep, lat)


# ---- T4-T7 -------------------------------------------------------------------------------
def q_snippets(spark, sf):
    qs = C.queries(spark, sf)
    # Written once: the text join reads it three times.
    run = written(block_index(spark, sf).search(qs, k=TOPK, decimals=4), "run-bm25")
    return with_text(run, C.corpus(spark, sf), qs.count(), TOPK).select(
        "qid", "doc_id", "rank", F.col("score").alias("display_score"), snippet("text").alias("snippet")
    )


def q_document_fetch(spark, sf):
    run = bm25_run(spark, sf, TOPK)
    return with_text(run, C.corpus(spark, sf), C.queries(spark, sf).count(), TOPK).select("qid", "doc_id", "text")


def q_document_store_fetch(spark, sf):
    """The corpus is written as a document store, the text of the top-k rows fetched from it by id."""
    store = DocumentStore.write(C.corpus(spark, sf), scratch_path(spark, "documents"))
    return store.fetch(bm25_run(spark, sf, TOPK)).select("qid", "doc_id", "text")


def q_rejected_queries(spark, sf):
    # The given passages hold no blank query: what is left of each without its letters does.
    stripped = C.queries(spark, sf).unionByName(C.queries(spark, sf).select(-F.col("qid") - 1, F.regexp_replace("text", r"\S", "")).toDF("qid", "text"))
    return stripped.filter(is_blank("text")).select("qid", F.lit("Query cannot be empty").alias("reason"))


# ---- P1-P5, S3 ---------------------------------------------------------------------------
PREP_TARGET = 500


def q_relevant_docs(spark, sf):
    return P.relevant_docs(C.prep_qrels(spark, sf))


def q_covered_corpus(spark, sf):
    return P.covered_corpus(C.corpus(spark, sf), C.prep_qrels(spark, sf), PREP_TARGET).select("doc_id")


def q_missing_relevant(spark, sf):
    # Judgments of documents outside the collection: every judged id shifted by the collection's size.
    size = C.corpus(spark, sf).count()
    judged = C.prep_qrels(spark, sf)
    judged = judged.unionByName(judged.withColumn("doc_id", F.col("doc_id") + size))
    return P.missing_relevant(P.covered_corpus(C.corpus(spark, sf), judged, PREP_TARGET), judged)


def q_coverage(spark, sf):
    qrels = C.prep_qrels(spark, sf)
    cov = P.covered_corpus(C.corpus(spark, sf), qrels, PREP_TARGET)
    return P.coverage(cov, qrels, C.queries(spark, sf))


def q_prepared_corpus(spark, sf):
    """The covered corpus is written, its summary observed on the way; one row per
    document read back, with the summary's coverage and grade."""
    path = scratch_path(spark, "prepared")
    summary = P.prepare_corpus(C.corpus(spark, sf), C.prep_qrels(spark, sf), C.queries(spark, sf), PREP_TARGET, path)
    told = [summary.select(c).scalar().alias(c) for c in ("n_corpus", "n_relevant_written", "coverage", "grade")]
    return spark.read.parquet(path).select("doc_id", F.md5("text").alias("digest"), *told)


def q_qrels_filter(spark, sf):
    return E.relevant_pairs(C.prep_qrels(spark, sf))


# ---- S1-S8, X7, X8, D5, B7, R1, R2 -----------------------------------------------------------
def q_io_roundtrip(spark, sf):
    """Write the collection in the reference's formats, read it back."""
    base = scratch_path(spark, "io")
    FS.write_corpus_jsonl(C.corpus(spark, sf), f"{base}/corpus")
    FS.write_queries_tsv(C.queries(spark, sf), f"{base}/queries")
    FS.write_qrels_tsv(C.prep_qrels(spark, sf), f"{base}/qrels")
    corpus = FS.read_corpus_jsonl(spark, f"{base}/corpus", "bigint")
    qs = FS.read_queries_tsv(spark, f"{base}/queries", "bigint")
    qrels = FS.read_qrels_tsv(spark, f"{base}/qrels", "bigint")
    def summ(df, name, *cols):
        text = F.concat_ws("|", *[F.col(c).cast("string") for c in cols])
        part = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")
        return df.agg(F.count(F.lit(1)).alias("n_rows"), F.coalesce(F.sum(part), F.lit(0)).cast("long").alias("digest")).select(F.lit(name).alias("tbl"), "n_rows", "digest")

    return summ(corpus, "corpus", "doc_id", "text").unionByName(summ(qs, "queries", "qid", "text")).unionByName(summ(qrels, "qrels", "qid", "doc_id", "rel"))


def q_collection_formats(spark, sf):
    """The documents as nested JSON, tab-separated and plain lines, each read through a declared
    mapping, beside the Parquet table read through one; one row per document and format."""
    base = scratch_path(spark, "formats")
    docs = C.table(spark, sf, "documents").select("doc_id", "lang", "text")
    docs.select(F.struct(F.col("doc_id").alias("id"), "lang").alias("meta"), F.col("text").alias("body")).write.json(f"{base}/json", compression="gzip")
    write_lines(docs, f"{base}/tsv", compression="gzip")
    write_lines(docs.select("lang", "doc_id", "text"), f"{base}/text", " ", compression="gzip")
    optional = {"lang": Field("lang", required=False), "text": Field("text", required=False)}
    read = {
        "parquet": read_collection(spark, f"{sf.rstrip('/')}/documents.parquet", "parquet", {"doc_id": Field("doc_id", "bigint"), **optional}),
        "json": read_collection(
            spark, f"{base}/json", "json",
            {"doc_id": Field("meta.id", "bigint"), "lang": Field("meta.lang", required=False), "text": Field("body", required=False)},
        ),
        "tsv": read_collection(spark, f"{base}/tsv", "tsv", {"doc_id": Field(0, "bigint"), "lang": Field(1), "text": Field(2)}, escaped=True),
        "text": read_collection(
            spark, f"{base}/text", "text", {"lang": Field(1), "doc_id": Field(2, "bigint"), "text": Field(3)}, pattern=r"^(\S*) (\d+) (.*)$", escaped=True
        ),
    }
    out = None
    for name, rows in read.items():
        given = lambda c: F.coalesce(c, F.lit(""))
        part = rows.select(F.lit(name).alias("format"), "doc_id", given("lang").alias("lang"), F.md5(given("text")).alias("digest"))
        out = part if out is None else out.unionByName(part)
    return out


def q_index_roundtrip(spark, sf):
    """Save the lexical index (doc-bucketed postings), re-attach it, search it."""
    path, corpus = scratch_path(spark, "lexical"), C.corpus(spark, sf)
    IS.save_lexical(LexicalIndex.build(corpus), path, buckets=IS.buckets_for(corpus.count(), 8))
    return shown(IS.load_lexical(spark, path).search(C.queries(spark, sf), k=TOPK), "score")


def q_vector_roundtrip(spark, sf):
    """Save and reload the vector table, then exact k-NN."""
    path = scratch_path(spark, "vectors")
    IS.save_vectors(C.vectors(spark, sf), path)
    return shown(D.knn(IS.load_vectors(spark, path), C.vector_queries(spark, sf), TOPK), "distance")


def q_results_sink(spark, sf):
    """The five experiment tables written as JSON, read back and shown value by value."""
    idx, qs = saved_index(spark, sf), C.queries(spark, sf)
    runs, qrels = text_runs(spark, sf, DEPTH, idx=idx)
    top, _ = text_runs(spark, sf, TOPK, idx=idx, judged=False)
    tables = {
        "exp1_baseline": (X.baseline(runs, qrels, qs), ["system"]),
        "exp2_alpha": (X.alpha_sweep(runs["bm25"], runs["dense"], qrels, qs, k=DEPTH), ["alpha"]),
        "exp3_bm25": (X.bm25_grid(idx, qrels, qs, k=DEPTH), ["k1", "b"]),
        "exp4_latency": (X.latency_summary(C.latency(spark, sf)), ["system"]),
        "exp5_failures": (X.failure_counts(X.failure_analysis(top, qrels, qs)), ["category"]),
    }
    base = scratch_path(spark, "results")
    paths = FS.write_results_json({name: t for name, (t, _) in tables.items()}, base)
    out = None
    for name, (t, keys) in tables.items():
        back = spark.read.schema(t.schema).json(paths[name])
        values = [c for c in t.columns if c not in keys and t.schema[c].dataType.typeName() in ("double", "long")]
        cells = F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in values])
        key = F.concat_ws("/", *[F.format_number(c, 2) if t.schema[c].dataType.typeName() == "double" else F.col(c) for c in keys])
        part = back.select(F.lit(name).alias("tbl"), key.alias("key"), F.inline_outer(cells)).where("metric is not null")
        out = part if out is None else out.unionByName(part)
    return out


def q_selective_build(spark, sf):
    """Lexical-only and dense-only builds."""
    lex = S.build(C.corpus(spark, sf), lexical=True, dense=False)
    den = S.build(C.corpus(spark, sf), lexical=False, dense=True)
    return (
        lex.lexical.postings.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit("postings").alias("component"), "n_rows")
        .unionByName(lex.lexical.doc_stats.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit("doc_stats").alias("component"), "n_rows"))
        .unionByName(den.vectors.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit("vectors").alias("component"), "n_rows"))
    )


def q_search_response(spark, sf):
    """The nested response (three lists with snippets, disagreements), one row per entry."""
    corpus = C.corpus(spark, sf)
    built = S.build(corpus)
    # Its statistics, lengths and postings would each be made from the text again.
    resp, _ = S.search_response(C.queries(spark, sf), corpus, saved(corpus, built.lexical), built.vectors, k=TOPK)
    return response_rows(resp)


def response_rows(resp: DataFrame) -> DataFrame:
    """One row per entry; a list without entries is one row of rank 0, so empty lists are compared too."""
    parts = [
        resp.select("qid", F.lit(name).alias("list"), F.posexplode_outer(f"{name}_results").alias("pos", "e")).select(
            "qid",
            "list",
            F.coalesce(F.col("e.rank").cast("long"), F.lit(0)).alias("rank"),
            F.coalesce(F.col("e.doc_id").cast("string"), F.lit("")).alias("item"),
            F.coalesce("e.score", F.lit(0.0)).alias("score"),
            F.coalesce("e.snippet", F.lit("")).alias("snippet"),
        )
        for name in ("bm25", "dense", "hybrid")
    ]
    said = resp.select("qid", F.lit("disagreements").alias("list"), F.explode_outer("disagreements").alias("e")).select(
        "qid", "list", F.lit(0).cast("long").alias("rank"), F.coalesce("e.type", F.lit("")).alias("item"), F.lit(0.0).alias("score"), F.coalesce("e.docs", F.lit("")).alias("snippet")
    )
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(said)


def q_knn_ivf_topk(spark, sf):
    """IVF over the embeddings, saved and loaded; with all cells probed it is exact."""
    path = scratch_path(spark, "ivf")
    IVFIndex.build(C.vectors(spark, sf)).save(path)
    ivf = IVFIndex.load(spark, path)
    return shown(ivf.search(C.vector_queries(spark, sf), k=TOPK, nprobe=ivf.nlist), "distance")


def q_knn_ivf_recall(spark, sf):
    """Whether probing two cells in three reaches a recall of 0.9 at 10 against exact search
    (the embeddings are close to random directions, the hardest case for cells)."""
    path = scratch_path(spark, "ivf")
    IVFIndex.build(C.vectors(spark, sf)).save(path)  # a cell's vectors lie together
    ivf = IVFIndex.load(spark, path)
    qs = C.vector_queries(spark, sf)
    exact = written(D.knn(C.vectors(spark, sf), qs, TOPK).select("qid", "doc_id"), "exact")
    found = ivf.search(qs, k=TOPK, nprobe=-(-2 * ivf.nlist // 3)).select("qid", "doc_id").join(exact, ["qid", "doc_id"], "left_semi")
    both = exact.select("qid", F.lit(1).alias("e"), F.lit(0).alias("f")).unionByName(found.select("qid", F.lit(0).alias("e"), F.lit(1).alias("f")))
    return both.agg(F.sum("e").alias("n_exact"), F.countDistinct("qid").alias("n_queries"), (F.sum("f") >= 0.9 * F.sum("e")).alias("recall_ok"))


def q_incremental_add(spark, sf):
    """Index the English documents, add the others, search (equals a full build)."""
    corpus = C.table(spark, sf, "documents").select("doc_id", "text", "lang")
    english = F.col("lang").eqNullSafe("en")
    first = LexicalIndex.build(corpus.filter(english).select("doc_id", "text"))
    idx, _ = first.add_documents(corpus.filter(~english).select("doc_id", "text"))
    return shown(idx.search(C.queries(spark, sf), k=TOPK), "score")


def q_segment_topk(spark, sf):
    """A segmented index is written and opened again; its search reads the partitions of its
    terms only and scores posting blocks."""
    path = scratch_path(spark, "segments")
    SegmentStore.create(spark, path).add(C.corpus(spark, sf))
    return shown(SegmentStore.open(spark, path).search(C.queries(spark, sf), k=TOPK), "score")


def q_segment_updates(spark, sf):
    """B7 on a saved index: the English documents, then the others, then without the toxic ones and
    merged; equals a full build over what is left."""
    corpus = C.table(spark, sf, "documents").select("doc_id", "text", "lang")
    english = F.col("lang").eqNullSafe("en")
    store, _ = SegmentStore.create(spark, scratch_path(spark, "segments")).add(corpus.filter(english))
    store, _ = store.add(corpus.filter(~english))
    store = store.delete(C.table(spark, sf, "labels").filter("toxic = 1").select("doc_id"))
    return shown(store.merge().search(C.queries(spark, sf), k=TOPK), "score")


def q_stream_segments(spark, sf):
    """Documents arrive as files, a segment a batch, merged as they grow; then search."""
    base = scratch_path(spark, "stream-segments")
    each = arriving(C.corpus(spark, sf), f"{base}/in", 4)
    store = stream_segments(spark, f"{base}/in", "doc_id bigint, text string", f"{base}/index", f"{base}/ckpt", max_segments=2, files_per_batch=each)
    return shown(store.search(C.queries(spark, sf), k=TOPK), "score")


def q_stream_index(spark, sf):
    """Documents arrive as files; the index is maintained per micro-batch; then search."""
    base = scratch_path(spark, "stream-index")
    arriving(C.corpus(spark, sf), f"{base}/in", 4)
    indexer = stream_index(spark, f"{base}/in", "doc_id bigint, text string", f"{base}/index", f"{base}/ckpt")
    return shown(indexer.index().search(C.queries(spark, sf), k=TOPK), "score")


def q_stream_search(spark, sf):
    """R2: queries arrive as files and are answered per micro-batch against a static index."""
    base = scratch_path(spark, "stream-search")
    C.queries(spark, sf).repartition(2).write.parquet(f"{base}/in")
    found = stream_search(spark, lexical_index(spark, sf), f"{base}/in", "qid bigint, text string", f"{base}/out", f"{base}/ckpt", k=TOPK)
    return shown(found, "score")


def q_stream_responses(spark, sf):
    """R2: queries arrive as files, each batch is answered in full against the newest version of a
    segmented index and a saved vector table; one row per entry, as ``search_response``."""
    base = scratch_path(spark, "stream-responses")
    C.queries(spark, sf).repartition(2).write.parquet(f"{base}/in")
    SegmentStore.create(spark, f"{base}/index").add(C.corpus(spark, sf))
    IS.save_vectors(D.hash_encode(C.corpus(spark, sf), "doc_id"), f"{base}/vectors")
    found, _ = stream_responses(
        spark, f"{base}/index", lambda: C.corpus(spark, sf), lambda: IS.load_vectors(spark, f"{base}/vectors"),
        f"{base}/in", "qid bigint, text string", f"{base}/out", f"{base}/ckpt", k=TOPK, files_per_batch=1,
    )
    return response_rows(found)


# ---- oracle ------------------------------------------------------------------------------
def _sql_runs(depth: int = DEPTH, alpha: float = 0.5, method: str = "rrf") -> list[str]:
    return [O.LEX, O.QUERIES, O.bm25_run("bm25_r", depth), O.hash_dense_run("dense_r", depth), O.fuse("hyb_r", "bm25_r", "dense_r", alpha, depth, method), O.TEXT_QRELS]


ORACLE = {
    "tokenize_stats": f"SELECT doc_id, len(t) AS dl, len(list_distinct(t)) AS n_terms FROM (SELECT doc_id, {O.tok('text')} AS t FROM documents)",
    "postings": O.with_(O.LEX) + "SELECT doc_id, term, tf, dl FROM postings",
    "term_stats": O.with_(O.LEX) + "SELECT term, df FROM term_stats",
    "corpus_stats": O.with_(O.LEX) + "SELECT n, total_dl, round(avgdl, 6) AS avgdl FROM corpus_stats",
    "bm25_idf": O.with_(O.LEX) + "SELECT term, round(ln(1 + (n - df + 0.5) / (df + 0.5)), 6) AS idf FROM term_stats CROSS JOIN corpus_stats",
    "bm25_topk": O.with_(O.LEX, O.QUERIES, O.bm25_run("r", TOPK)) + "SELECT qid, doc_id, round(score, 6) AS score, rank FROM r",
    "text_qrels": O.with_(O.TEXT_QRELS) + "SELECT qid, doc_id, rel FROM qrels",
    "hash_encode": O.with_(O.hash_vectors("hv", "documents", "doc_id")) + "SELECT id AS doc_id, bucket, round(weight, 6) AS weight FROM hv WHERE weight <> 0",
    "knn_l2_topk": O.with_(O.vec_knn_run("r", TOPK)) + "SELECT qid, doc_id, round(distance, 6) AS distance, rank FROM r",
    "dense_text_topk": O.with_(O.hash_dense_run("r", TOPK)) + "SELECT qid, doc_id, round(distance, 6) AS distance, rank FROM r",
    "dense_summary": "SELECT count(*) AS n_docs, max(len(embedding)) AS dim, 'l2sq' AS metric, 'exact' AS index_type FROM embeddings WHERE embedding IS NOT NULL",
    "fuse_rrf_weighted": O.with_(O.LEX, O.QUERIES, O.bm25_run("a", TOPK), O.hash_dense_run("b", TOPK), O.fuse("f", "a", "b", 0.5, TOPK, "rrf"))
    + "SELECT qid, doc_id, round(score, 6) AS score, rank FROM f",
    "fuse_minmax": O.with_(O.LEX, O.QUERIES, O.bm25_run("a", TOPK), O.hash_dense_run("b", TOPK), O.fuse("f", "a", "b", 0.3, TOPK, "min_max"))
    + "SELECT qid, doc_id, round(score, 6) AS score, rank FROM f",
    "rrf": O.with_(
        O.LEX,
        O.QUERIES,
        O.bm25_run("a", TOPK),
        O.hash_dense_run("b", TOPK),
        O.topk("f_t", "(SELECT qid, doc_id, sum(1.0 / (rank - 1 + 60)) AS score FROM (SELECT qid, doc_id, rank FROM a UNION ALL SELECT qid, doc_id, rank FROM b) GROUP BY ALL)", TOPK),
    )
    + "SELECT qid, doc_id, round(score, 6) AS score, rank FROM f_t",
    "eval_per_query": O.with_(
        *_sql_runs(),
        O.per_query("m1", "bm25_r", system="bm25"),
        O.per_query("m2", "dense_r", system="dense"),
        O.per_query("m3", "hyb_r", system="hybrid"),
    )
    + "SELECT system, qid, " + O.r6(["ndcg", "mrr", "recall"]) + " FROM (SELECT * FROM m1 UNION ALL SELECT * FROM m2 UNION ALL SELECT * FROM m3)",
    "eval_macro": O.with_(
        *_sql_runs(),
        O.per_query("m1", "bm25_r", system="bm25"),
        O.per_query("m2", "dense_r", system="dense"),
        O.per_query("m3", "hyb_r", system="hybrid"),
        "pq AS (SELECT * FROM m1 UNION ALL SELECT * FROM m2 UNION ALL SELECT * FROM m3)",
        O.macro("mac", "pq"),
    )
    + "SELECT system, " + O.r6(["ndcg", "mrr", "recall"]) + ", n_queries FROM mac",
}


def _sweep_sql() -> str:
    alphas = ", ".join(f"{a}" for a in X.ALPHAS)
    return O.with_(
        O.LEX, O.QUERIES, O.bm25_run("a", DEPTH), O.hash_dense_run("b", DEPTH), O.TEXT_QRELS,
        f"""cand AS (
  SELECT coalesce(x.qid, y.qid) AS qid, coalesce(x.doc_id, y.doc_id) AS doc_id,
         coalesce(1.0 / (x.rank - 1 + 60), 0.0) AS lex, coalesce(1.0 / (y.rank - 1 + 60), 0.0) AS den
  FROM a x FULL OUTER JOIN b y ON x.qid = y.qid AND x.doc_id = y.doc_id),
grid AS (SELECT g.alpha, qid, doc_id, g.alpha * lex + (1 - g.alpha) * den AS score
         FROM cand CROSS JOIN (SELECT unnest([{alphas}])::DOUBLE AS alpha) g)""",
        O.topk("fr", "grid", DEPTH, by="alpha, qid"),
        O.per_query_grouped("pq", "fr", ["alpha"]),
        "mac AS (SELECT alpha, sum(ndcg) / (SELECT count(DISTINCT qid) FROM qrels WHERE rel > 0) AS ndcg, "
        "sum(mrr) / (SELECT count(DISTINCT qid) FROM qrels WHERE rel > 0) AS mrr, "
        "sum(recall) / (SELECT count(DISTINCT qid) FROM qrels WHERE rel > 0) AS recall FROM pq GROUP BY alpha)",
        O.best_marked("best", "mac", ["alpha"]),
    )


def _grid_sql() -> str:
    pairs = ", ".join(f"({k1}, {b})" for k1 in X.K1_VALUES for b in X.B_VALUES)
    return O.with_(
        O.LEX, O.QUERIES, O.TEXT_QRELS,
        f"""params AS (SELECT k1::DOUBLE AS k1, b::DOUBLE AS b FROM (VALUES {pairs}) t(k1, b)),
qt AS (SELECT DISTINCT qid, unnest({O.tok('text')}) AS term FROM queries),
sc AS (
  SELECT pr.k1, pr.b, qt.qid, p.doc_id,
         sum(ln(1 + (cs.n - ts.df + 0.5) / (ts.df + 0.5)) * (p.tf * (pr.k1 + 1)) /
             (p.tf + pr.k1 * (1 - pr.b + pr.b * p.dl / cs.avgdl))) AS score
  FROM qt JOIN term_stats ts USING (term) JOIN postings p USING (term) CROSS JOIN corpus_stats cs CROSS JOIN params pr
  GROUP BY ALL)""",
        O.topk("fr", "sc", DEPTH, by="k1, b, qid"),
        O.per_query_grouped("pq", "fr", ["k1", "b"]),
        "mac AS (SELECT k1, b, sum(ndcg) / (SELECT count(DISTINCT qid) FROM qrels WHERE rel > 0) AS ndcg, "
        "sum(mrr) / (SELECT count(DISTINCT qid) FROM qrels WHERE rel > 0) AS mrr, "
        "sum(recall) / (SELECT count(DISTINCT qid) FROM qrels WHERE rel > 0) AS recall FROM pq GROUP BY k1, b)",
        O.best_marked("best", "mac", ["k1", "b"]),
    )


def _runs10_sql() -> list[str]:
    return [O.LEX, O.QUERIES, O.bm25_run("rb", TOPK), O.hash_dense_run("rd", TOPK), O.fuse("rh", "rb", "rd", 0.5, TOPK, "rrf"), O.TEXT_QRELS]


_FAILURE_SQL = O.with_(
    *_runs10_sql(),
    "rel AS (SELECT DISTINCT qid, doc_id FROM qrels WHERE rel > 0)",
    f"fq AS (SELECT qid, text FROM queries WHERE qid IN (SELECT qid FROM queries ORDER BY qid LIMIT {X.FAILURE_QUERIES}) AND qid IN (SELECT qid FROM rel))",
    "hb AS (SELECT r.qid, list(r.doc_id) AS ids FROM rb r JOIN rel USING (qid, doc_id) GROUP BY r.qid)",
    "hd AS (SELECT r.qid, list(r.doc_id) AS ids FROM rd r JOIN rel USING (qid, doc_id) GROUP BY r.qid)",
    "hh AS (SELECT r.qid, list(r.doc_id) AS ids FROM rh r JOIN rel USING (qid, doc_id) GROUP BY r.qid)",
    """f AS (SELECT fq.qid, fq.text AS query, hb.ids AS bi, hd.ids AS di, (hb.qid IS NOT NULL) AS b, (hd.qid IS NOT NULL) AS d, (hh.qid IS NOT NULL) AS h
          FROM fq LEFT JOIN hb USING (qid) LEFT JOIN hd USING (qid) LEFT JOIN hh USING (qid))""",
) + f"""SELECT 'bm25_only' AS category, qid, query, {O.first3('bi')} AS relevant_found FROM f WHERE b AND NOT d
UNION ALL SELECT 'dense_only', qid, query, {O.first3('di')} FROM f WHERE d AND NOT b
UNION ALL SELECT 'both_fail', qid, query, '' FROM f WHERE NOT b AND NOT d
UNION ALL SELECT 'hybrid_wins', qid, query, '' FROM f WHERE h AND (NOT b OR NOT d)"""

_DISAGREE_SQL = O.with_(
    *_runs10_sql(),
    f"""t AS (SELECT 'b' AS s, qid, doc_id FROM rb WHERE rank <= {X.DISAGREEMENT_TOP}
          UNION ALL SELECT 'd', qid, doc_id FROM rd WHERE rank <= {X.DISAGREEMENT_TOP}
          UNION ALL SELECT 'h', qid, doc_id FROM rh WHERE rank <= {X.DISAGREEMENT_TOP})""",
    "bu AS (SELECT qid, doc_id FROM t WHERE s = 'b' EXCEPT SELECT qid, doc_id FROM t WHERE s = 'd')",
    "du AS (SELECT qid, doc_id FROM t WHERE s = 'd' EXCEPT SELECT qid, doc_id FROM t WHERE s = 'b')",
    "res AS (SELECT qid, doc_id FROM t WHERE s = 'h' INTERSECT (SELECT qid, doc_id FROM bu UNION SELECT qid, doc_id FROM du))",
) + " UNION ALL ".join(
    f"SELECT qid, '{t}' AS type, {O.first3('list(doc_id)')} AS docs, '{d}' AS description FROM {src} GROUP BY qid"
    for (t, d), src in zip(X.DISAGREEMENTS, ("bu", "du", "res"))
)

_BASELINE_CTES = [
    *_sql_runs(),
    O.per_query("m1", "bm25_r", system="bm25"),
    O.per_query("m2", "dense_r", system="dense"),
    O.per_query("m3", "hyb_r", system="hybrid"),
    "pq AS (SELECT * FROM m1 UNION ALL SELECT * FROM m2 UNION ALL SELECT * FROM m3)",
    O.macro("mac", "pq"),
]

ORACLE.update({
    "baseline_comparison": O.with_(*_BASELINE_CTES) + "SELECT system, " + O.r6(["ndcg", "mrr", "recall"]) + " FROM mac",
    "alpha_sweep": _sweep_sql() + "SELECT alpha, ndcg, mrr, recall, is_best FROM best",
    "bm25_grid": _grid_sql() + "SELECT k1, b, ndcg, mrr, recall, is_best FROM best",
    "latency_summary": O.latency_sql(),
    "failure_analysis": _FAILURE_SQL,
    "disagreements": _DISAGREE_SQL,
    "snippets": O.with_(O.LEX, O.QUERIES, O.bm25_scores("s"), O.topk("t", "s", TOPK))
    + f"SELECT t.qid, t.doc_id, t.rank, round(t.score, 4) AS display_score, {O.snippet_sql('coalesce(d.text, \'\')')} AS snippet FROM t LEFT JOIN documents d USING (doc_id)",
    "document_fetch": O.with_(O.LEX, O.QUERIES, O.bm25_run("r", TOPK)) + "SELECT r.qid, r.doc_id, coalesce(d.text, '') AS text FROM r LEFT JOIN documents d USING (doc_id)",
    "rejected_queries": "SELECT item_id AS qid, 'Query cannot be empty' AS reason FROM benchmark WHERE text IS NULL OR trim(text) = '' "
    "UNION ALL SELECT -item_id - 1, 'Query cannot be empty' FROM benchmark",
    "relevant_docs": "SELECT DISTINCT doc_id FROM labels WHERE quality > 0",
    "covered_corpus": f"SELECT DISTINCT doc_id FROM documents WHERE doc_id IN (SELECT doc_id FROM documents ORDER BY doc_id LIMIT {PREP_TARGET}) OR doc_id IN (SELECT doc_id FROM labels WHERE quality > 0)",
    "missing_relevant": "SELECT DISTINCT doc_id FROM (SELECT doc_id FROM labels WHERE quality > 0 UNION ALL "
    "SELECT doc_id + (SELECT count(*) FROM documents) FROM labels WHERE quality > 0) WHERE doc_id NOT IN (SELECT doc_id FROM documents)",
    "coverage": O.with_(
        f"cov AS (SELECT DISTINCT doc_id FROM documents WHERE doc_id IN (SELECT doc_id FROM documents ORDER BY doc_id LIMIT {PREP_TARGET}) OR doc_id IN (SELECT doc_id FROM labels WHERE quality > 0))",
        "rel AS (SELECT DISTINCT doc_id FROM labels WHERE quality > 0)",
        "c AS (SELECT count(*) AS n_corpus, count(rel.doc_id) AS n_relevant_written FROM cov LEFT JOIN rel USING (doc_id))",
        "k AS (SELECT (SELECT count(*) FROM rel) AS n_relevant, (SELECT count(*) FROM benchmark) AS n_queries, (SELECT count(*) FROM labels) AS n_qrels)",
    )
    + """SELECT n_corpus, n_relevant_written, n_corpus - n_relevant_written AS n_sampled, n_relevant, n_queries, n_qrels,
       round(CASE WHEN n_relevant > 0 THEN n_relevant_written / n_relevant ELSE 0.0 END, 6) AS coverage,
       CASE WHEN (CASE WHEN n_relevant > 0 THEN n_relevant_written / n_relevant ELSE 0.0 END) >= 0.95 THEN 'excellent'
            WHEN (CASE WHEN n_relevant > 0 THEN n_relevant_written / n_relevant ELSE 0.0 END) >= 0.80 THEN 'good' ELSE 'poor' END AS grade
FROM c CROSS JOIN k""",
    "qrels_filter": "SELECT DISTINCT 0::BIGINT AS qid, doc_id FROM labels WHERE quality > 0",
    "io_roundtrip": """WITH t AS (
  SELECT 'corpus' AS tbl, doc_id::VARCHAR || '|' || text AS x FROM documents
  UNION ALL SELECT 'queries', item_id::VARCHAR || '|' || translate(text, chr(13) || chr(10), '  ') FROM benchmark
  UNION ALL SELECT DISTINCT 'qrels', '0|' || doc_id::VARCHAR || '|1' FROM labels WHERE quality > 0)
SELECT tbl, count(*) AS n_rows, sum(('0x' || substr(md5(x), 1, 8))::BIGINT)::BIGINT AS digest FROM t GROUP BY tbl""",
    "index_roundtrip": ORACLE["bm25_topk"],
    "vector_roundtrip": ORACLE["knn_l2_topk"],
    "selective_build": O.with_(O.LEX) + """SELECT 'postings' AS component, count(*) AS n_rows FROM postings
UNION ALL SELECT 'doc_stats', count(*) FROM doc_stats UNION ALL SELECT 'vectors', count(*) FROM documents""",
    "incremental_add": ORACLE["bm25_topk"],
    "stream_index": ORACLE["bm25_topk"],
    "stream_search": ORACLE["bm25_topk"],
    "segment_topk": ORACLE["bm25_topk"],
    "segment_updates": ORACLE["bm25_topk"].replace("FROM documents", "FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)"),
    "stream_segments": ORACLE["bm25_topk"],
})


def _sweep_ctes(lex: str, den: str, p: str) -> list[str]:
    alphas = ", ".join(f"{a}" for a in X.ALPHAS)
    n = "(SELECT count(DISTINCT qid) FROM qrels WHERE rel > 0)"
    return [
        f"""{p}cand AS (
  SELECT coalesce(x.qid, y.qid) AS qid, coalesce(x.doc_id, y.doc_id) AS doc_id,
         coalesce(1.0 / (x.rank - 1 + 60), 0.0) AS lex, coalesce(1.0 / (y.rank - 1 + 60), 0.0) AS den
  FROM {lex} x FULL OUTER JOIN {den} y ON x.qid = y.qid AND x.doc_id = y.doc_id),
{p}grid AS (SELECT g.alpha, qid, doc_id, g.alpha * lex + (1 - g.alpha) * den AS score
         FROM {p}cand CROSS JOIN (SELECT unnest([{alphas}])::DOUBLE AS alpha) g)""",
        O.topk(f"{p}fr", f"{p}grid", DEPTH, by="alpha, qid"),
        O.per_query_grouped(f"{p}pq", f"{p}fr", ["alpha"]),
        f"{p}mac AS (SELECT alpha, sum(ndcg) / {n} AS ndcg, sum(mrr) / {n} AS mrr, sum(recall) / {n} AS recall FROM {p}pq GROUP BY alpha)",
        O.best_marked(f"{p}best", f"{p}mac", ["alpha"]),
    ]


_REPORT_SQL = O.with_(*_BASELINE_CTES, *_sweep_ctes("bm25_r", "dense_r", "sw_"), f"lat AS ({O.latency_sql()})") + " UNION ALL ".join(
    [f"SELECT 'baseline' AS experiment, system, '{m}' AS metric, round({m}, 6)::DOUBLE AS value FROM mac" for m in ("ndcg", "mrr", "recall")]
    + ["SELECT 'alpha_sweep', 'hybrid', 'best_alpha', alpha::DOUBLE FROM sw_best WHERE is_best",
       "SELECT 'alpha_sweep', 'hybrid', 'best_ndcg', ndcg::DOUBLE FROM sw_best WHERE is_best"]
    + [f"SELECT 'latency', system, '{m}', {m}::DOUBLE FROM lat" for m in ("mean_ms", "p95_ms", "qps")]
)
ORACLE["report_summary"] = _REPORT_SQL
ORACLE["knn_ivf_topk"] = ORACLE["knn_l2_topk"]
ORACLE["knn_ivf_recall"] = (
    "SELECT count(*)::BIGINT AS n_exact, count(DISTINCT qid) AS n_queries, true AS recall_ok FROM (" + ORACLE["knn_l2_topk"] + ")"
)


def _sink_sql() -> str:
    def cells(name: str, key: str, metrics: list[str], sql: str) -> str:
        names = ", ".join(f"'{m}'" for m in metrics)
        return f"SELECT '{name}' AS tbl, {key} AS key, unnest([{names}]) AS metric, unnest([{', '.join(f'{m}::DOUBLE' for m in metrics)}]) AS value FROM ({sql})"

    counts = (
        "SELECT c.category, count(f.qid) AS n_queries FROM (SELECT unnest(['bm25_only', 'dense_only', 'both_fail', 'hybrid_wins']) AS category) c "
        f"LEFT JOIN ({_FAILURE_SQL}) f USING (category) GROUP BY c.category"
    )
    three = ["ndcg", "mrr", "recall"]
    return " UNION ALL ".join(
        [
            cells("exp1_baseline", "system", three, ORACLE["baseline_comparison"]),
            cells("exp2_alpha", "printf('%.2f', alpha)", three, ORACLE["alpha_sweep"]),
            cells("exp3_bm25", "printf('%.2f', k1) || '/' || printf('%.2f', b)", three, ORACLE["bm25_grid"]),
            cells("exp4_latency", "system", ["mean_ms", "median_ms", "p95_ms", "p99_ms", "qps"], ORACLE["latency_summary"]),
            cells("exp5_failures", "category", ["n_queries"], counts),
        ]
    )


ORACLE["results_sink"] = _sink_sql()
ORACLE["search_response"] = (
    O.with_(
        *_runs10_sql(),
        "ok AS MATERIALIZED (SELECT qid FROM queries WHERE text IS NOT NULL AND trim(text) <> '')",
        """runs AS MATERIALIZED (SELECT 'bm25' AS list, qid, rank, doc_id, round(score, 4) AS score FROM rb
  UNION ALL SELECT 'dense', qid, rank, doc_id, round(distance, 4) FROM rd UNION ALL SELECT 'hybrid', qid, rank, doc_id, round(score, 4) FROM rh)""",
        "said AS MATERIALIZED (" + _DISAGREE_SQL + ")",
    )
    + f"""SELECT ok.qid, l.list, coalesce(r.rank, 0)::BIGINT AS rank, coalesce(r.doc_id::VARCHAR, '') AS item, coalesce(r.score, 0.0) AS score,
       CASE WHEN r.doc_id IS NOT NULL THEN {O.snippet_sql("coalesce(d.text, '')")} ELSE '' END AS snippet
FROM ok CROSS JOIN (SELECT unnest(['bm25', 'dense', 'hybrid']) AS list) l LEFT JOIN runs r ON r.qid = ok.qid AND r.list = l.list LEFT JOIN documents d ON d.doc_id = r.doc_id
UNION ALL SELECT ok.qid, 'disagreements', 0, coalesce(s.type, ''), 0.0, coalesce(s.docs, '') FROM ok LEFT JOIN said s ON s.qid = ok.qid"""
)


QUERIES = {
    "tokenize_stats": q_tokenize_stats,
    "postings": q_postings,
    "term_stats": q_term_stats,
    "corpus_stats": q_corpus_stats,
    "bm25_idf": q_bm25_idf,
    "bm25_topk": q_bm25_topk,
    "text_qrels": q_text_qrels,
    "hash_encode": q_hash_encode,
    "knn_l2_topk": q_knn_l2_topk,
    "dense_text_topk": q_dense_text_topk,
    "dense_summary": q_dense_summary,
    "fuse_rrf_weighted": q_fuse_rrf_weighted,
    "fuse_minmax": q_fuse_minmax,
    "rrf": q_rrf,
    "eval_per_query": q_eval_per_query,
    "eval_macro": q_eval_macro,
    "baseline_comparison": q_baseline_comparison,
    "alpha_sweep": q_alpha_sweep,
    "bm25_grid": q_bm25_grid,
    "latency_summary": q_latency_summary,
    "failure_analysis": q_failure_analysis,
    "disagreements": q_disagreements,
    "report_summary": q_report_summary,
    "snippets": q_snippets,
    "document_fetch": q_document_fetch,
    "rejected_queries": q_rejected_queries,
    "relevant_docs": q_relevant_docs,
    "covered_corpus": q_covered_corpus,
    "missing_relevant": q_missing_relevant,
    "coverage": q_coverage,
    "qrels_filter": q_qrels_filter,
    "io_roundtrip": q_io_roundtrip,
    "index_roundtrip": q_index_roundtrip,
    "vector_roundtrip": q_vector_roundtrip,
    "results_sink": q_results_sink,
    "selective_build": q_selective_build,
    "search_response": q_search_response,
    "knn_ivf_topk": q_knn_ivf_topk,
    "knn_ivf_recall": q_knn_ivf_recall,
    "incremental_add": q_incremental_add,
    "stream_index": q_stream_index,
    "stream_search": q_stream_search,
    "segment_topk": q_segment_topk,
    "segment_updates": q_segment_updates,
    "stream_segments": q_stream_segments,
    "stream_responses": q_stream_responses,
    "document_store_fetch": q_document_store_fetch,
    "collection_formats": q_collection_formats,
    "model_encode": q_model_encode,
    "prepared_corpus": q_prepared_corpus,
}
ORACLE["document_store_fetch"] = ORACLE["document_fetch"]
ORACLE["prepared_corpus"] = (
    "SELECT doc_id, md5(text) AS digest, n_corpus, n_relevant_written, coverage, grade FROM documents CROSS JOIN ("
    + ORACLE["coverage"] + ") WHERE doc_id IN (" + ORACLE["covered_corpus"] + ")"
)
ORACLE["model_encode"] = """
WITH cells AS (SELECT row_number() OVER () AS r, doc_id, unnest(range(26)) AS i, text FROM documents),
counted AS (SELECT r, doc_id, i, CAST(length(text) - length(replace(text, chr(97 + CAST(i AS INTEGER)), '')) AS DOUBLE) AS n FROM cells),
norms AS (SELECT r, sqrt(sum(n * n)) AS norm FROM counted GROUP BY r)
SELECT doc_id, CAST(i AS INTEGER) AS bucket, CAST(CAST(n / norm AS FLOAT) AS DOUBLE) AS weight FROM counted JOIN norms USING (r) WHERE n > 0
"""
ORACLE["collection_formats"] = """
SELECT unnest(['parquet', 'json', 'tsv', 'text']) AS format, doc_id, coalesce(lang, '') AS lang, md5(coalesce(text, '')) AS digest FROM documents
"""
ORACLE["stream_responses"] = ORACLE["search_response"]
