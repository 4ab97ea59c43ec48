"""Benchmark: headline retrieval jobs at one scale, one JSON line on stdout.

Environment: ``BENCH_SF_DIR`` (default /root/testdata/sf0.1), ``BENCH_CPUS`` (default 8).
Every query is executed in full through the ``noop`` sink (nothing collected to the driver).
``value`` is the total wall time of the timed queries (cold first runs plus two warm
repeats); throughput figures (documents/s for
the index build, queries/s for search) are reported next to it, as the reference reports
per-query latency from warm memory and the two are not comparable one to one.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from sparkrank.operators import dense as D  # noqa: E402
from sparkrank.operators import fusion as FU  # noqa: E402
from sparkrank.operators.lexical import LexicalIndex  # noqa: E402
from sparkrank.plans import catalog  # noqa: E402
from sparkrank.session import local_session, scratch_path  # noqa: E402
from sparkrank.sources import collections as C  # noqa: E402
from sparkrank.sources import index_store as IS  # noqa: E402


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cpus, shuffle_partitions=cpus)
    times: dict[str, float] = {}

    def timed(name, fn):
        spark.catalog.clearCache()  # nothing of an earlier query is reused
        t0 = time.perf_counter()
        out = fn()
        times[name] = round(time.perf_counter() - t0, 3)
        return out

    # Warm the JVM and the Python workers (untimed).
    run(catalog.q_latency_summary(spark, sf))
    run(D.hash_encode(C.queries(spark, sf), "qid"))

    n_docs = C.corpus(spark, sf).count()
    n_queries = C.queries(spark, sf).count()
    idx_path = scratch_path(spark, "bench-index")
    vec_path = scratch_path(spark, "bench-vectors")

    timed("index_build", lambda: IS.save_lexical(LexicalIndex.build(C.corpus(spark, sf)), idx_path, buckets=cpus * 2))
    timed("dense_build", lambda: IS.save_vectors(D.hash_encode(C.corpus(spark, sf), "doc_id"), vec_path))
    index = IS.load_lexical(spark, idx_path)
    vectors = IS.load_vectors(spark, vec_path)
    qs = C.queries(spark, sf)

    timed("bm25_topk", lambda: run(index.search(qs, k=10)))
    timed("dense_topk", lambda: run(D.knn(vectors, D.hash_encode(qs, "qid"), 10)))

    def hybrid():
        bm25 = index.search(qs, k=10)
        dense = D.knn(vectors, D.hash_encode(qs, "qid"), 10)
        run(FU.hybrid(bm25, dense, alpha=0.5, k=10))

    timed("hybrid_topk", hybrid)
    # Warm repeats (JIT, file cache and Python workers warm), the reference's setting.
    timed("bm25_topk_warm", lambda: run(index.search(qs, k=10)))
    timed("dense_topk_warm", lambda: run(D.knn(vectors, D.hash_encode(qs, "qid"), 10)))
    timed("hybrid_topk_warm", hybrid)
    timed("knn_l2_topk", lambda: run(catalog.q_knn_l2_topk(spark, sf)))
    timed("eval_macro", lambda: run(catalog.q_eval_macro(spark, sf)))
    timed("alpha_sweep", lambda: run(catalog.q_alpha_sweep(spark, sf)))
    timed("bm25_grid", lambda: run(catalog.q_bm25_grid(spark, sf)))
    timed("latency_summary", lambda: run(catalog.q_latency_summary(spark, sf)))
    timed("failure_analysis", lambda: run(catalog.q_failure_analysis(spark, sf)))
    timed("coverage", lambda: run(catalog.q_coverage(spark, sf)))
    timed("bm25_topk_inplan", lambda: run(catalog.q_bm25_topk(spark, sf)))
    timed("search_response", lambda: run(catalog.q_search_response(spark, sf)))

    total = round(sum(times.values()), 3)
    print(
        json.dumps(
            {
                "metric": "total_wall_time",
                "value": total,
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf).replace("sf", ""),
                "cpus": cpus,
                "n_docs": n_docs,
                "n_queries": n_queries,
                "build_docs_per_sec": round(n_docs / times["index_build"], 1),
                "bm25_queries_per_sec": round(n_queries / times["bm25_topk"], 1),
                "hybrid_queries_per_sec": round(n_queries / times["hybrid_topk"], 1),
                "bm25_warm_ms_per_query": round(1000 * times["bm25_topk_warm"] / n_queries, 2),
                "dense_warm_ms_per_query": round(1000 * times["dense_topk_warm"] / n_queries, 2),
                "hybrid_warm_ms_per_query": round(1000 * times["hybrid_topk_warm"] / n_queries, 2),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
