"""Session-level helpers shared by all operators.

* ``local_session``: a tuned local session for tests and the bench.
* ``ensure_checkpoint_dir`` / ``scratch_path``: the shared scratch folder. On a cluster the
  caller owns the session; the library only reads ``spark.checkpoint.dir`` (a shared, durable
  folder for lineage cuts, streaming checkpoints and round-trip sinks) and sets it only when
  unset, as in tests.
* ``written``: a table that several branches read, evaluated once.
* ``bound_batches`` / ``release_memory``: what Python workers hold, in a batch and between stages.
* ``spread``: parallelise tiny inputs without ever shuffling large ones.
* ``broadcast_if_small`` / ``broadcast_if_bounded`` / ``with_text``: every broadcast behind a
  size check, and late text joins that stream the corpus.
* ``ship_package``: make this package importable by Python workers.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "sparkrank") -> SparkSession:
    """A local session for tests and the bench (no UI, AQE on, UTC, Arrow on)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("SPARKRANK_DRIVER_MEMORY", "16g"))
        .config("spark.sql.sources.bucketing.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's shared checkpoint folder, creating a private one only if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return sc.getCheckpointDir() or current
    if not sc.master.startswith("local[") and sc.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="sparkrank-ckpt-")
    spark.conf.set("spark.checkpoint.dir", local)
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder (never a machine-local temp dir)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/sparkrank-{name}-{uuid.uuid4().hex[:12]}"


def written(df, name: str):
    """``df`` written once below the shared folder and read back: what several branches of a
    plan use is evaluated once, and a lost executor takes no part of it with it."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df):
    """Round-robin an input with fewer splits than the cluster has cores.

    CPU-heavy per-row work (tokenising) on a handful of large row groups would otherwise use
    a few cores. On a cluster reading many files this never triggers (splits >> cores), so no
    large input is ever shuffled by it.
    """
    sc = df.sparkSession.sparkContext
    want = sc.defaultParallelism
    if df.rdd.getNumPartitions() < want:
        return df.repartition(want)
    return df


#: Arrow batches of token arrays hold at most so many bytes: a worker holds a batch several times over.
BATCH_BYTES = 8 << 20


def bound_batches(spark) -> None:
    """Bound the session's Arrow batches by ``BATCH_BYTES`` unless they are bounded closer already."""
    now = str(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", "64m")).rstrip("bB")
    if not now.isdigit() or not 0 < int(now) <= BATCH_BYTES:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def release_memory() -> None:
    """Give what a Python worker has freed back to the system, so that workers which wait between
    stages do not hold their peak beside the next stage's."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


# Largest table (rows) hinted for broadcast by ``broadcast_if_small``.
MAX_BROADCAST_ROWS = 2_000_000


def broadcast_if_small(df, max_rows: int = MAX_BROADCAST_ROWS):
    """Broadcast ``df`` only after counting it: at most ``max_rows`` rows are shipped to every
    task; a bigger table is returned as is and the planner picks a shuffle join."""
    from pyspark.sql import functions as F

    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def broadcast_if_bounded(df, bound_rows: int, max_rows: int = MAX_BROADCAST_ROWS):
    """Broadcast ``df`` when a known upper bound on its rows (e.g. queries x k for a top-k
    run) is within ``max_rows``; the bound is checked instead of executing ``df``."""
    from pyspark.sql import functions as F

    return F.broadcast(df) if bound_rows <= max_rows else df


def with_text(run, corpus, n_queries: int, k: int, text: str = "text"):
    """Late materialisation: join document text to the rows of a top-k run only.

    The run (at most ``n_queries * k`` rows) is the broadcast side of an inner join, so the
    corpus is streamed, never shuffled. (An outer join could only broadcast the corpus.) Run
    rows whose document is absent get ``""``; finding them reads the corpus ids only.
    """
    from pyspark.sql import functions as F

    small = broadcast_if_bounded(run, n_queries * k)
    found = corpus.select("doc_id", text).join(small, "doc_id")
    ids = broadcast_if_bounded(run.select("doc_id").distinct(), n_queries * k)
    present = corpus.select("doc_id").join(ids, "doc_id", "left_semi")
    missing = run.join(present, "doc_id", "left_anti").withColumn(text, F.lit(""))
    return found.unionByName(missing)


_SHIPPED: set[str] = set()


def ship_package(spark) -> None:
    """Make ``sparkrank`` importable by the Python workers of this application.

    Operators that run Python on executors (the k-NN kernel, encoders) reference module-level
    helpers, so the workers must import this package. Unless it is installed cluster-wide, it
    is zipped once per application and added with ``addPyFile`` (Spark ships it to every
    executor). Idempotent.
    """
    import io
    import zipfile

    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg_dir)
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as zf:
        for dirpath, _, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    zf.write(full, os.path.relpath(full, root))
    path = os.path.join(tempfile.mkdtemp(prefix="sparkrank-pkg-"), "sparkrank.zip")
    with open(path, "wb") as fh:
        fh.write(buf.getvalue())
    sc.addPyFile(path)
    _SHIPPED.add(app)
