"""Session helpers: a test/bench session and the shared scratch location.

On a cluster the caller owns the session; the library only reads
``spark.checkpoint.dir`` from it and keeps every intermediate (lakes built by
``queries()``, lineage cuts) under that shared folder. A local folder is
created only when the setting is absent, as in unit tests.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_session(
    master: str | None = None,
    app_name: str = "tiermill",
    shuffle_partitions: int = 8,
    driver_memory: str = "8g",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session tuned for local testing and benchmarking."""
    master = master or f"local[{os.environ.get('BENCH_CPUS', '8')}]"
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.sources.partitionOverwriteMode", "static")
    )
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    scratch_root(spark)
    return spark


def _context(spark: SparkSession):
    """The SparkContext when the session has one (not under Spark Connect)."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - Connect sessions have no context
        return None


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediates: the session's ``spark.checkpoint.dir``.

    Only when the session has none and runs in local mode (tests) is a
    private folder created and, where the session allows it, registered as
    the checkpoint directory; a cluster session without the setting raises.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    sc = _context(spark)
    current = sc.getCheckpointDir() if sc is not None else None
    if current:
        return current.rstrip("/")
    master = spark.conf.get("spark.master", None)
    if master is None or not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set: unless the session runs in one local process it must "
            "name a shared folder (HDFS, object store) that every executor can write and read"
        )
    global _LOCAL_SCRATCH
    if _LOCAL_SCRATCH is None:
        _LOCAL_SCRATCH = tempfile.mkdtemp(prefix="tiermill-ckpt-")
    if sc is not None:
        sc.setCheckpointDir(_LOCAL_SCRATCH)
    return _LOCAL_SCRATCH


_LOCAL_SCRATCH: str | None = None


def session_id(spark: SparkSession) -> str:
    """Identifier of the running application (works without a SparkContext)."""
    app = spark.conf.get("spark.app.id", None)
    if app:
        return app
    sc = _context(spark)
    return sc.applicationId if sc is not None else str(id(spark))


def new_scratch_path(spark: SparkSession, prefix: str) -> str:
    """A fresh, never-reused path under the shared scratch folder."""
    path = f"{scratch_root(spark)}/tiermill/{prefix}-{uuid.uuid4().hex[:12]}"
    _MADE.append(path)
    return path


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder that the library made, on whatever file system it lies."""
    sc = _context(spark)
    if sc is None:  # a remote session has no file system to call; the folder's retention policy removes it
        return
    target = sc._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(target, True)


def clear_scratch(spark: SparkSession) -> None:
    """Delete everything the library has written under the scratch folder in this application.

    For the end of an application: lakes built by queries, lineage cuts and
    streaming checkpoints go, so frames that still read them fail afterwards.
    """
    for path in _MADE:
        remove_path(spark, path)
    _MADE.clear()


_MADE: list[str] = []


def active_session(app_name: str = "tiermill") -> SparkSession:
    """The session that is running or was submitted, with its own settings; a plain local one otherwise."""
    return SparkSession.getActiveSession() or SparkSession.builder.appName(app_name).getOrCreate()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` as a Parquet table under the shared scratch folder.

    Used where a result is read by two branches of a later plan and both must
    see exactly the same rows (for example partition-local positions), and to
    keep long lineages recoverable if executors are lost. One write job; the
    returned frame is a plain scan with no lineage behind it.
    """
    spark = df.sparkSession
    path = new_scratch_path(spark, "cut")
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
