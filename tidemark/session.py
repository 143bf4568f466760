"""Session settings and lineage cutting.

A nightly run reuses the SCD2 dimension in four places; with lazy DataFrames
each consumer would recompute the window chain. `materialize` writes such a
shared intermediate once, as Parquet under the cluster's shared
`spark.checkpoint.dir`, and hands back a fresh scan: lineage is cut, column
pruning and filter pushdown still apply on the re-read, and a lost executor
only costs re-reading files, never re-running the chain.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Conf a run of this library expects. AQE re-plans joins at runtime: it turns a
# sort-merge join into a broadcast join when the measured build side is under
# `spark.sql.adaptive.autoBroadcastJoinThreshold`, splits skewed shuffle
# partitions of a join and coalesces small ones.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app: str = "tidemark", conf: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    settings = dict(DEFAULT_CONF)
    settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for k, v in settings.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    sc = _context(spark)
    if sc is not None:
        sc.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _context(spark: SparkSession):
    """The SparkContext of a classic session; None under Spark Connect."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - Connect sessions have no SparkContext
        return None


def _master(spark: SparkSession) -> str | None:
    sc = _context(spark)
    if sc is not None:
        return sc.master
    try:
        return spark.conf.get("spark.master", None)
    except Exception:  # noqa: BLE001 - not readable under some Connect servers
        return None


def checkpoint_root(spark: SparkSession) -> str | None:
    """The shared folder the cluster names in `spark.checkpoint.dir`, if any."""
    value = None
    sc = _context(spark)
    if sc is not None:
        value = sc.getConf().get("spark.checkpoint.dir", None)
    if not value:
        try:
            value = spark.conf.get("spark.checkpoint.dir", None)
        except Exception:  # noqa: BLE001 - conf lookup on a core key may raise
            value = None
    return value or None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder; create a private one only when none is set.

    On a cluster the setting is always present and is used as is. The local
    fallback exists for tests and single-machine runs; on any other master a
    missing setting is an error, since a machine-local folder is not shared
    by the executors.
    """
    root = checkpoint_root(spark)
    if root:
        return root
    sc = _context(spark)
    existing = sc.getCheckpointDir() if sc is not None else None
    if existing:
        return existing
    master = _master(spark)
    if master is None or not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set: name a folder shared by all executors "
            "(e.g. --conf spark.checkpoint.dir=hdfs:///...) for the shared intermediates")
    root = tempfile.mkdtemp(prefix="tidemark-ckpt-")
    if sc is not None:
        sc.setCheckpointDir(root)
    return root


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, through the Hadoop FileSystem of the path."""
    sc = _context(spark)
    if sc is None:
        raise RuntimeError("looking for a folder needs a classic session")
    found = sc._jvm.org.apache.hadoop.fs.Path(path)
    return bool(found.getFileSystem(sc._jsc.hadoopConfiguration()).exists(found))


def run_folder(spark: SparkSession, run_id: str) -> str:
    """Where `materialize` writes the intermediates of one run."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/tidemark/{run_id}"


def materialize(df: DataFrame, name: str, run_id: str | None = None) -> DataFrame:
    """Write `df` once as Parquet under the checkpoint folder and re-read it."""
    spark = df.sparkSession
    path = f"{run_folder(spark, run_id or uuid.uuid4().hex)}/{name}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def drop_run_folder(spark: SparkSession, run_id: str) -> bool:
    """Delete the intermediates `materialize` wrote for `run_id`, through the
    Hadoop FileSystem of the folder (any shared store the cluster names).
    Returns False when the session has no JVM handle (Spark Connect); the
    folder is then left to the store's retention."""
    sc = _context(spark)
    if sc is None:
        return False
    jvm = sc._jvm
    path = jvm.org.apache.hadoop.fs.Path(run_folder(spark, run_id))
    fs = path.getFileSystem(sc._jsc.hadoopConfiguration())
    return bool(fs.delete(path, True))
