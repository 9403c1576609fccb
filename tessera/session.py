"""Spark session and shared-folder helpers.

Everything that must survive the loss of an executor (checkpoints, tables
written between stages, stream state) lives under the folder the cluster
names in ``spark.checkpoint.dir``.  Only when that setting is absent *and*
the master is local (tests, laptops) do we create one under /tmp.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Session settings chosen for large inputs.  AQE re-plans joins at runtime
# (demotes sort-merge to broadcast when a side turns out small, splits
# skewed partitions) and coalesces small shuffle partitions.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "tessera",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the scale settings above."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(SCALE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting one only where unset.

    On a cluster the folder must be given (``spark.checkpoint.dir``); a
    machine-local folder would vanish with the executor that wrote it.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if not _is_local(spark):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder "
            "(HDFS/S3/ABFS) so checkpoints survive executor loss")
    local = tempfile.mkdtemp(prefix="tessera-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tessera-{name}-{uuid.uuid4().hex[:12]}"


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a scratch folder through Spark's own file systems."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def rename_folders(spark: SparkSession, path: str, prefix: str, to: str) -> None:
    """Sub-folders ``<prefix>x`` become ``<to>x`` (names only, no data moves
    where the file system renames)."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for status in fs.listStatus(folder):
        name = status.getPath().getName()
        if name.startswith(prefix):
            fs.rename(status.getPath(), spark._jvm.org.apache.hadoop.fs.Path(folder, to + name.removeprefix(prefix)))


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme (local mode only) for Python-side checks."""
    return path[5:] if path.startswith("file:") else path
