"""Session helpers: defaults for local runs and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings a cluster job relies on.  AQE re-plans joins from runtime sizes,
# splits skewed join partitions and coalesces small shuffle partitions; the
# runtime bloom filter shrinks the big side of shuffle joins.  (Cluster jobs
# set these in their own configuration; ``local_session`` applies them.)
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # respect the advisory partition size instead of maximising task count
    # (Spark's advice for busy clusters; fewer tiny tasks for small stages)
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    # build bloom filters from driving sides up to 256 MB, not only tiny ones
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "256MB",
    # remove checkpoint files of stage results once they are unreferenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "movrec") -> SparkSession:
    """A local session for tests and benchmarks (UI off, no ports beyond Spark's own)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
    )
    for k, v in RECOMMENDED_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder the cluster names for checkpoints, if any."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    try:
        conf_dir = spark.conf.get("spark.checkpoint.dir")
    except Exception:  # not set
        conf_dir = None
    return conf_dir or sc.getConf().get("spark.checkpoint.dir", None)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Make sure reliable checkpoints have a directory and return it.

    The folder named by ``spark.checkpoint.dir`` (the cluster's shared folder)
    always wins.  Only when nothing is configured and the master is local (tests,
    benchmarks) do we create a private temporary folder; on a cluster an unset
    directory is an error, because a machine-local folder would not survive the
    loss of that machine.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = checkpoint_dir(spark)
    if not configured:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder before running movrec jobs")
        configured = tempfile.mkdtemp(prefix="movrec-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def hadoop_path(spark: SparkSession, path: str):
    """``(file system, path)`` of the JVM for a path in any store Spark reads."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def remove_path(spark: SparkSession, path: str) -> bool:
    """Delete a file or folder; False if there was none."""
    fs, p = hadoop_path(spark, path)
    return fs.delete(p, True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for written tables, removed when the application ends."""
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    fs, p = hadoop_path(spark, folder)
    fs.mkdirs(p)
    fs.deleteOnExit(p)
    return f"{folder}/data"


def local_path(uri: str) -> str:
    """Strip a ``file:`` scheme (for tests that inspect local output)."""
    return uri[len("file:"):] if uri.startswith("file:") else uri


__all__ = [
    "RECOMMENDED_CONF",
    "checkpoint_dir",
    "ensure_checkpoint_dir",
    "hadoop_path",
    "local_path",
    "local_session",
    "remove_path",
    "scratch_path",
]
