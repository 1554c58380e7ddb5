"""Session construction and lineage helpers."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "clickloom") -> SparkSession:
    """A session tuned for the library: AQE on, UTC, UI off.

    On a cluster ``master`` is left to the launcher; locally it defaults to
    ``local[*]``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            # local mode: the driver JVM is the only executor
            builder = builder.config("spark.driver.memory", "12g")
    builder = (
        builder
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster.

    ``spark.checkpoint.dir`` is read from the session. Only a local master may
    go without (unit tests, a laptop): it gets a private scratch folder. On a
    cluster a folder of the driver's own would be invisible to the executors,
    so there its absence is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        try:
            conf_dir = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset key raises in some versions
            conf_dir = None
    if not conf_dir:
        if not is_local(sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        conf_dir = tempfile.mkdtemp(prefix="clickloom-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def is_local(master: str) -> bool:
    """True for ``local``, ``local[n]``: driver and executor are one process."""
    return master == "local" or master.startswith("local[")


# paths written by cut_lineage and scratch_path, by application
_SCRATCH: dict[str, list[str]] = {}


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` as a Parquet table in the shared checkpoint folder and
    read it back.

    Survives executor loss (the data is in the shared store, not on an
    executor), bounds plan size in iterative loops, and - unlike RDD
    checkpoint files - stays columnar: later reads prune columns and push
    filters down to the files. The table lives until ``release_scratch`` (or
    the end of the ``scratch_scope`` it was made in).
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"table-{uuid.uuid4().hex}")
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for intermediate tables; it is
    deleted by ``release_scratch``."""
    path = os.path.join(checkpoint_dir(spark), name)
    _SCRATCH.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def release_scratch(spark: SparkSession, keep: int = 0) -> int:
    """Delete this application's intermediate tables but the first ``keep``
    noted ones; the number of paths deleted. Results that still read them must
    have been written before."""
    paths = _SCRATCH.get(spark.sparkContext.applicationId, [])
    gone = paths[keep:]
    del paths[keep:]
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for path in gone:
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(conf).delete(where, True)
    return len(gone)


@contextmanager
def scratch_scope(spark: SparkSession):
    """Owner of the intermediate tables made inside: a job that writes its
    results within the scope leaves nothing in the checkpoint folder."""
    before = len(_SCRATCH.get(spark.sparkContext.applicationId, []))
    try:
        yield
    finally:
        release_scratch(spark, keep=before)
