"""Session helpers: a local session for tests and benches, and the shared
checkpoint folder taken from the session (``spark.checkpoint.dir``)."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

from .errors import CheckpointError


def local_session(cores: str = "*", shuffle_partitions: int = 8, app: str = "touchline") -> SparkSession:
    """A local session configured the way the tests and ``bench.py`` use it."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("TOUCHLINE_DRIVER_MEMORY", "8g"))
        .config(
            "spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        )
        .getOrCreate()
    )


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster.

    Read from the session; only a local-mode session without one gets a fresh
    folder of its own (tests).  A cluster session without one is an error: a
    machine-local folder would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if conf:
        sc.setCheckpointDir(conf)
        return sc.getCheckpointDir() or conf
    if not sc.master.startswith("local"):
        raise CheckpointError("set spark.checkpoint.dir to a shared folder for this cluster")
    folder = tempfile.mkdtemp(prefix="touchline-ckpt-")
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir() or folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the checkpoint root for job-owned outputs."""
    root = checkpoint_root(spark).rstrip("/")
    import uuid

    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"


def reliable_checkpoint(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the shared folder (eager).

    Keeps the partitions and their order (needed by ``with_rank``).  The frame
    is persisted first: an eager checkpoint otherwise computes it twice (once
    to count, once to write the files).
    """
    from pyspark import StorageLevel

    checkpoint_root(df.sparkSession)
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return kept.checkpoint(eager=True)
    finally:
        kept.unpersist()


def checkpoint_table(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage by writing ``df`` as a Parquet table under the checkpoint
    folder and reading it back: one job, columnar, and later reads prune
    columns.  Partition order is not kept (use :func:`reliable_checkpoint`)."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers (``--py-files`` at runtime).

    Only the streaming processor runs Python on executors; it is pickled by
    reference to this package, so the package is zipped once per
    SparkContext and added with ``addPyFile`` (Spark distributes it).
    """
    sc = spark.sparkContext
    if getattr(sc, "_touchline_shipped", False):
        return
    import zipfile

    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg_dir)
    out = os.path.join(tempfile.mkdtemp(prefix="touchline-pyfiles-"), "touchline.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as zf:
        for folder, _, files in os.walk(pkg_dir):
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    zf.write(full, os.path.relpath(full, root))
    sc.addPyFile(out)
    # the driver-side runner that checks the state schema starts from the
    # worker environment, not from the shipped files: put the zip on its path
    paths = [out] + [p for p in sc.environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    sc.environment["PYTHONPATH"] = os.pathsep.join(paths)
    sc._touchline_shipped = True
