"""Spark session helpers.

The cluster decides where lineage-cutting data goes (``spark.checkpoint.dir``);
we read that setting and only fall back to a private scratch folder when it is
unset, which is the local-test case.
"""

from __future__ import annotations

import os
import tempfile
import threading
import zipfile

from pyspark.sql import SparkSession

_DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # trials and folds that run side by side share the cluster
    "spark.scheduler.mode": "FAIR",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Wide fold-wise projections generate big methods; above ~8000 bytes of
    # bytecode the JVM stops JIT-compiling them, so let Spark split instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def get_spark(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "foldwise",
              extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with AQE and skew-join handling on."""
    b = SparkSession.builder.master(master).appName(app)
    conf = dict(_DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "16g")
    if extra:
        conf.update(extra)
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and written intermediates.

    Uses the cluster's ``spark.checkpoint.dir`` (or a directory already set on
    the context); only when neither exists and the master is local (tests) a
    scratch folder is created and registered.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        try:
            conf_dir = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset key
            conf_dir = None
    if not conf_dir and (not sc.master.startswith("local") or sc.master.startswith("local-cluster")):
        raise RuntimeError("spark.checkpoint.dir is not set: a cluster needs a folder that all its machines share")
    if not conf_dir:
        conf_dir = tempfile.mkdtemp(prefix="foldwise-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def cut_lineage(df):
    """Reliable checkpoint that runs the plan once.

    ``checkpoint(eager=True)`` counts the rows and then writes the checkpoint
    files in a second job that recomputes the plan unless it is cached; caching
    first makes the write read the cached blocks. The cache is released once
    the checkpoint files exist (later reads use the files, which survive
    executor loss)."""
    from pyspark import StorageLevel
    cached = df.persist(StorageLevel.MEMORY_AND_DISK)
    out = cached.checkpoint(eager=True)
    cached.unpersist()
    return out


_SHIPPED: set[str] = set()
_SHIPPING = threading.Lock()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers (once per application), so that plans with Python
    stages run wherever the driver was started and whatever the executors have installed. Threads
    that build fold models at the same time wait for the first one: a second file of that name is an error."""
    app = spark.sparkContext.applicationId
    with _SHIPPING:
        if app in _SHIPPED:
            return
        package = os.path.dirname(os.path.abspath(__file__))
        archive = os.path.join(tempfile.mkdtemp(prefix="foldwise-py-"), "foldwise.zip")
        with zipfile.ZipFile(archive, "w") as out:
            for folder, _, names in os.walk(package):
                for name in names:
                    if name.endswith(".py"):
                        path = os.path.join(folder, name)
                        out.write(path, os.path.join("foldwise", os.path.relpath(path, package)))
        spark.sparkContext.addPyFile(archive)
        _SHIPPED.add(app)
