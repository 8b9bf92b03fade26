"""Spark session and shared-folder helpers."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import zipfile
from contextlib import contextmanager

from pyspark.sql import SparkSession


def get_session(master: str | None = None, app: str = "boxoffice",
                shuffle_partitions: int | None = None) -> SparkSession:
    """Session with AQE (coalescing + skew-join splitting) switched on.

    On a cluster ``master`` stays None and the submit command decides; tests
    pass ``local[N]``.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            # local mode runs every task inside the driver JVM
            builder = builder.config("spark.driver.memory", "16g")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = (builder
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.adaptive.enabled", "true")
             .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
             .config("spark.sql.adaptive.skewJoin.enabled", "true")
             .config("spark.sql.session.timeZone", "UTC")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@contextmanager
def setting(spark: SparkSession, key: str, value: str):
    """A session setting for the time of a block; the old one comes back afterwards."""
    old = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if old is None else spark.conf.set(key, old)


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors (as --py-files does), once per application: Python
    functions that run there find it. The driver's copy goes when the driver ends."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    top = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp()
    atexit.register(shutil.rmtree, folder, True)
    target = os.path.join(folder, "boxoffice_code.zip")
    with zipfile.ZipFile(target, "w") as z:
        for where, _, names in sorted(os.walk(top)):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(where, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(top)))
    spark.sparkContext.addPyFile(target)
    _SHIPPED.add(app)


def shared_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and written intermediate tables.

    Taken from ``spark.checkpoint.dir`` as the cluster sets it. Only when it is
    unset and the master is local do we pick a folder of our own and register it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = os.path.join(tempfile.gettempdir(), "boxoffice-checkpoints")
        os.makedirs(root, exist_ok=True)
        spark.sparkContext.setCheckpointDir(root)
    elif spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")
