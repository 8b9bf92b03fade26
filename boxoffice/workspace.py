"""Where derived tables live: a folder under the cluster's shared checkpoint
folder, one sub-folder per input directory. Tables are written once and read
back by later loads, as staging and warehouse tables are in production."""

from __future__ import annotations

import hashlib
import os
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from boxoffice.session import setting, shared_root

DONE_MARKER = "_BOXOFFICE_DONE"
LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


# Tables written once are read through one DataFrame per path, so the file
# listing (thousands of day folders) is done once per process, not per query.
_READS: dict[tuple[str, str], DataFrame] = {}


def _code() -> str:
    """Digest of the sources that derive tables."""
    top = os.path.dirname(os.path.abspath(__file__))
    h = hashlib.sha1()
    for folder, dirs, names in sorted(os.walk(top)):
        if os.path.basename(folder) in ("llm", "__pycache__"):
            continue
        for n in sorted(x for x in names if x.endswith(".py") and x != "oracle.py"):
            with open(os.path.join(folder, n), "rb") as f:
                h.update(f.read())
    return h.hexdigest()


@contextmanager
def few_listing_tasks(spark: SparkSession):
    """List day-partitioned tables, which have thousands of folders, with a few
    tasks a core instead of one task a folder; the session's setting comes back
    afterwards."""
    with setting(spark, LISTING, str(max(16, 2 * spark.sparkContext.defaultParallelism))):
        yield


class Workspace:
    """Derived tables of one input directory. Their folder is named after the
    input files (path, size, time) and the code, so changed data or code is
    never answered from old tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        fs, hp = self._fs_path(self.sf_dir)
        found, it = [], fs.listFiles(hp, True)
        while it.hasNext():
            f = it.next()
            found.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
        tag = hashlib.sha1(repr((sorted(found), _code())).encode()).hexdigest()[:16]
        self.root = f"{shared_root(spark)}/boxoffice/{tag}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _fs_path(self, p: str):
        jvm = self.spark.sparkContext._jvm
        hp = jvm.org.apache.hadoop.fs.Path(p)
        return hp.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), hp

    def _exists(self, p: str) -> bool:
        fs, hp = self._fs_path(p)
        return fs.exists(hp)

    def folders(self, pattern: str) -> list[str]:
        """The paths that a pattern matches; meant for few."""
        fs, hp = self._fs_path(pattern)
        return sorted(s.getPath().toString() for s in fs.globStatus(hp) or [])

    def _mark_done(self, p: str) -> None:
        fs, hp = self._fs_path(p)
        fs.create(hp, True).close()

    def ensure(self, name: str, build: Callable[[str], None]) -> str:
        """Path of table ``name``, written by ``build(path)`` unless a completed
        copy (our marker, written after the build) is already there. Shuffle files
        of a build go when its write ends, not when the driver happens to collect
        its garbage: else a query's tables together need the disk for all of them."""
        p = self.path(name)
        if not self._exists(f"{p}/{DONE_MARKER}"):
            with setting(self.spark, CLEANUP, "true"):
                build(p)
            self._mark_done(f"{p}/{DONE_MARKER}")
        return p

    def parquet(self, name: str, make: Callable[[], DataFrame], partition_by: str | None = None) -> DataFrame:
        """Table ``name`` as Parquet, computed by ``make()`` on first use."""
        return self.table(self.ensure(name, self._writer(make, partition_by)))

    def table(self, p: str) -> DataFrame:
        """The Parquet table at ``p``, through one DataFrame per process."""
        key = (self.spark.sparkContext.applicationId, p)
        if key not in _READS:
            with few_listing_tasks(self.spark):
                _READS[key] = self.spark.read.parquet(p)
        return _READS[key]

    def _writer(self, make: Callable[[], DataFrame], partition_by: str | None) -> Callable[[str], None]:
        def build(p: str) -> None:
            df = make()
            if partition_by:
                from boxoffice.sources.tables import by_partition_value, writers_per_core
                with writers_per_core(self.spark):
                    (by_partition_value(df, partition_by).write.mode("overwrite").option("partitionOverwriteMode", "static")
                     .partitionBy(partition_by).parquet(p))
            else:
                df.write.mode("overwrite").parquet(p)
        return build
