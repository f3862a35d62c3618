"""Sessions, shared scratch tables and shipping the package to executors."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()
#: Shuffle files go with the write that made them.
_FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(cores: int = 8, partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for one machine, with the settings the tests and the benchmark use."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("rowloom")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )


def ship(spark: SparkSession) -> SparkSession:
    """Make the package importable in Python workers, wherever they start; once per application."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        root = Path(__file__).parent
        path = os.path.join(tempfile.mkdtemp(), "rowloom_package.zip")
        with zipfile.ZipFile(path, "w") as z:
            for p in sorted(root.rglob("*.py")):
                z.write(p, str(Path(root.name) / p.relative_to(root)))
        context.addPyFile(path)  # the driver's file server hands it to every executor
    _shipped.add(context.applicationId)
    return spark


def _shared_folder(spark: SparkSession) -> str:
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        own = spark.sparkContext._jsc.sc().getCheckpointDir()
        folder = own.get() if own.isDefined() else None
    if not folder:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="rowloom-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder


class Scratch:
    """Tables in the shared folder that cut lineage: every executor can read them after any other is lost.

    `keep` writes a frame and returns it read back, `free`: without waiting for a garbage collection until the shuffle
    files of its making go; `drop` removes one that no later plan reads. What is left is
    removed when the program ends, as the lazily evaluated result of an operator still reads it.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = f"{_shared_folder(spark)}/rowloom-{uuid.uuid4().hex}"
        self._n = 0
        self._paths: dict[int, str] = {}
        atexit.register(self._remove, self.root)

    def keep(self, df: DataFrame, free: bool = False) -> DataFrame:
        self._n += 1
        path = f"{self.root}/{self._n}"
        before = self.spark.conf.get(_FREED)
        try:
            self.spark.conf.set(_FREED, str(free or before == "true").lower())
            df.write.option("compression", "zstd").parquet(path)
        finally:
            self.spark.conf.set(_FREED, before)
        out = self.spark.read.schema(df.schema).parquet(path)
        self._paths[id(out)] = path
        return out

    def folder(self) -> str:
        """A new folder for files of another kind."""
        self._n += 1
        path = f"{self.root}/{self._n}"
        jvm = self.spark.sparkContext._jvm
        at = jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(at)
        return path

    def drop(self, df: DataFrame) -> None:
        if path := self._paths.pop(id(df), None):
            self._remove(path)

    def _remove(self, path: str) -> None:
        try:
            jvm = self.spark.sparkContext._jvm
            at = jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
        except Exception:  # the session may be gone already
            pass
