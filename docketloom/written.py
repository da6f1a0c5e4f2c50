"""Rows that are written once in the folder that all executors share, so that what reads them twice doesn't make them twice."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; where that is unset one is made in local mode, and nowhere else."""
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        folder = context.getConf().get("spark.checkpoint.dir")
        if not folder and not (context.master or "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="docketloom-"))
    return context._jsc.sc().getCheckpointDir().get()


def settled(df: DataFrame) -> DataFrame:
    """``df``, written (its partitions and their order stay): later reads survive lost executors and give the same rows."""
    shared(df.sparkSession)
    return df.checkpoint(eager=True)


def beside(path: str, kind: str) -> str:
    """A new hidden path in the folder of ``path``."""
    folder, _, name = path.rstrip("/").rpartition("/")
    return f"{folder}/.{name}.{kind}-{uuid.uuid4().hex}" if folder or path.startswith("/") else f".{name}.{kind}-{uuid.uuid4().hex}"


class Files:
    """Paths of any store that Spark reads: what a publish needs of them."""

    def __init__(self, spark: SparkSession):
        self._path, self._conf = spark._jvm.org.apache.hadoop.fs.Path, spark._jsc.hadoopConfiguration()

    def _of(self, path: str):
        place = self._path(path)
        return place.getFileSystem(self._conf), place

    def exists(self, path: str) -> bool:
        store, place = self._of(path)
        return store.exists(place)

    def remove(self, path: str) -> None:
        store, place = self._of(path)
        store.delete(place, True)

    def move(self, path: str, to: str) -> None:
        store, place = self._of(path)
        if not store.rename(place, self._path(to)):
            raise OSError(f"{path} can't be moved to {to}")

    def beside(self, path: str, kind: str) -> list[str]:
        """The paths of a kind that :func:`beside` gave for ``path`` and that exist."""
        store, place = self._of(path)
        pattern = self._path(place.getParent() or self._path("."), f".{place.getName()}.{kind}-*")
        return sorted(x.getPath().toString() for x in store.globStatus(pattern) or [])
