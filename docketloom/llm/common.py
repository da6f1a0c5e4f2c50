"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

#: Rows in an Arrow batch. Whole texts travel to Python, so a batch holds few enough of them that even long ones fit.
ARROW_ROWS = 1024


def prepare(spark: SparkSession) -> None:
    """Bound the Arrow batches of this session and make sure that there is a checkpoint folder.

    The folder comes from ``spark.checkpoint.dir``; where that is unset one is chosen here in local mode, and nowhere else.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        import tempfile

        folder = context.getConf().get("spark.checkpoint.dir")
        if not folder and not (context.master or "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="docketloom-"))


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path in the folder that all executors share (a sibling of the checkpoint files)."""
    import uuid

    prepare(spark)
    return f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/{name}-{uuid.uuid4().hex}"


def unused(name: str, *frames: DataFrame) -> str:
    """A column name like ``name`` that no column of ``frames`` has, whatever its case."""
    taken = {c.lower() for df in frames for c in df.columns}
    while f"_{name}" in taken:
        name = f"{name}_"
    return f"_{name}"


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and go on from the written rows; survives lost executors."""
    prepare(df.sparkSession)
    return df.checkpoint(eager=True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; nulls are empty and the first offset is 0."""
    if column.null_count:
        column = pc.fill_null(column, "" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, ends, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(ends, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, offsets - offsets[0]


def give_back() -> None:
    """Return a worker's freed memory to the machine; allocators keep what they freed, and workers live on between stages."""
    pa.default_memory_pool().release_unused()
    if trim := _trim():
        trim(0)


@cache
def _trim():
    import ctypes

    try:
        return ctypes.CDLL("libc.so.6").malloc_trim
    except (OSError, AttributeError):  # another C library: nothing to ask
        return None


def slices(batch: pa.RecordBatch, column: str, most: int = 1_000_000) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of ``batch`` with at most ``most`` bytes in ``column`` each, but at least one row."""
    if not batch.num_rows:
        return
    _, ends = utf8(batch.column(column))
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(ends, ends[at] + most, "right")) - 1)
        yield batch.slice(at, to - at)
        at = to
    give_back()


def per_batch(df: DataFrame, make: Callable[[pa.RecordBatch], dict], schema: str, column: str = "text") -> DataFrame:
    """mapInArrow: ``make`` gives the columns of an output batch for each part of a batch with a bounded ``column``."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    kinds = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, column):
                made = make(part)
                yield pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x, f.type) for f, x in ((f, made[f.name]) for f in kinds)], schema=kinds)

    return df.mapInArrow(run, schema)
