"""Publishing a table: its rows are written once to a staging folder and measured as they are, and only if every guard holds does
the finished output take the place of the old one.

The new output is written beside the target and put in its place by renames; whatever fails before that leaves the old output as
it is and no folder behind. A run that was killed between the renames is put right by the next one (:func:`recovered`).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession

from ..written import Files, beside


@contextmanager
def staged(df: DataFrame, target: str, metrics: Mapping[str, Column], folder: str | None = None) -> Iterator[tuple[DataFrame, Row]]:
    """The rows of ``df``, written once beside ``target`` (or in ``folder``), and their metrics, observed in that write. The staging folder is gone
    afterwards, whatever happens."""
    seen = Observation()
    place = beside(f"{folder.rstrip('/')}/{target.rstrip('/').rpartition('/')[2]}" if folder else target, "staging")
    try:
        df.observe(seen, *(c.alias(name) for name, c in metrics.items())).write.parquet(place)
        yield df.sparkSession.read.parquet(place), seen.get
    finally:
        Files(df.sparkSession).remove(place)


def recovered(spark: SparkSession, target: str) -> None:
    """Put back the old output of a publish that was broken off between its renames, and drop what broken publishes left."""
    files = Files(spark)
    old = files.beside(target, "old")
    if old and not files.exists(target):
        files.move(old.pop(), target)
    for path in [*old, *files.beside(target, "new")]:
        files.remove(path)


def published(spark: SparkSession, target: str, write: Callable[[str], int]) -> int:
    """What ``write`` writes to the path it gets takes the place of ``target``; gives what it gives."""
    recovered(spark, target)
    files, new = Files(spark), beside(target, "new")
    try:
        n = write(new)
    except BaseException:
        files.remove(new)
        raise
    if not files.exists(target):
        files.move(new, target)
        return n
    old = beside(target, "old")
    files.move(target, old)
    try:
        files.move(new, target)
    except BaseException:
        files.move(old, target)
        files.remove(new)
        raise
    files.remove(old)
    return n
