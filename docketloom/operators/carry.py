"""Order-dependent operators over documents' lines: as-of carries, islands, look-ahead, gaps. All are windows inside a document,
with the order in an explicit position column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _before(doc: list[str], pos: str) -> Window:
    return Window.partitionBy(*doc).orderBy(pos).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def carry_forward(df: DataFrame, columns: dict[str, Column], doc: list[str], pos: str = "pos") -> DataFrame:
    """Each column becomes the last non-null value of its expression at or before the row (as-of, backward)."""
    return df.withColumns({name: F.last(value, ignorenulls=True).over(_before(doc, pos)) for name, value in columns.items()})


def carry_backward(df: DataFrame, columns: dict[str, Column], doc: list[str], pos: str = "pos") -> DataFrame:
    """Each column becomes the first non-null value of its expression at or behind the row (as-of, forward)."""
    w = Window.partitionBy(*doc).orderBy(pos).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    return df.withColumns({name: F.first(value, ignorenulls=True).over(w) for name, value in columns.items()})


def islands(df: DataFrame, boundary: Column, doc: list[str], pos: str = "pos", name: str = "island") -> DataFrame:
    """Number of boundaries at or before the row: rows between two boundaries share a number; 0 before the first."""
    return df.withColumn(name, F.sum(F.when(boundary, 1).otherwise(0)).over(_before(doc, pos)).cast("int"))


def fill_continuations(df: DataFrame, columns: list[str], reset: Column, doc: list[str], pos: str = "pos") -> DataFrame:
    """Blank cells take the value of the row above, chained, but never across a reset row. A reset row's blank cell counts as a value,
    so one window in the rows' order does both, and a task sorts its rows once."""
    shown = {c: F.coalesce(F.nullif(F.trim(F.col(c)), F.lit("")), F.when(reset, F.lit(""))) for c in columns}
    return carry_forward(df, shown, doc, pos).fillna("", subset=columns)


def until_next(df: DataFrame, start: str, end: Column, doc: list[str], name: str = "stop") -> DataFrame:
    """Where the next row of the document starts, or ``end`` for the last."""
    return df.withColumn(name, F.coalesce(F.lead(start).over(Window.partitionBy(*doc).orderBy(start)), end))


def missing_numbers(df: DataFrame, column: str, first: int = 1) -> DataFrame:
    """The integers from ``first`` to the greatest seen that don't occur (range against rows, anti join)."""
    spark = df.sparkSession
    top = df.agg(F.max(column)).first()[0] or first - 1
    seen = df.select(F.col(column).cast("long").alias("_seen"))
    return spark.range(first, top + 1).withColumnRenamed("id", column).join(seen, F.col(column) == F.col("_seen"), "left_anti")
