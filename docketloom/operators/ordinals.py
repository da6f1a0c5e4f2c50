"""Places of rows in a global or keyed order, without one task that holds a key or all rows.

Rows are range-partitioned by (key, order), so that a key of any size lies in as many parts as its rows fill, sorted in each part,
and written. A row's place is its place in the part, plus the rows of its key in the parts before: a table of one row for each
part, and one more for each key. Rows that tie in the order are told apart by where they come from, so that a third of all rows
may be equal and still be dealt to many parts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..written import settled

_LOW = (1 << 33) - 1  # of monotonically_increasing_id: the row's place in its partition


def _unused(name: str, df: DataFrame) -> str:
    taken = {c.lower() for c in df.columns}
    while f"_{name}" in taken:
        name = f"{name}_"
    return f"_{name}"


def ranges(df: DataFrame, *order: Column | str) -> tuple[DataFrame, str, str]:
    """``df`` in ascending parts, sorted in each, written; with the names of two more columns, the part and the place in it."""
    tie, part, here = (_unused(x, df) for x in ("tie", "part", "here"))
    told = settled(df).withColumn(tie, F.monotonically_increasing_id())
    spread = told.repartitionByRange(*order, tie).sortWithinPartitions(*order, tie).drop(tie)
    return settled(spread.withColumns({part: F.spark_partition_id(), here: F.monotonically_increasing_id().bitwiseAND(F.lit(_LOW))})), part, here


def with_places(df: DataFrame, order: Sequence[Column | str], by: Sequence[str] = (), name: str = "place") -> DataFrame:
    """``df`` with the place (from 1) of each row in ``order``, among all rows or those with equal ``by``; nulls are equal there. A
    column that is already named ``name`` is replaced."""
    held, part, here = ranges(df, *by, *order)
    before = Window.partitionBy(*by).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    rows, low = _unused("rows", held), _unused("low", held)
    counts = held.groupBy(*by, part).agg(F.count("*").alias(rows), F.min(here).alias(low))
    of, add = _unused("of", held), _unused("add", held)
    base = counts.select(*(F.col(c).alias(f"{of}{k}") for k, c in enumerate(by)), F.col(part).alias(of), (F.coalesce(F.sum(rows).over(before), F.lit(0)) - F.col(low) + 1).alias(add))
    same = F.col(part) == F.col(of)
    for k, c in enumerate(by):
        same = same & F.col(c).eqNullSafe(F.col(f"{of}{k}"))
    made = held.join(base, same)
    return made.select(*(c for c in df.columns if c != name), (F.col(here) + F.col(add)).alias(name))


def descents(parts: DataFrame, part: str, *order: str) -> DataFrame:
    """Pairs of neighbouring parts whose boundary descends, of rows that should ascend over their parts: none if they do. One row
    of bounds for each part is compared."""
    bounds = parts.groupBy(part).agg(F.min(F.struct(*order)).alias("least"), F.max(F.struct(*order)).alias("most"))
    w = Window.orderBy(part)
    pairs = bounds.select(F.lag(part).over(w).alias("before"), F.col(part).alias("behind"), F.lag("most").over(w).alias("most"), "least")
    return pairs.filter("most > least")
