"""Counts of outcomes, guards that fail a run, and the comparison of two runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import blank
from ..written import settled
from .ordinals import with_places


class GuardError(RuntimeError):
    """A dataset breaks one of its guards."""


def outcome_counts(df: DataFrame, *columns: str) -> DataFrame:
    """How often each combination of ``columns`` occurs."""
    return df.groupBy(*columns).agg(F.count("*").alias("n"))


def counters(df: DataFrame, conditions: dict[str, Column], *by: str) -> DataFrame:
    """The number of rows, ``n``, and of those for each condition, in one pass: one row, or one for each group of ``by``."""
    return df.groupBy(*by).agg(F.count("*").alias("n"), *(F.count_if(c).alias(name) for name, c in conditions.items()))


def enough(name: str, rows: int, least: int) -> None:
    """At least ``least`` rows, or a :class:`GuardError`."""
    if rows < least:
        raise GuardError(f"{name}: {rows} rows, at least {least} expected")


def few_failures(name: str, failed: int, asked: int, most: float) -> None:
    """At most ``most`` of the documents asked for failed (five always may), or a :class:`GuardError`."""
    if failed > max(5, most * asked):
        raise GuardError(f"{name}: {failed} of {asked} documents failed")


def no_repeats(df: DataFrame, name: str, key: str) -> None:
    """No value of ``key`` occurs twice, or a :class:`GuardError`; only that column is read, and counts are combined before the shuffle."""
    more = df.groupBy(key).agg(F.count("*").alias("n")).filter("n > 1").agg(F.sum(F.col("n") - 1).alias("n")).first().n
    if more:
        raise GuardError(f"{name}: {more} repeated keys")


def require(df: DataFrame, name: str, least: int = 1, unique: str | None = None, expected: int | None = None, ratio: float | None = None, slack: int | None = None, failures: Column | None = None, most_failures: float = 0.05) -> DataFrame:
    """``df``, after one pass over it that raises :class:`GuardError` for too few rows, a repeated key, a count that differs from
    ``expected`` (by more than ``slack``, or below ``ratio`` of it), or too large a share of failures (five always pass)."""
    ask = [F.count("*").alias("rows")]
    ask += [F.count_distinct(unique).alias("keys")] if unique else []
    ask += [F.count_if(failures).alias("failed")] if failures is not None else []
    got = df.agg(*ask).first()
    enough(name, got.rows, least)
    if unique and got["keys"] != got.rows:
        raise GuardError(f"{name}: {got.rows - got['keys']} repeated keys")
    if expected is not None and (ratio is not None and got.rows < ratio * expected or slack is not None and abs(got.rows - expected) > slack or ratio is None and slack is None and got.rows != expected):
        raise GuardError(f"{name}: {got.rows} rows, the source states {expected}")
    if failures is not None:
        few_failures(name, got.failed, got.rows, most_failures)
    return df


def off_totals(df: DataFrame, stated: DataFrame, off: Column, *by: str) -> DataFrame:
    """The groups of ``by`` (or all rows) whose number of rows is ``off`` from what a source states: by, rows and total."""
    counts = df.groupBy(*by, F.lit(0).alias("_all")).agg(F.count("*").alias("rows"))
    both = stated.filter("total is not null").withColumn("_all", F.lit(0)).join(counts, [*by, "_all"], "left")
    return both.withColumn("rows", F.coalesce("rows", F.lit(0))).filter(off).select(*by, "rows", "total")


def require_totals(df: DataFrame, name: str, stated: DataFrame, off: Column, *by: str) -> DataFrame:
    """``df``, after one pass over it that raises :class:`GuardError` where the number of its rows, in all or for each group of
    ``by``, is ``off`` from what a source states: a condition on ``rows`` and ``total``, the columns of ``stated`` (by, total)."""
    wrong = off_totals(df, stated, off, *by).limit(1).collect()
    if wrong:
        raise GuardError(f"{name}: {wrong[0].rows} rows{''.join(f', {c} {wrong[0][c]}' for c in by)}; the source states {wrong[0].total}")
    return df


def bucket(old: Column, new: Column) -> Column:
    """same, filled, emptied or changed."""
    a, b = blank(old), blank(new)
    return F.when(a == b, F.lit("same")).when(a == "", F.lit("filled")).when(b == "", F.lit("emptied")).otherwise(F.lit("changed"))


def replay(old: DataFrame, new: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Old and new values of ``columns`` side by side with a bucket each: the difference of two multisets, so a key of n and m rows
    gives as many rows as the larger. Rows of a key with equal values are paired first (they are counted, not joined), the others by
    their ordinals in the order of their values; a row of only one run counts as blank in the other. Nulls are blank."""
    own = lambda df, sign: df.select(F.col(key).alias("_key"), F.struct(*(blank(F.col(c).cast("string")).alias(c) for c in columns)).alias("_v"), F.lit(sign).alias("_sign"))
    both = own(old, 1).union(own(new, -1))
    counts = both.groupBy("_key", "_v").agg(F.count_if(F.col("_sign") > 0).alias("_old"), F.count_if(F.col("_sign") < 0).alias("_new"))
    counts = settled(counts.withColumn("_same", F.least("_old", "_new")))
    times = lambda df, n: df.filter(n > 0).withColumn("_each", F.explode(F.sequence(F.lit(1).cast("long"), n)))
    same = times(counts, F.col("_same")).select("_key", F.col("_v").alias("_o"), F.col("_v").alias("_n"))
    left, right = (with_places(times(counts, F.col(c) - F.col("_same")).select("_key", "_v"), ["_v"], ["_key"], "_at") for c in ("_old", "_new"))
    right = right.select(F.col("_key").alias("_key2"), F.col("_v").alias("_n"), F.col("_at").alias("_at2"))
    paired = left.withColumnRenamed("_v", "_o").join(right, F.col("_key").eqNullSafe(F.col("_key2")) & (F.col("_at") == F.col("_at2")), "full_outer")
    paired = paired.select(F.when(F.col("_at").isNull(), F.col("_key2")).otherwise(F.col("_key")).alias("_key"), "_o", "_n")
    made = same.union(paired).select(F.col("_key").alias(key), *(F.col(f"_o.{c}").alias(f"old_{c}") for c in columns), *(F.col(f"_n.{c}").alias(f"new_{c}") for c in columns))
    return made.withColumns({f"{c}_bucket": bucket(F.col(f"old_{c}"), F.col(f"new_{c}")) for c in columns})


def replay_counts(compared: DataFrame, columns: list[str]) -> DataFrame:
    """(side, bucket, n) over the compared columns."""
    sides = F.explode(F.array(*(F.struct(F.lit(c).alias("side"), F.col(f"{c}_bucket").alias("bucket")) for c in columns)))
    return compared.select(sides.alias("s")).groupBy("s.side", "s.bucket").agg(F.count("*").alias("n"))


def changed_rows(compared: DataFrame, columns: list[str]) -> DataFrame:
    """The rows in which a bucket isn't same: what a diff file holds."""
    changed = F.lit(False)
    for c in columns:
        changed = changed | (F.col(f"{c}_bucket") != "same")
    return compared.filter(changed)
