"""Row keys, ordinals, first-wins and best-row merges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import blank
from ..written import settled
from .ordinals import with_places


def row_key(*parts: Column | str) -> Column:
    """Parts joined with colons; a missing part is empty, so no key is ever null."""
    return F.concat_ws(":", *(blank(F.col(p) if isinstance(p, str) else p) for p in parts))


def capped_key(base: Column, most: int = 124) -> Column:
    """A key of at most ``most`` characters: a longer one ends with the first ten digits of its SHA-1."""
    short = F.concat(F.substring(base, 1, most - 12), F.lit(":H"), F.substring(F.sha1(F.encode(base, "UTF-8")), 1, 10))
    return F.when(F.length(base) > most, short).otherwise(base)


def with_ordinals(df: DataFrame, base: str, order: list, name: str = "row_key") -> DataFrame:
    """``base`` as ``name``, with :2, :3, … behind it from its second row on, in ``order``. A base of any number of rows is dealt
    to many tasks (:mod:`.ordinals`)."""
    made = with_places(df, order, [base], "_n")
    own = F.when(F.col("_n") == 1, F.col(base)).otherwise(F.concat_ws(":", base, F.col("_n").cast("string")))
    return made.withColumn(name, own).drop("_n")


def first_wins(df: DataFrame, key: list[Column | str], order: list[str]) -> DataFrame:
    """The first row of each key in ``order``. A minimum per key, so rows are combined before the shuffle."""
    keys = [(F.col(k) if isinstance(k, str) else k).alias(f"_key{i}") for i, k in enumerate(key)]
    rest = [c for c in df.columns if c not in order]
    packed = F.struct(*order, *rest)
    return df.groupBy(*keys).agg(F.min_by(packed, F.struct(*order)).alias("_row")).select(*(F.col(f"_row.{c}").alias(c) for c in df.columns))


def prefer_filled(df: DataFrame, key: str, arrival: str, first: str, second: str) -> DataFrame:
    """One row for each key, the last that a walk over its arrivals holds: a row takes the place of the held one if it fills
    ``first`` where that is blank there, or else fills ``second`` where that is blank.

    The held row fills both, one, or none. One that fills both is never replaced, and the first such row replaces whatever is
    held; without one, rows that fill only ``first`` and rows that fill only ``second`` take turns, so the walk ends at the first row
    of the last turn: the first of the kind that came last behind the last of the other kind. All that are minima and maxima of
    a key, combined before the shuffle; only keys with two kinds and no full row are read a second time. Rows of one
    arrival are walked with the emptier, then the ``second`` one first."""
    row, at = F.struct(*df.columns), F.struct(F.col(arrival).alias("at"), F.col("_a").alias("a"), F.col("_b").alias("b"))
    filled = lambda c: blank(F.col(c)) != ""
    marked = df.select(row.alias("_row"), F.col(key).alias("_key"), filled(first).alias("_a"), filled(second).alias("_b"), F.col(arrival)).withColumn("_at", at)
    only = {"a": F.col("_a") & ~F.col("_b"), "b": ~F.col("_a") & F.col("_b")}
    best = lambda when: F.min_by(F.when(when, F.col("_row")), F.when(when, F.col("_at")))
    seen = marked.groupBy("_key").agg(
        F.min_by("_row", "_at").alias("any"), best(F.col("_a") & F.col("_b")).alias("full"),
        *(best(c).alias(f"first_{k}") for k, c in only.items()), *(F.max(F.when(c, F.col("_at"))).alias(f"last_{k}") for k, c in only.items()),
    )
    seen = settled(seen)
    turns = seen.filter("full is null and last_a is not null and last_b is not null")
    turns = turns.select(F.col("_key").alias("_turn"), (F.col("last_a") > F.col("last_b")).alias("_by_a"), F.least("last_a", "last_b").alias("_since"))
    late = marked.filter(only["a"] | only["b"]).join(turns, F.col("_key").eqNullSafe(F.col("_turn"))).filter((F.col("_a") == F.col("_by_a")) & (F.col("_at") > F.col("_since")))
    turned = late.groupBy("_turn").agg(F.min_by("_row", "_at").alias("turned"))
    won = seen.join(turned, F.col("_key").eqNullSafe(F.col("_turn")), "left").select(F.coalesce("full", "turned", "first_a", "first_b", "any").alias("_row"))
    return won.select(*(F.col(f"_row.{c}").alias(c) for c in df.columns))


def content_signature(*columns: str) -> Column:
    """An aggregate: a digest of a group's rows as a multiset, whatever their order. The rows' SHA-256 digests are added up in four
    parts of 60 bits, beside their number, so that groups of any size are combined before the shuffle."""
    row = F.sha2(F.concat_ws("\x1f", *(blank(F.col(c)) for c in columns)), 256)
    parts = [F.sum(F.conv(F.substring(row, 1 + 15 * k, 15), 16, 10).cast("decimal(20,0)")).cast("string") for k in range(4)]
    return F.sha2(F.concat_ws(",", F.count("*").cast("string"), *parts), 256)
