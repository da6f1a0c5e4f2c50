"""Wide rows: fixed, ordered string columns in which a missing value is the empty string."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Columns that every dataset shares where its source has them.
CORE = ("row_key", "source_agency_code", "case_number", "canonical_case_type", "native_case_type", "employer_name", "union_name", "jurisdiction_city", "jurisdiction_state", "employer_street", "employer_zip", "source_page_url", "source_url", "scraped_at")


def to_wide(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exactly ``columns``, as strings: extra columns go, missing ones and nulls are empty."""
    have = set(df.columns)
    return df.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) if c in have else F.lit("").alias(c) for c in columns))


def flag(condition) -> object:
    """true, false or nothing, for a condition that may be unknown."""
    return F.when(condition, F.lit("true")).when(~condition, F.lit("false")).otherwise(F.lit(""))


def across_agencies(frames: Sequence[DataFrame]) -> DataFrame:
    """The core columns of several datasets in one view."""
    return to_wide(_union(frames), CORE)


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    first, *rest = frames
    for f in rest:
        first = first.unionByName(f, allowMissingColumns=True)
    return first
