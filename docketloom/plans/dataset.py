"""What a dataset is: landed inputs, one transformation, columns, key, order and guards."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import blank
from ..operators import keys, quality
from ..operators.ordinals import with_places
from ..schema import to_wide
from ..sources import publish as publishing
from ..sources.sinks import write_csv
from ..written import settled

REGISTRY: dict[str, Dataset] = {}
PLACE = ("jurisdiction_city", "jurisdiction_state", "employer_street", "employer_zip")
ENDS = ("source_page_url", "source_url", "scraped_at")


@dataclass(frozen=True)
class Dataset:
    """``build`` gets the landed frames by name and gives rows; constants, missing columns and order are added here."""

    slug: str
    description: str
    agency: str
    columns: Sequence[str]
    inputs: Mapping[str, str]  # name of a landed frame to its schema
    build: Callable[[Mapping[str, DataFrame], str], DataFrame]
    order: Sequence[str]  # a minus in front of a column is descending
    constants: Mapping[str, str] = field(default_factory=dict)
    unique: bool = False
    least: int = 1
    first_wins: tuple[Sequence[str], Sequence[str]] | None = None
    totals: Callable[[Mapping[str, DataFrame]], tuple] | None = None  # frames to (stated, off, *by) of quality.require_totals
    failures: tuple[str, str, str, float] | None = None  # the frame of documents; SQL over rows: one was asked for, it failed; the share that may

    @property
    def csv_name(self) -> str:
        return self.slug.replace("-", "_") + ".csv"

    def rows(self, frames: Mapping[str, DataFrame], scraped_at: str, as_of: str) -> DataFrame:
        """All rows as wide strings, unordered and unchecked."""
        made = self.build(frames, as_of)
        if self.first_wins:
            key, order = self.first_wins
            made = keys.first_wins(made, list(key), list(order))
        fixed = {"source_agency_code": self.agency, **self.constants, "scraped_at": scraped_at}
        return made.withColumns({k: F.lit(v) for k, v in fixed.items()})

    def table(self, frames: Mapping[str, DataFrame], scraped_at: str, as_of: str, staging: str | None = None) -> DataFrame:
        """The dataset: checked, in order, its columns alone. The rows are written first, in the folder ``staging`` or else in the
        session's shared one, so that guards, order and sink read them and nothing is parsed twice."""
        made = self.rows(frames, scraped_at, as_of)
        if staging:
            place = f"{staging.rstrip('/')}/{self.slug}"
            made.write.mode("overwrite").parquet(place)
            made = made.sparkSession.read.parquet(place)
        else:
            made = settled(made)
        quality.require(made, self.slug, least=self.least, unique="row_key" if self.unique else None)
        if self.totals:
            quality.require_totals(made, self.slug, *self.totals(frames))
        order = [F.desc(c[1:]) if c.startswith("-") else F.asc(c) for c in self.order]
        return to_wide(made.orderBy(*order), self.columns)

    def positions(self, frames: Mapping[str, DataFrame], scraped_at: str, as_of: str) -> DataFrame:
        """The dataset's rows with ``position``, each one's place (from 1) in the dataset's order, by ranges and not in one task."""
        order = [F.desc(c[1:]) if c.startswith("-") else F.asc(c) for c in self.order]
        return with_places(self.rows(frames, scraped_at, as_of), order, name="position")

    def publish(self, frames: Mapping[str, DataFrame], target: str, scraped_at: str, as_of: str, single: bool = True, staging: str | None = None) -> int:
        """The dataset as CSV in the place of ``target``, or a :class:`GuardError` and the old output. The rows are parsed and written
        once, and the guards that a single pass can judge are measured in that write; gives the number of rows."""
        made = self.rows(frames, scraped_at, as_of)
        metrics = {"rows": F.count(F.lit(1))}
        read = self.failures is not None and not frames[self.failures[0]].isEmpty()  # where no document was landed, none was asked for
        if read:
            _, asked, failed, _ = self.failures
            metrics |= {"asked": F.count_if(F.expr(asked)), "failed": F.count_if(F.expr(failed))}
        order = [F.desc(c[1:]) if c.startswith("-") else F.asc(c) for c in self.order]
        with publishing.staged(made, target, metrics, staging) as (rows, seen):
            quality.enough(self.slug, seen["rows"], self.least)
            if read:
                quality.few_failures(self.slug, seen["failed"], seen["asked"], self.failures[3])
            if self.unique:
                quality.no_repeats(rows, self.slug, "row_key")
            if self.totals:
                quality.require_totals(rows, self.slug, *self.totals(frames))
            ordered = to_wide(rows.orderBy(*order), self.columns)
            return publishing.published(rows.sparkSession, target, lambda path: write_csv(ordered, path, self.columns, single))


def dataset(**spec) -> Callable:
    """Register the decorated function as the ``build`` of a dataset."""

    def register(f: Callable) -> Callable:
        made = Dataset(build=f, description=(f.__doc__ or "").strip().split("\n")[0].rstrip("."), **spec)
        REGISTRY[made.slug] = made
        return f

    return register


def get(slug: str) -> Dataset:
    """The dataset of a slug, however it is written; KeyError if there is none."""
    return REGISTRY[slug.strip().lower().replace("_", "-")]


def key(agency: str, *parts: Column | str) -> Column:
    return keys.row_key(F.lit(agency), *parts)


def or_else(*choices: Column | str) -> Column:
    """The first that isn't blank; blank if all are."""
    return blank(F.coalesce(*(F.nullif(F.col(c) if isinstance(c, str) else c, F.lit("")) for c in choices)))


def first_clause(c: Column, most: int = 80) -> Column:
    """What stands before the first comma."""
    return F.substring(F.trim(F.substring_index(c, ",", 1)), 1, most)


def without_place_word(c: Column, words: str = "City|Town|County|Borough", article: bool = False) -> Column:
    """"City of X" as "X"."""
    return F.regexp_replace(F.trim(c), rf"(?i)^(?:{words})\s+of\s+" + (r"(?:the\s+)?" if article else ""), "")
