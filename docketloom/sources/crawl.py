"""Discovery: from an index over its year pages to the documents, as a fixpoint over tables.

A crawl goes round after round: the frontier (the addresses found and not yet visited) is written, its pages are fetched or looked
up among landed ones, the rules say which of their links lead on and to what level, and what no round has visited is the next
frontier. Rounds end when a frontier is empty. Every round is a table in the crawl's folder, so a crawl that was broken off
goes on where it stopped and fetches nothing twice, and addresses never reach the driver: it sees one number a round.

An address is visited once, in the first round that reaches it; of several links to it there, the one of the smallest parent and
place in its page counts. Links of a rule with ``once`` are one address if they have one value (a year that is linked twice). An
address is fetched only if its level leads on; others, the documents, are listed.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.text import absolute_url, blank
from ..written import Files
from .landing import decoded, fetch
from .paging import Fetcher, fetch_table
from .tables import link_rows

#: A frontier of addresses (url) to their pages (url, status, html).
Pages = Callable[[DataFrame], DataFrame]
_FRONTIER = "name string, url string, level string, value string, depth int, parent string, pos int, label string"


@dataclass(frozen=True)
class Rule:
    """Links on pages of level ``of`` for which ``when(url, label)`` holds lead to level ``to``; the first such rule counts. ``value``
    is what the link says of its target, such as a year."""

    of: str
    to: str
    when: Callable[[Column, Column], Column]
    value: Callable[[Column, Column], Column] | None = None
    once: bool = False


def from_web(fetcher: Fetcher = fetch, delay: float = 0.3) -> Pages:
    """Pages are fetched, each host's in one partition with a delay."""

    def pages(frontier: DataFrame) -> DataFrame:
        return fetch_table(frontier, fetcher, delay).select("url", "status", F.when(F.col("status") == "ok", decoded(F.col("content"))).alias("html"))

    return pages


def from_landed(landed: DataFrame) -> Pages:
    """Pages are looked up among ``landed`` (url, html), which has each address once."""

    def pages(frontier: DataFrame) -> DataFrame:
        have = landed.select("url", F.lit("ok").alias("status"), "html")
        return frontier.join(have, "url", "left").withColumn("status", F.coalesce("status", F.lit("missing")))

    return pages


def _followed(page: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """The links of a round's pages that a rule follows, as rows of a frontier."""
    links = link_rows(page.filter("html is not null").select("level", F.col("url").alias("parent"), "depth", "html"))
    href = F.replace(F.col("href"), F.lit("&amp;"), F.lit("&"))
    links = links.filter("href <> ''").withColumn("url", F.regexp_replace(absolute_url(F.col("parent"), href), "#.*$", ""))
    url, label, target = F.col("url"), F.col("label"), None
    for rule in rules:
        value = blank(rule.value(url, label)) if rule.value else F.lit("")
        name = F.concat_ws("|", F.lit(rule.to), value) if rule.once else url
        made = F.struct(F.lit(rule.to).alias("to"), value.alias("value"), name.alias("name"))
        hit = (F.col("level") == rule.of) & F.coalesce(rule.when(url, label), F.lit(False))
        target = F.when(hit, made) if target is None else target.when(hit, made)
    led = links.withColumn("_t", target).filter("_t is not null")
    return led.select(F.col("_t.name").alias("name"), "url", F.col("_t.to").alias("level"), F.col("_t.value").alias("value"), (F.col("depth") + 1).alias("depth"), "parent", "pos", "label")


def _written(df: DataFrame, place: str, files: Files) -> int | None:
    """Write ``df`` unless ``place`` is complete; its rows, or None if it was there."""
    if files.exists(f"{place}/_SUCCESS"):
        return None
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(place)
    return seen.get["n"]


def crawl(seeds: DataFrame, rules: Sequence[Rule], pages: Pages, folder: str, most: int = 100) -> DataFrame:
    """A row for each address reached from ``seeds`` (url, level): url, level, value, depth, parent, pos, label, status and html."""
    spark, files, folder = seeds.sparkSession, Files(seeds.sparkSession), folder.rstrip("/")
    reads = sorted({rule.of for rule in rules})
    none = {"value": F.lit(""), "depth": F.lit(0), "parent": F.lit(""), "pos": F.lit(0), "label": F.lit("")}
    first = seeds.filter("url is not null").select("url", "level").withColumns({"name": F.col("url"), **none})
    frontier = first.groupBy("name").agg(F.min_by(F.struct(*(c for c in first.columns if c != "name")), "level").alias("_r")).select("name", "_r.*")
    _written(frontier.select(*(c.split()[0] for c in _FRONTIER.split(", "))), f"{folder}/next=0", files)
    read = lambda kind, k: spark.read.parquet(f"{folder}/{kind}={k}")
    for k in range(most):
        frontier = read("next", k)
        got = pages(frontier.filter(F.col("level").isin(*reads)).select("url").distinct()).select(F.col("url").alias("_url"), "status", "html")
        _written(frontier.join(got, F.col("url") == F.col("_url"), "left").drop("_url").withColumn("status", F.coalesce("status", F.lit("listed"))), f"{folder}/round={k}", files)
        visited = spark.read.parquet(*(f"{folder}/next={j}" for j in range(k + 1))).select("name")
        led = _followed(read("round", k), rules).join(visited, "name", "left_anti")
        rest = F.struct("url", "level", "value", "depth", "parent", "pos", "label")
        chosen = led.groupBy("name").agg(F.min_by(rest, F.struct("parent", "pos")).alias("_r")).select("name", "_r.*")
        n = _written(chosen, f"{folder}/next={k + 1}", files)
        if (read("next", k + 1).count() if n is None else n) == 0:
            return spark.read.parquet(*(f"{folder}/round={j}" for j in range(k + 1))).drop("name")
    raise RuntimeError(f"the crawl in {folder} isn't done after {most} rounds")


def year_of(c: Column) -> Column:
    return F.regexp_extract(c, r"((?:19|20)\d{2})", 1)


def _leaf(url: Column) -> Column:
    return F.element_at(F.split(F.regexp_replace(F.regexp_replace(url, r"[?#].*$", ""), "/+$", ""), "/"), -1)


def _path(url: Column) -> Column:
    return F.concat(F.regexp_replace(F.regexp_replace(url, r"[?#].*$", ""), "/+$", ""), F.lit("/"))


_WEEKLY_YEAR, _WEEKLY = r"(?i)(?:19|20)\d{2}-weekly-activity-reports?/$", r"(?i)weekly-activity-report-(?!2/$)[^/]*(?:19|20)\d{2}[^/]*/$"


def _report(url: Column, label: Column) -> Column:
    """A weekly report by its address, or by its text where the address is a bare number; no file, feed or year page."""
    told = _path(url).rlike(_WEEKLY) | label.rlike(r"(?i)weekly\s+activity\s+report|week\s+ending")
    return told & ~url.rlike(r"wp-json|/wp-content/") & ~_path(url).rlike(_WEEKLY_YEAR) & ~_path(url).rlike(r"(?i)/(?:archived-)?weekly-activity-reports/$")


#: The ways of datasets whose documents are found over years. Levels: index, year, document.
WAYS: dict[str, tuple[Rule, ...]] = {
    "de-perb-decisions": (
        Rule("index", "year", lambda url, label: label.rlike(r"^\s*(?:19|20)\d{2}\s*$"), lambda url, label: F.trim(label), once=True),
        Rule("year", "document", lambda url, label: url.rlike(r"(?i)\.pdf")),
    ),
    "pa-plrb-final-orders": (
        Rule("index", "year", lambda url, label: _leaf(url).rlike(r"(?i)^(?:19|20)\d{2}(?:-plrb)?-final-orders$"), lambda url, label: year_of(_leaf(url)), once=True),
        Rule("year", "document", lambda url, label: url.rlike(r"(?i)\.pdf") & url.rlike(r"(?i)final-orders|/documents/") & ~url.rlike(r"(?i)/form/|annual-report")),
    ),
    "nmb-weekly-activity-reports": (
        Rule("index", "year", lambda url, label: _path(url).rlike(_WEEKLY_YEAR), lambda url, label: F.regexp_extract(_path(url), r"(?i)((?:19|20)\d{2})-weekly", 1)),
        Rule("index", "document", _report),
        Rule("year", "document", _report),
    ),
}


def year_pages(found: DataFrame) -> DataFrame:
    """The frame ``pages`` (url, year, html) of a dataset that reads year pages."""
    return found.filter("level = 'year' and html is not null").select("url", F.col("value").alias("year"), "html")


def document_urls(found: DataFrame) -> DataFrame:
    """The addresses of the documents, to be fetched (:func:`..sources.paging.fetch_table`) and read."""
    return found.filter("level = 'document'").select("url").distinct()
