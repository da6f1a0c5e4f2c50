"""Tables, links and records out of pages and payloads, by native expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import absolute_url, blank, col, squash, strip_html, strip_html_each, unescape_html

ANCHOR = r"(?is)<a\b[^>]*?\bhref\s*=\s*[\"']([^\"']*)[\"'][^>]*>(.*?)</a>"
ROW = r"(?is)<tr\b[^>]*>(.*?)</tr>"
CELL = r"(?is)<t[dh]\b[^>]*>(.*?)</t[dh]>"


def anchors(html: Column | str) -> Column:
    """array(struct(href, label)) of a page's links, in order; the label is still markup."""
    found = F.regexp_extract_all(blank(col(html)), F.lit(ANCHOR), F.lit(0))
    return F.transform(found, lambda a: F.struct(F.regexp_extract(a, ANCHOR, 1).alias("href"), F.regexp_extract(a, ANCHOR, 2).alias("label")))


def link_rows(pages: DataFrame, html: str = "html", decode=unescape_html) -> DataFrame:
    """A row for each link: the page's other columns, pos, href and the label as text."""
    rest = [c for c in pages.columns if c != html]
    found = pages.select(*rest, F.posexplode(anchors(html)).alias("pos", "link"))
    return found.select(*rest, "pos", "link.href", squash(strip_html("link.label", decode)).alias("label"))


def discover(pages: DataFrame, keep: str, base: str, html: str = "html", drop: str | None = None) -> DataFrame:
    """Distinct absolute URLs of the links whose href matches ``keep`` (and not ``drop``), each with its first place."""
    links = link_rows(pages, html).filter(F.col("href").rlike(keep))
    links = links.filter(~F.col("href").rlike(drop)) if drop else links
    url = F.regexp_replace(absolute_url(F.col(base), F.col("href")), "#.*$", "")
    return links.withColumn("url", url).groupBy("url").agg(F.min(F.struct("pos", "label")).alias("first")).select("url", "first.pos", "first.label")


def table_cells(html: Column | str) -> Column:
    """array(array(cell markup)) of all table rows of a page, nested tables apart."""
    return F.transform(F.regexp_extract_all(blank(col(html)), F.lit(ROW), F.lit(1)), lambda r: F.regexp_extract_all(r, F.lit(CELL), F.lit(1)))


def table_rows(pages: DataFrame, html: str = "html", least: int = 1) -> DataFrame:
    """A row for each table row of at least ``least`` cells: pos, cells (text) and first_href, the first link in any cell."""
    rest = [c for c in pages.columns if c != html]
    rows = pages.select(*rest, F.posexplode(table_cells(html)).alias("pos", "raw")).filter(F.size("raw") >= least)
    href = F.regexp_extract(F.array_join("raw", " "), r"(?i)\bhref\s*=\s*[\"']([^\"']*)[\"']", 1)
    return rows.select(*rest, "pos", strip_html_each("raw").alias("cells"), href.alias("first_href"))


def title(html: Column | str, decode=unescape_html) -> Column:
    return squash(strip_html(F.regexp_extract(blank(col(html)), r"(?is)<title\b[^>]*>(.*?)</title>", 1), decode))


def json_records(payloads: DataFrame, schema: str, field: str | None = None, payload: str = "payload") -> DataFrame:
    """Records of JSON payloads: a top-level array, or the array ``field`` of an object; broken payloads give no records."""
    rest = [c for c in payloads.columns if c != payload]
    kind = f"struct<{field}:array<struct<{schema}>>>" if field else f"array<struct<{schema}>>"
    parsed = F.from_json(payload, kind)
    return payloads.select(*rest, F.posexplode(parsed[field] if field else parsed).alias("pos", "record")).select(*rest, "pos", "record.*")


def page_offsets(total: Column, size: int) -> Column:
    """First records of the pages that hold ``total`` records."""
    return F.when(total > 0, F.sequence(F.lit(0), (F.ceil(total / size) - 1).cast("int"))).otherwise(F.array().cast("array<int>"))
