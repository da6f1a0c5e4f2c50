"""Collecting: from a dataset's addresses to its landed inputs.

Each collector says where its pages are; everything fetched is landed in the collection's folder (a ledger of attempts, written
walks and crawls, texts by their bytes), so a collection that is run again asks only for what is open.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from urllib.parse import quote, urlencode

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.documents import document_text, dossier_text
from ..operators.quality import GuardError
from ..sources import crawl, paging
from ..sources.landing import as_pages, decoded, fetch
from ..sources.ledger import Ledger, Texts, probe
from ..sources.paging import Fetcher, Source
from ..written import Files
from . import dataset, feeds, listings

#: Addresses, page sizes and queries of the sources. Fixed values.
OR_FIELDS, OR_SIZE = "title!date!descri!subjec!type!identi", 200
CA_API, CA_SIZE = "https://perb.ca.gov/wp-json/wp/v2/decision", 100
NJ_VIEW, NJ_SIZE = "https://www.perc.state.nj.us/percdecisions.nsf/IssuedDecisions?ReadViewEntries", 500
IA_SIZE = 20
FL_RESULTS = "https://perc.myflorida.com/co/certResults.aspx"
FL_BULK = (("a", ""), ("", "a"), ("", "e"))  # (Union, Employer)
DE_INDEX = "https://perb.delaware.gov/decisions/"
PA_INDEX = "https://www.pa.gov/agencies/dli/programs-services/labor-management-relations/pennsylvania-labor-relations-board/plrb-final-orders"
PAGES = {
    "ak-alra-board-decisions": "https://labor.alaska.gov/laborr/do/alra-board-decisions-and-orders.html",
    "dc-perb-certifications": "https://casesearch.perb.dc.gov/?docType=Certifications",
    "md-perb-election-certs": "https://laborboard.maryland.gov/decisions/election-certifications",
    "nyc-ocb-bargaining-units": "https://www.ocb-nyc.org/bargaining/",
    "wa-perc-certifications": "https://perc.wa.gov/pending-representation-cases/",
}
DOSSIER = "struct<text:string,method:string,whole:boolean,problem:string,is_image_only:boolean,text_chars:int>"


class Collection:
    """What is landed of one dataset, in ``folder``."""

    def __init__(self, spark: SparkSession, slug: str, folder: str, as_of: str, fetcher: Fetcher = fetch, delay: float = 0.3):
        self.spark, self.slug, self.folder, self.as_of = spark, slug, folder.rstrip("/"), as_of
        self.fetcher, self.delay = fetcher, delay
        self.ledger = Ledger(spark, f"{self.folder}/asked", fetcher, delay)

    def urls(self, urls: Sequence[str]) -> DataFrame:
        return self.spark.createDataFrame([(u,) for u in urls], "url string")

    def pages(self, *urls: str) -> DataFrame:
        """(url, html) of the pages, each of which must be got."""
        got = self.ledger.ask(self.urls(urls))
        if lost := got.filter("status <> 'ok'").select("url", "status").limit(3).collect():
            raise GuardError(f"{self.slug}: {'; '.join(f'{r.url}: {r.status}' for r in lost)}")
        return as_pages(got)

    def walked(self, sources: list[Source]) -> DataFrame:
        """(source, page, url, payload) of paged sources, walked once."""
        place = f"{self.folder}/walked"
        if not Files(self.spark).exists(f"{place}/_SUCCESS"):
            paging.pages(self.spark, sources, self.fetcher, self.delay).write.mode("overwrite").parquet(place)
        return self.spark.read.parquet(place).filter("status = 'ok'").select("source", "page", "url", decoded(F.col("content")).alias("payload"))

    def crawled(self, *seeds: str) -> DataFrame:
        levels = self.urls(seeds).withColumn("level", F.lit("index"))
        return crawl.crawl(levels, crawl.WAYS[self.slug], crawl.from_web(self.fetcher, self.delay), f"{self.folder}/crawled")

    def documents(self, urls: DataFrame) -> DataFrame:
        """(url, text, method) of documents; what couldn't be got says so."""
        texts = Texts(self.spark, f"{self.folder}/texts", document_text, "struct<text:string,method:string>")
        got = texts.read(self.ledger.ask(urls))
        return got.select("url", F.coalesce("text", F.lit("")).alias("text"), F.coalesce("method", F.lit("fetch_failed")).alias("method"))

    def dossiers(self, urls: DataFrame) -> DataFrame:
        """(url, text, method, …) of dossiers by the page policy; those that couldn't be got are left out."""
        texts = Texts(self.spark, f"{self.folder}/dossiers", dossier_text, DOSSIER)
        return texts.read(self.ledger.ask(urls).filter("status = 'ok'")).drop("status", "attempts")

    def linked(self, frames: dict[str, DataFrame], column: str) -> DataFrame:
        """The documents' addresses that the dataset's rows name in ``column``."""
        spec = dataset.get(self.slug)
        empty = {name: self.spark.createDataFrame([], schema) for name, schema in spec.inputs.items() if name not in frames}
        return spec.build({**empty, **frames}, self.as_of).select(F.col(column).alias("url")).filter("url <> ''").distinct()


COLLECTORS: dict[str, Callable[[Collection], dict[str, DataFrame]]] = {}


def collector(slug: str):
    def register(f):
        COLLECTORS[slug] = f
        return f

    return register


for _slug in ("ak-alra-board-decisions", "md-perb-election-certs", "nyc-ocb-bargaining-units", "wa-perc-certifications"):
    COLLECTORS[_slug] = lambda c: {"pages": c.pages(PAGES[c.slug])}


def _or_total(content: bytes) -> int | None:
    try:
        return int(json.loads(content)["pager"]["total"])
    except (ValueError, KeyError, TypeError):
        return None


@collector("or-erb-contentdm-orders")
def oregon(c: Collection) -> dict[str, DataFrame]:
    ask = quote(f"dmQuery/{feeds.OR_COLLECTION}/0/{OR_FIELDS}/dated/{OR_SIZE}/START/1/0/0/0/0/0/json", safe="/").replace("START", "{start}")
    source = paging.by_offset("or", f"{feeds.OR_HOST}/digital/bl/dmwebservices/index.php?q={ask}", OR_SIZE, "records", _or_total, first=1)
    return {"pages": c.walked([source]).select((F.col("page") * OR_SIZE + 1).alias("start"), "payload")}


@collector("ca-perb-decisions")
def california(c: Collection) -> dict[str, DataFrame]:
    ask = urlencode({"per_page": CA_SIZE, "page": "PAGE", "orderby": "date", "order": "desc", "_fields": "id,slug,title,content,date,link"}).replace("PAGE", "{page}")
    return {"pages": c.walked([paging.by_page("ca", f"{CA_API}?{ask}", CA_SIZE)]).select("page", "payload")}


@collector("nj-perc-issued-decisions")
def new_jersey(c: Collection) -> dict[str, DataFrame]:
    source = paging.by_cursor("nj", f"{NJ_VIEW}&Start={{start}}&Count={NJ_SIZE}&ExpandView", r'<viewentry[^>]*\bposition="([^"]+)"', r'<viewentry[^>]*\bunid="([^"]+)"')
    return {"pages": c.walked([source]).select("page", "payload")}


@collector("ia-eab-unit-certifications")
def iowa(c: Collection) -> dict[str, DataFrame]:
    sources = [paging.by_total(kind, f"{listings.IA_SITE}{path}", f"{listings.IA_SITE}{path}?page={{page}}", IA_SIZE) for path, kind in listings.IA_SECTIONS.items()]
    return {"pages": c.walked(sources).select("url", F.col("source").alias("employer_type"), F.col("payload").alias("html"))}


def florida_numbers(pages: DataFrame) -> DataFrame:
    """The certification numbers that result pages list."""
    grid = pages.select("url", F.regexp_extract("html", r"(?is)<table[^>]*id=[\"']gridCases[\"'][^>]*>(.*?)</table>", 1).alias("html"))
    return listings.cell_rows(grid, 3).filter(listings.cell(0).rlike(r"^\d{1,9}$")).select("url", listings.cell(0).cast("long").alias("number")).distinct()


@collector("fl-perc-certifications")
def florida(c: Collection) -> dict[str, DataFrame]:
    """Three broad searches, the numbers missing between what they find, and those above until ten on end are empty."""
    bulk = [f"{FL_RESULTS}?{urlencode({'Union': union, 'Employer': employer})}" for union, employer in FL_BULK]
    place = F.create_map(*(x for k, u in enumerate(bulk) for x in (F.lit(u), F.lit(k))))
    first = c.pages(*bulk).select("url", place[F.col("url")].alias("page"), "html")
    of = lambda n: F.concat(F.lit(f"{FL_RESULTS}?CertNo="), n.cast("string"))

    def ask(numbers: DataFrame) -> DataFrame:
        asked = numbers.select("number", of(F.col("number")).alias("url"))
        found = florida_numbers(as_pages(c.ledger.ask(asked))).select("number").distinct().withColumn("present", F.lit(True))
        return asked.select("number").join(found, "number", "left").withColumn("present", F.coalesce("present", F.lit(False)))

    probed = probe(florida_numbers(first).select("number").distinct(), ask, f"{c.folder}/probed").filter("present")
    more = as_pages(c.ledger.best()).join(probed.select(of(F.col("number")).alias("url"), (F.col("number") + len(bulk)).cast("int").alias("page")), "url").select("url", "page", "html")
    pages = {"pages": first.union(more)}
    return {**pages, "dossiers": c.dossiers(c.linked(pages, "certification_pdf_url"))}


@collector("dc-perb-certifications")
def district_of_columbia(c: Collection) -> dict[str, DataFrame]:
    pages = {"pages": c.pages(PAGES[c.slug])}
    return {**pages, "documents": c.documents(c.linked(pages, "document_url"))}


@collector("de-perb-decisions")
def delaware(c: Collection) -> dict[str, DataFrame]:
    return _by_years(c, DE_INDEX)


@collector("pa-plrb-final-orders")
def pennsylvania(c: Collection) -> dict[str, DataFrame]:
    return _by_years(c, PA_INDEX)


def _by_years(c: Collection, index: str) -> dict[str, DataFrame]:
    found = c.crawled(index)
    if found.filter("level = 'year' and status = 'ok'").isEmpty():
        raise GuardError(f"{c.slug}: {index} leads to no year's page")
    return {"pages": crawl.year_pages(found), "documents": c.documents(crawl.document_urls(found))}


def frames(spark: SparkSession, slug: str, folder: str, as_of: str, fetcher: Fetcher = fetch, delay: float = 0.3) -> dict[str, DataFrame]:
    """The inputs of a dataset, fetched where they aren't landed in ``folder``; those that no source gives are empty."""
    made = COLLECTORS[slug](Collection(spark, slug, folder, as_of, fetcher, delay))
    return {name: made[name] if name in made else spark.createDataFrame([], schema) for name, schema in dataset.get(slug).inputs.items()}
