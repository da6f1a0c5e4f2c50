"""Datasets whose sources are listing pages: tables, cards and link indexes; some with documents behind the links."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import captions, dates, roles
from ..functions.documents import dossier_status, zip_members
from ..functions.text import absolute_url, blank, capped_at_word, clean_party, file_name, query_value, spans, squash, strip_html, strip_html_each, title_case
from ..operators import rules
from ..sources.tables import link_rows, table_cells
from ..udf import arrow_udf
from .dataset import ENDS, PLACE, dataset, first_clause, key, or_else, without_place_word
from .maryland import VERIFIED

HREF = r"(?i)\bhref\s*=\s*[\"']([^\"']+)[\"']"
DOCUMENTS = "url string, text string, method string"


def cell_rows(pages: DataFrame, least: int, html: str = "html") -> DataFrame:
    """A row for each table row of at least ``least`` cells, with the cells' markup in ``raw`` and their text in ``cell``."""
    rest = [c for c in pages.columns if c != html]
    rows = pages.select(*rest, F.posexplode(table_cells(html)).alias("pos", "raw")).filter(F.size("raw") >= least)
    return rows.select(*rest, "pos", "raw", F.transform(strip_html_each("raw"), blank).alias("cell"))


def cell(k: int) -> Column:
    return F.get("cell", F.lit(k))


def with_documents(rows: DataFrame, documents: DataFrame, url: str) -> DataFrame:
    """Rows with ``text`` and ``method`` of the document at ``url``; an unread one says no_document or fetch_failed."""
    d = documents.select(F.col("url").alias("_url"), "text", "method")
    joined = rows.join(d, F.col(url) == F.col("_url"), "left").drop("_url")
    return joined.withColumn("method", F.when(blank(F.col(url)) == "", "no_document").otherwise(F.coalesce("method", F.lit("fetch_failed"))))


def read(c: str = "method") -> Column:
    return ~F.col(c).isin("no_document", "fetch_failed")


# --- plain tables and indexes --------------------------------------------------------------------------------------------

AK_SITE = "https://labor.alaska.gov"
AK_TYPES = {"RC": "CERTIFICATION", "RD": "DECERTIFICATION", "UC": "UNIT_CLARIFICATION", "ULP": "ULP", "CBA": "ARBITRATION", "CE": "CERTIFICATION", "DECISION": "ULP"}


@dataset(
    slug="ak-alra-board-decisions", agency="AK_ALRA", constants={"jurisdiction_state": "AK"}, order=["_padded", "case_number"], inputs={"pages": "url string, html string"}, first_wins=(["_low"], ["pos"]),
    columns=("row_key", "source_agency_code", "case_number", "decision_number", "canonical_case_type", "native_case_type", "employer_name", "union_name", "document_title", "pdf_url", *PLACE, *ENDS),
)
def alaska(frames, as_of) -> DataFrame:
    """Alaska labor relations board decisions."""
    links = link_rows(frames["pages"]).filter(F.col("href").rlike(r"(?i)\.pdf"))
    stem = F.regexp_replace(F.substring_index("href", "/", -1), r"(?i)\.pdf$", "")
    r = links.withColumns({"pdf_url": absolute_url(F.lit(f"{AK_SITE}/"), F.col("href")), "decision_number": F.when(stem.rlike(r"^\d+$"), stem).otherwise(F.substring(stem, 1, 40))})
    r = r.withColumn("case_number", or_else("label", F.concat(F.lit("DO-"), "decision_number")))
    native = or_else(F.upper(F.regexp_extract("case_number", r"(?i)-(RC|UC|ULP|CBA|RD|CE)\b", 1)), F.upper(F.regexp_extract("case_number", r"(?i)(RC|UC|ULP|CBA|RD)\s*$", 1)), F.when(F.upper("case_number").startswith("UCF"), F.lit("UC")).otherwise(F.lit("")), F.lit("DECISION"))
    return r.withColumns({"native_case_type": native, "_low": F.lower("pdf_url"), "document_title": F.col("case_number"), "source_page_url": F.col("url"), "source_url": F.col("pdf_url"), "row_key": key("AK_ALRA", "decision_number", F.substring("case_number", 1, 60)), "_padded": F.when(F.length("decision_number") < 6, F.lpad("decision_number", 6, "0")).otherwise(F.col("decision_number"))}).withColumn("canonical_case_type", rules.lookup("native_case_type", AK_TYPES, "CERTIFICATION"))


WA_PAGE = "https://perc.wa.gov/pending-representation-cases/"


@dataset(
    slug="wa-perc-certifications", agency="WA_PERC", constants={"canonical_case_type": "CERTIFICATION", "native_case_type": "Pending Representation", "jurisdiction_state": "WA", "source_page_url": WA_PAGE},
    order=["date_filed", "case_number"], inputs={"pages": "url string, html string"},
    columns=("row_key", "source_agency_code", "case_number", "canonical_case_type", "native_case_type", "employer_name", "union_name", "case_status", "date_filed", *PLACE, "document_title", "pdf_url", *ENDS),
)
def washington(frames, as_of) -> DataFrame:
    """Washington PERC pending representation cases (sorted by the date as printed)."""
    first = frames["pages"].withColumn("html", F.regexp_extract("html", r"(?is)<table[^>]*>(.*?)</table>", 1))
    r = cell_rows(first, 4).filter((cell(2) != "") & (F.lower(cell(2)) != "case number") & (cell(1) != ""))
    pdf = F.regexp_extract(F.get("raw", F.lit(1)), r'(?i)href="([^"]+\.pdf[^"]*)"', 1)
    r = r.select("pos", cell(0).alias("date_filed"), cell(1).alias("employer_name"), cell(2).alias("case_number"), cell(3).alias("case_status"), F.when(pdf != "", absolute_url(F.lit("https://perc.wa.gov"), pdf)).otherwise(F.lit("")).alias("pdf_url"))
    return r.withColumns({"row_key": key("WA_PERC", "case_number"), "document_title": F.concat("employer_name", F.lit(" ("), "case_number", F.lit(")")), "source_url": or_else("pdf_url", F.lit(WA_PAGE))})


NYC_PAGE = "https://www.ocb-nyc.org/bargaining/"


@dataset(
    slug="nyc-ocb-bargaining-units", agency="NYC_OCB", constants={"canonical_case_type": "CERTIFICATION", "native_case_type": "BOC_BARGAINING_UNIT", "jurisdiction_state": "NY", "source_page_url": NYC_PAGE},
    order=["certification_number"], inputs={"pages": "url string, html string"},
    columns=("row_key", "source_agency_code", "certification_number", "canonical_case_type", "native_case_type", "bargaining_unit_name", "union_name", "dcas_cbu_number", "titles_pdf_url", "employer_name", *PLACE, *ENDS),
)
def new_york_city(frames, as_of) -> DataFrame:
    """New York City bargaining units."""
    r = cell_rows(frames["pages"], 4).filter((cell(0) != "") & ~F.contains(F.lower(cell(0)), F.lit("certification")))
    href = F.regexp_extract(F.get("raw", F.lit(1)), HREF, 1)
    r = r.select(cell(0).alias("certification_number"), cell(1).alias("bargaining_unit_name"), cell(2).alias("union_name"), cell(3).alias("dcas_cbu_number"), F.when(href != "", absolute_url(F.lit("https://www.ocb-nyc.org/"), href)).otherwise(F.lit("")).alias("titles_pdf_url"))
    return r.withColumns({"row_key": key("NYC_OCB", F.upper(squash("certification_number"))), "source_url": or_else("titles_pdf_url", F.lit(NYC_PAGE))})


IA_SITE = "https://eab.iowa.gov"
#: Listing sections and the employer type each stands for.
IA_SECTIONS = {"/cities": "cities", "/counties": "counties", "/k-12-schools": "k12_schools", "/area-education-agencies-aeas": "area_education_agencies", "/community-colleges-ccs": "community_colleges", "/state": "state"}


@dataset(
    slug="ia-eab-unit-certifications", agency="IA_EAB", constants={"canonical_case_type": "CERTIFICATION", "native_case_type": "UNIT_CERTIFICATION", "jurisdiction_state": "IA"},
    order=["employer_type", "_number"], inputs={"pages": "url string, employer_type string, html string"}, first_wins=(["media_id"], ["url", "pos"]),
    totals=lambda frames: (frames["pages"].groupBy("employer_type").agg(F.max(stated_total("html")).alias("total")), F.abs(F.col("rows") - F.col("total")) > F.greatest(F.lit(2), F.floor(F.col("total") / 50)), "employer_type"),
    columns=("row_key", "source_agency_code", "media_id", "canonical_case_type", "native_case_type", "employer_type", "employer_name", "union_name", "bargaining_unit_name", "document_title", *PLACE, "pdf_url", *ENDS),
)
def iowa(frames, as_of) -> DataFrame:
    """Iowa unit certifications, from paged sections that state their totals."""
    item = r'(?is)<a[^>]+href="(/media/(\d+)/download(?:\?inline)?)"[^>]*>.*?<h2>\s*(.*?)\s*</h2>'
    found = frames["pages"].select("url", "employer_type", F.posexplode(F.regexp_extract_all("html", F.lit(item), F.lit(0))).alias("pos", "m"))
    label = F.trim(F.regexp_replace(strip_html(F.regexp_extract("m", item, 3)), r"(?i)\.pdf\s*$", ""))
    r = found.select("url", "pos", "employer_type", F.regexp_extract("m", item, 2).alias("media_id"), absolute_url(F.lit(f"{IA_SITE}/"), F.regexp_extract("m", item, 1)).alias("pdf_url"), label.alias("document_title")).filter("document_title <> ''")
    unit = r"\(([^)]+)\)\s*$"
    bare = F.trim(F.regexp_replace("document_title", unit, ""))
    two = F.contains(bare, F.lit(" and "))
    r = r.withColumns({"bargaining_unit_name": F.trim(F.regexp_extract("document_title", unit, 1)), "employer_name": F.trim(F.when(two, F.substring_index(bare, " and ", 1)).otherwise(bare)), "union_name": F.when(two, F.trim(F.regexp_replace(bare, r"^.*? and ", ""))).otherwise(F.lit(""))})
    city = first_clause(F.regexp_replace(without_place_word(F.col("employer_name"), "City|Town|Village"), r"(?i)\s+County(\s+.*)?$", " County"))
    return r.withColumns({"row_key": key("IA_EAB", "media_id"), "jurisdiction_city": F.when(F.col("employer_name") == "", "").when(F.col("employer_type") == "state", "Des Moines").otherwise(city), "source_page_url": F.regexp_replace("url", r"\?.*$", ""), "source_url": F.col("pdf_url"), "_number": F.col("media_id").try_cast("bigint")})


def stated_total(html: Column | str) -> Column:
    """T of "Displaying N - M of T results", or null."""
    return F.regexp_extract(html, r"(?i)Displaying\s+\d+\s*[-–]\s*\d+\s+of\s+(\d+)\s+results", 1).try_cast("int")


MD_SITE = "https://www.maryland.gov"
MD_CASE = r"(?i)\b((?:PERB|SLRB|PSLRB|SHELRB|HELRB)\s+[A-Z]{1,4}(?:\.[A-Z])?\s*\d{2,4}-\d+(?:/\d+)?)\b"
#: Entries that the board publishes twice. Fixed values.
MD_REPEATED = ("412", "425")


MD_CARD = r'(?is)<article class="maryland-listing-item__container(?:\s[^"]*)?"[^>]*>(.*?)</article>'
MD_LINK = r'(?i)<a class="maryland-listing-item__title" href="([^"]+)"'


def maryland_total(pages: DataFrame) -> DataFrame:
    """The total that the pages state, less the entries among theirs that are left out because they are published twice."""
    media = F.transform(F.regexp_extract_all("html", F.lit(MD_CARD), F.lit(1)), lambda a: F.regexp_extract(F.regexp_extract(a, MD_LINK, 1), r"/media/(\d+)", 1))
    return pages.agg((F.max(stated_total("html")) - F.coalesce(F.sum(F.size(F.filter(media, lambda m: m.isin(*MD_REPEATED)))), F.lit(0))).alias("total"))


def maryland_parties(text: Column) -> Column:
    """struct(employer, union) of a card's title: at " - ", else at the first comma."""
    dash, comma = F.contains(text, F.lit(" - ")), F.contains(text, F.lit(","))
    listed = F.filter(F.transform(F.split(text, ","), lambda x: F.trim(x)), lambda x: x != "")
    many = comma & (F.size(listed) >= 2)
    return F.struct(
        F.when(dash, F.trim(F.substring_index(text, " - ", 1))).when(many, F.get(listed, F.lit(0))).otherwise(text).alias("employer"),
        F.when(dash, F.trim(F.regexp_replace(text, r"^.*? - ", ""))).when(many, F.array_join(F.slice(listed, 2, 100), ", ")).otherwise(F.lit("")).alias("union"),
    )


@dataset(
    slug="md-perb-election-certs", agency="MD_PERB", constants={"native_case_type": "Election Certifications", "jurisdiction_state": "MD"}, order=["row_key"],
    totals=lambda frames: (maryland_total(frames["pages"]), F.col("rows") != F.col("total")),
    inputs={"pages": "url string, html string", "overrides": "media_id string, employer_name string, union_name string"},
    columns=("row_key", "source_agency_code", "case_number", "canonical_case_type", "native_case_type", "employer_type", "employer_name", "union_name", *PLACE, "event_date", "document_title", "document_description", "pdf_url", *ENDS),
)
def maryland(frames, as_of) -> DataFrame:
    """Maryland PERB election certifications; verified parties, and ``overrides`` before them, beat the titles."""
    a = frames["pages"].select("url", F.posexplode(F.regexp_extract_all("html", F.lit(MD_CARD), F.lit(1))).alias("pos", "a"))
    part = lambda p: strip_html(F.regexp_extract("a", "(?is)" + p, 1))
    href = F.regexp_extract("a", MD_LINK, 1)
    r = a.select(
        F.col("url").alias("source_page_url"), part(r"maryland-listing-item__eyebrow[^>]*>\s*([^<]+?)\s*</div>").alias("employer_type"), part(r'maryland-link__document-title">([^<]+)</span>').alias("document_title"),
        F.when(href != "", absolute_url(F.lit(MD_SITE), href)).otherwise(F.col("url")).alias("pdf_url"), part(r"maryland-listing-item__date[^>]*>\s*([^<]+?)\s*</div>").alias("event_date"), part(r"maryland-listing-item__description[^>]*>\s*(?:<p>)?([^<]*)(?:</p>)?").alias("document_description"),
    )
    case = squash(F.upper(F.regexp_extract("document_title", MD_CASE, 1)))
    opens = F.upper("document_title").startswith(F.substring_index(case, " ", 1)) & (case != "")
    rest = F.regexp_replace(F.expr("substring(document_title, length(case_number) + 1)"), r"^[ ,-]+", "")
    r = r.withColumns({"case_number": case, "media_id": F.regexp_extract("pdf_url", r"/media/(\d+)", 1), "_opens": opens})
    inner = F.when(F.col("_opens"), rest).when((F.col("case_number") != "") & F.contains("document_title", F.lit(" - ")), F.regexp_replace("document_title", r"^.*? - ", "")).otherwise(F.col("document_title"))
    r = r.withColumn("_p", maryland_parties(inner))
    known = r.sparkSession.createDataFrame(VERIFIED, "media_id string, employer_name string, union_name string")
    own = frames["overrides"].select("media_id", "employer_name", "union_name")
    o = known.join(own.select(F.col("media_id").alias("_own")), F.col("media_id") == F.col("_own"), "left_anti").union(own)
    o = o.select(F.col("media_id").alias("_id"), F.col("employer_name").alias("_e"), F.col("union_name").alias("_u"))
    r = r.join(o, F.col("media_id") == F.col("_id"), "left").filter(~F.col("media_id").isin(*MD_REPEATED))
    return r.withColumns({"employer_name": F.coalesce("_e", "_p.employer"), "union_name": F.coalesce("_u", "_p.union"), "row_key": key("MD_PERB", or_else("media_id", "case_number", "document_title")), "canonical_case_type": F.when(F.contains(F.concat(F.lit(" "), F.upper("document_title"), F.lit(" ")), F.lit(" ULP ")), "ULP").otherwise("CERTIFICATION"), "source_url": F.col("pdf_url")})


# --- Rhode Island: tables and captions behind them -------------------------------------------------------------------------

RI_UNIT = r"(?i)\b(clerical|custodial|nurse|nurses|housing|management|police|crossing|guard|guards|clerk|clerks|aide|aides|driver|drivers|secretary|secretaries|rescue|personnel|professional|non-?police|fire\s*fighter|teacher|teachers|maintenance|paraprofessional|hours?\s+per\s+week|middle\s+management)\b"
RI_NO_PLACE = r"(?i)\b(state|quasi|authority|university|college|school\s+department|school\s+committee|board\s+of|department\s+of|fire\s+district|water\s+district|housing\s+authority|transit|airport)\b"


def rhode_island_city(employer: Column) -> Column:
    """A city only where the name states one."""
    text = squash(blank(employer))
    named = F.trim(F.regexp_extract(text, r"(?i)\b(?:City|Town|Village)\s+of\s+([A-Za-z][A-Za-z .'-]{0,40})", 1), F.lit(" ,."))
    inner = F.trim(F.regexp_extract(text, r"\(([A-Za-z][A-Za-z .'-]{0,40})\)\s*$", 1))
    bare = F.trim(F.regexp_replace(text, r"\s*\([^)]*\)\s*", " "), F.lit(" ,;"))
    plain = bare.rlike(r"^[A-Za-z][A-Za-z .'-]{0,40}$") & (F.size(F.split(bare, r"\s+")) <= 3) & ~bare.rlike(RI_NO_PLACE) & ~bare.rlike(RI_UNIT)
    return F.when(named != "", named).when((inner != "") & ~inner.rlike(RI_UNIT) & ~inner.rlike(RI_NO_PLACE), inner).when(plain, bare).otherwise(F.lit(""))


def rhode_island_units(employer: Column) -> Column:
    """struct(employer, unit): parentheses that name a unit leave the employer; places and amendment notes stay."""
    text = squash(blank(employer))
    inner = F.regexp_extract_all(text, F.lit(r"\(([^)]+)\)"), F.lit(1))
    units = F.filter(F.transform(inner, lambda x: F.trim(x)), lambda x: ~F.lower(x).startswith("amended") & (x.rlike(RI_UNIT) | F.contains(x, F.lit(","))))
    left = F.aggregate(units, text, lambda t, u: F.replace(t, F.concat(F.lit("("), u, F.lit(")")), F.lit(" ")))
    return F.struct(F.trim(squash(left), F.lit(" ,;")).alias("employer"), F.array_join(units, "; ").alias("unit"))


def rhode_island_caption(text: Column) -> Column:
    """struct(employer, union, unit) of a certification's text, by structure, since OCR garbles its words."""
    flat = F.regexp_replace(F.regexp_replace(blank(text), r"[ \t]+", " "), r"\n+", "\n")
    shape = r"(?is)In\s+the\s+M\w{3,6}\s+of\s+(.+?)\s+Emp\w{3,10}\s*-+\s*and\s*-+\s*(.+?)\s+Pet\w{5,12}"
    party = lambda k: F.trim(F.regexp_replace(F.trim(squash(F.regexp_extract(flat, shape, k)), F.lit(" ,;-")), r"(?i)\s*-\s*and\s*-?\s*$", ""), F.lit(" ,;-"))
    unit = F.trim(squash(F.regexp_extract(flat, r"(?is)(?:secret\s+ballot\s+of|by\s+secret\s+ballot\s+of)\s+(.+?)(?:\.\s|\.\n|$)", 1)), F.lit(" .;"))
    return F.struct(party(1).alias("employer"), party(2).alias("union"), capped_at_word(unit, 400).alias("unit"))


@dataset(
    slug="rislrb-certifications", agency="RI_SLRB", constants={"native_case_type": "CERTIFICATION", "jurisdiction_state": "RI"}, order=["case_number", "certification_category"], least=0,
    inputs={"pages": "url string, category string, html string", "documents": DOCUMENTS}, first_wins=(["row_key"], ["url", "pos"]),
    columns=("row_key", "source_agency_code", "case_number", "canonical_case_type", "native_case_type", "certification_category", "employer_name", "union_name", "unit_description", *PLACE, "date_certified", "date_amended", "certification_pdf_url", "disposition_pdf_url", *ENDS),
)
def rhode_island(frames, as_of) -> DataFrame:
    """Rhode Island certifications; a caption replaces a listing's name where it says clearly more."""
    marked = frames["pages"].withColumn("html", F.regexp_extract("html", r'(?is)<table[^>]*class="sortable"[^>]*>(.*)', 1))
    r = cell_rows(marked, 5).filter(cell(1).rlike(r"(?i)^EE-\d+"))
    link = lambda k: F.regexp_extract(F.get("raw", F.lit(k)), HREF, 1)
    url = lambda k: F.when(link(k) != "", absolute_url(F.col("url"), link(k))).otherwise(F.lit(""))
    day = lambda p: F.regexp_extract(cell(3), p, 1)
    plain, amended = day(r"(?:^|[^(\d\s]|[^(]\s+|^\s+)(\d{1,2}/\d{1,2}/\d{2,4})"), day(r"\(\s*(\d{1,2}/\d{1,2}/\d{2,4})")
    r = r.select("url", "pos", "category", rhode_island_units(cell(0)).alias("_u"), F.regexp_replace(F.upper(cell(1)), r"\s+", "").alias("case_number"), cell(2).alias("union_name"), or_else(plain, amended).alias("date_certified"), F.when(plain != "", amended).otherwise(F.lit("")).alias("date_amended"), url(0).alias("certification_pdf_url"), url(4).alias("disposition_pdf_url"))
    r = with_documents(r, frames["documents"], "certification_pdf_url").withColumn("_c", rhode_island_caption(F.col("text")))
    listed, caption = F.col("_u.employer"), F.col("_c.employer")
    fuller = lambda a, b: (a != "") & ((b == "") | b.startswith("(") | (F.length(a) > F.length(b) + 5))
    r = r.withColumns({"employer_name": F.when(fuller(caption, listed), caption).otherwise(listed), "union_name": F.when(fuller(F.col("_c.union"), F.col("union_name")), F.col("_c.union")).otherwise(F.col("union_name")), "unit_description": or_else("_u.unit", "_c.unit")})
    return r.withColumns({"certification_category": F.col("category"), "canonical_case_type": F.when(F.col("disposition_pdf_url") != "", "UNIT_CLARIFICATION").otherwise("CERTIFICATION"), "jurisdiction_city": or_else(rhode_island_city(caption), rhode_island_city(F.col("employer_name")), rhode_island_city(listed)), "row_key": key("RI_SLRB", "case_number", "category"), "source_page_url": F.col("url"), "source_url": or_else("certification_pdf_url", "url")})


# --- Vermont: names inside archives ---------------------------------------------------------------------------------------

VT_PAGE = "https://vlrb.vermont.gov/decisions/download"
VT_UNION = r"(?i)\b(VSEA|VSCFF|AFSCME|IBEW|NEA|AFT|CWA|IAFF|SEIU|UE|NAGE|Teamsters|Local\s+\d+|Council\s+\d+|Ass(?:ocia)?(?:'?n|tion)|Union|Federation|Guild|Brotherhood)\b"


@dataset(
    slug="vt-vlrb-volume-decisions", agency="VT_VLRB", constants={"native_case_type": "VLRB_VOLUME", "jurisdiction_state": "VT", "source_page_url": VT_PAGE}, order=["_number", "case_number", "pdf_name"],
    inputs={"archives": "url string, volume_number string, volume_label string, content binary"}, first_wins=(["row_key"], ["_volume", "pos"]),
    columns=("row_key", "source_agency_code", "case_number", "canonical_case_type", "native_case_type", "volume_number", "volume_label", "employer_name", "union_name", "document_title", "pdf_name", "source_zip_url", *PLACE, *ENDS),
)
def vermont(frames, as_of) -> DataFrame:
    """Vermont labor board decisions: the file names inside volume archives."""
    n = frames["archives"].select(F.col("url").alias("source_zip_url"), F.col("volume_number").alias("_v"), "volume_label", F.posexplode(zip_members("content")).alias("pos", "path"))
    shape = r"(?i)^(\d+)-(\d+(?:-\d+)?)\s*(.*)$"
    base = file_name("path")
    n = n.withColumn("pdf_name", base).withColumn("document_title", F.regexp_replace("pdf_name", r"(?i)\.pdf$", ""))
    fits = F.col("document_title").rlike(shape)
    rest = F.when(fits, F.trim(F.regexp_extract("document_title", shape, 3), F.lit(" -_"))).otherwise(F.col("document_title"))
    n = n.withColumns({"_rest": squash(rest), "case_number": F.when(fits, F.concat_ws("-", F.regexp_extract("document_title", shape, 1), F.regexp_extract("document_title", shape, 2))).otherwise(F.substring("document_title", 1, 80)), "volume_number": F.when(fits, F.regexp_extract("document_title", shape, 1)).otherwise(F.col("_v"))})
    t = F.col("_rest")
    grievance, who = t.rlike(r"(?i)^Gr\.?\s+of\s+.+"), F.regexp_extract(t, r"(?i)^Gr\.?\s+of\s+(.+)$", 1)
    sep = F.when(F.contains(t, F.lit(" v. ")), " v. ").when(F.contains(t, F.lit(" v ")), " v ").when(F.contains(t, F.lit(" and ")), " and ")
    head = F.expr("substring_index(_rest, case when contains(_rest, ' v. ') then ' v. ' when contains(_rest, ' v ') then ' v ' else ' and ' end, 1)")
    tail = F.trim(F.expr("substring(_rest, length(substring_index(_rest, case when contains(_rest, ' v. ') then ' v. ' when contains(_rest, ' v ') then ' v ' else ' and ' end, 1)) + 1 + length(case when contains(_rest, ' v. ') then ' v. ' when contains(_rest, ' v ') then ' v ' else ' and ' end))"))
    n = n.withColumns({"union_name": F.when(grievance, F.when(who.rlike(VT_UNION), t).otherwise(F.lit(""))).when(sep.isNotNull(), F.trim(head)).otherwise(F.lit("")), "_e": F.when(grievance, F.lit("State of Vermont")).when(sep.isNotNull(), tail).otherwise(t)})
    kind = [("(?i)decertif", "DECERTIFICATION"), ("(?i)unit|represent|election|certif|bargain", "CERTIFICATION")]
    return n.withColumns({"employer_name": or_else("_e", "_rest", F.concat(F.lit("VLRB Volume "), "_v")), "canonical_case_type": rules.first_match("document_title", kind, "ARBITRATION"), "row_key": key("VT_VLRB", "case_number", F.substring("pdf_name", 1, 80)), "source_url": F.col("source_zip_url"), "_number": F.coalesce(F.col("volume_number").try_cast("int"), F.lit(0)), "_volume": F.coalesce(F.col("_v").try_cast("int"), F.lit(0))})


# --- District of Columbia: a table, and certifications behind it -------------------------------------------------------------

DC_SITE = "https://casesearch.perb.dc.gov"
DC_TYPES = {"RC": "RECOGNITION", "AC": "AMENDMENT_OF_CERTIFICATION", "RD": "DECERTIFICATION", "UC": "UNIT_CLARIFICATION", "UM": "UNIT_MODIFICATION", "UCN": "UNIT_MODIFICATION", "CU": "UNIT_MODIFICATION", "U": "ULP"}
DC_START = r"\b[IT]n\s+the\s+matter\s+of\s*:?\)?"
DC_END = r"^\s*(?:corrected\s+)?certificat(?:e|ion)\s+of\s+representati|^\s*decision\s+and\s+order\b|^\s*a\s+representation\s+proceeding\b|^\s*it\s+is\s+hereby\s+certified\b"
DC_NOISE = (r"[P7]ERB\s+Case\s+No[.:]?\s*[\w-]*", r"Certification\s+N[oe][.:]?\s*\d*", r"CORRECTED\s+COPY")


def order_date(text: Column, as_of) -> Column:
    """struct(iso, raw, source): the order block's date, else the last one spelled out, else the filing stamp."""
    block = dates.date_after(text, (r"BY\s+ORDER\s+OF\s+THE\s+PUBLIC\s+EMPLOYEE\s+RELATIONS\s+BOARD",), as_of, 250)
    spelled = r"\b(?:January|February|March|April|May|June|July|August|September|October|November|December)\s+\d{1,2},\s+\d{4}\b"
    last = F.try_element_at(F.regexp_extract_all(blank(text), F.lit(spelled), F.lit(0)), F.lit(-1))
    body = F.date_format(F.try_to_date(last, "MMMM d, yyyy"), "yyyy-MM-dd")
    stamp_raw = F.regexp_extract(blank(text), r"\b([A-Z][a-z]{2})\s+(\d{1,2})\s+(\d{4})\s+\d{1,2}:\d{2}[AP]M\s+\w+", 0)
    stamp = F.date_format(dates.month_stamp(stamp_raw), "yyyy-MM-dd")
    choose = lambda a, b, c: F.when(block.isNotNull(), a).when(body.isNotNull(), b).when(stamp.isNotNull(), c).otherwise(F.lit(""))
    return F.struct(choose(block["iso"], body, stamp).alias("iso"), choose(block["raw"], F.substring(last, 1, 80), F.substring(stamp_raw, 1, 80)).alias("raw"), choose(F.lit("order_block"), F.lit("body"), F.lit("stamp")).alias("source"))


@dataset(
    slug="dc-perb-certifications", agency="DC_PERB", constants={"jurisdiction_city": "Washington", "jurisdiction_state": "DC"}, order=["case_number", "row_key"], failures=("documents", "document_text_method <> 'no_document'", "document_text_method = 'fetch_failed'", 0.05),
    inputs={"pages": "url string, html string", "documents": DOCUMENTS},
    columns=("row_key", "source_agency_code", "case_number", "certification_number", "canonical_case_type", "native_case_type", "employer_name", "union_name", "union_name_source", "listing_complainant", "listing_respondent", "petitioner", "respondent", "agency", "intervenor", "certified_representative", "certification_result", "document_text_method", "date_opened", "order_date", "order_date_raw", "order_date_source", "order_date_precision", "dc_register_cite", "document_name", "document_url", *PLACE, *ENDS),
)
def district_of_columbia(frames, as_of) -> DataFrame:
    """District of Columbia PERB certifications; the operative section decides who represents a unit."""
    r = cell_rows(frames["pages"], 7).filter((cell(0) != "") & (F.lower(cell(0)) != "perb case #"))
    href = F.regexp_extract(F.array_join("raw", " "), r'(?i)href="([^"]+)"', 1)
    party = lambda k: clean_party(F.regexp_replace(cell(k), ",+$", ""))
    r = r.select("pos", F.col("url").alias("source_page_url"), cell(0).alias("case_number"), cell(1).alias("date_opened"), cell(2).alias("certification_number"), cell(3).alias("native_case_type"), party(4).alias("listing_complainant"), party(5).alias("listing_respondent"), cell(6).alias("dc_register_cite"), cell(7).alias("document_name"), F.when(href != "", absolute_url(F.lit(f"{DC_SITE}/"), href)).otherwise(F.lit("")).alias("document_url"))
    r = r.withColumns({"_roles": roles.assign_roles("listing_complainant", "listing_respondent"), "_a": roles.split_side("listing_complainant"), "_b": roles.split_side("listing_respondent")})
    r = r.withColumns({"_e": F.substring(or_else("_roles.employer", F.array_join(F.concat("_a.publics", "_b.publics"), "; ")), 1, 240), "_u": F.substring("_roles.union", 1, 240)})
    r = with_documents(r, frames["documents"], "document_url")
    r = r.withColumns({"_c": captions.labelled_caption("text", DC_START, DC_END, DC_NOISE), "_cert": captions.certified_representative("text"), "_date": order_date(F.col("text"), as_of)})
    opened = read()
    seen = lambda c: F.when(opened, blank(c)).otherwise(F.lit(""))
    r = r.withColumns({k: seen(captions.names(F.col(f"_c.{k}"))) for k in ("petitioner", "respondent", "agency", "intervenor")})
    r = r.withColumns({"certified_representative": seen(F.col("_cert.name")), "certification_result": seen(F.col("_cert.result")), "_r": roles.split_side("respondent")})
    named = F.flatten(F.array(F.col("_c.petitioner"), F.col("_c.respondent"), F.col("_c.intervenor")))
    contested = F.size(F.filter(named, lambda x: roles.is_union(x))) >= 2
    source = (
        F.when(F.col("certified_representative") != "", "certification").when(F.col("certification_result") == "no_representative", "no_representative")
        .when(opened & contested, "contested_unresolved").when(F.col("_u") != "", "listing_roles").otherwise(F.lit(""))
    )
    r = r.withColumn("union_name_source", source)
    agency = or_else("agency", F.when((F.size("_r.publics") > 0) & (F.size("_r.unions") == 0), F.col("respondent")).otherwise(F.lit("")))
    file_id = F.upper(F.regexp_extract("document_url", r"(?i)fileid=\{?([0-9A-Fa-f-]{36})\}?", 1))
    code = F.upper(F.regexp_extract(F.trim("native_case_type"), r"(?i)^([A-Z]+)\b", 1))
    return r.withColumns({
        "union_name": F.when(F.col("union_name_source") == "certification", F.col("certified_representative")).when(F.col("union_name_source") == "listing_roles", F.col("_u")).otherwise(F.lit("")),
        "employer_name": or_else(F.substring(agency, 1, 240), "_e"), "document_text_method": F.col("method"),
        "order_date": seen(F.col("_date.iso")), "order_date_raw": seen(F.col("_date.raw")), "order_date_source": seen(F.col("_date.source")), "order_date_precision": F.when(seen(F.col("_date.iso")) != "", "day").otherwise(F.lit("")),
        "canonical_case_type": rules.lookup(code, DC_TYPES, "CERTIFICATION"), "row_key": key("DC_PERB", "case_number", or_else("certification_number", F.lit("NOCERT")), or_else(file_id, "document_name", F.lit("NODOC"))), "source_url": or_else("document_url", "source_page_url"),
    })


# --- Florida: a grid, and dossiers behind it ----------------------------------------------------------------------------------


FL_BLANK = ("-0-", "0", "-", "n/a", "na", "none")


@dataset(
    slug="fl-perc-certifications", agency="FL_PERC", constants={"canonical_case_type": "CERTIFICATION", "native_case_type": "CERTIFICATION"}, order=["_number"], least=1500, failures=("dossiers", "pdf_fetch_status <> 'no_link'", "pdf_fetch_status = 'fetch_failed'", 0.05),
    inputs={"pages": "url string, page int, html string", "dossiers": "url string, text string, method string, whole boolean, problem string, is_image_only boolean, text_chars int"},
    columns=("row_key", "source_agency_code", "certification_number", "canonical_case_type", "native_case_type", "employer_name", "union_name", *PLACE, "certification_pdf_url", "pdf_file_name", "is_image_only", "text_chars", "certification_status", "latest_order_title", "latest_order_date", "revocation_signal", "certification_order_date", "certification_order_date_source", "dossier_text_method", "pdf_fetch_status", *ENDS),
)
def florida(frames, as_of) -> DataFrame:
    """Florida PERC certifications: grid rows merged by number, with the status that each dossier's last order gives."""
    from ..operators.keys import prefer_filled
    from ..schema import flag

    grid = frames["pages"].select("url", "page", F.regexp_extract("html", r"(?is)<table[^>]*id=[\"']gridCases[\"'][^>]*>(.*?)</table>", 1).alias("html"))
    r = cell_rows(grid, 3).filter(cell(0).rlike(r"^\d+$"))
    fourth = F.regexp_extract(blank(F.get("raw", F.lit(3))), r'(?i)href="([^"]+)"', 1)
    href = F.replace(fourth, F.lit("&amp;"), F.lit("&"))
    site = F.regexp_extract("url", r"^([a-z]+://[^/]+)", 1)
    r = r.select("page", "pos", site.alias("_site"), cell(0).alias("certification_number"), cell(1).alias("_union"), cell(2).alias("employer_name"), F.when(href != "", absolute_url(F.concat(site, F.lit("/")), F.regexp_replace(href, "^/+", ""))).otherwise(F.lit("")).alias("certification_pdf_url"))
    r = prefer_filled(r.withColumn("_at", F.col("page") * F.lit(1_000_000).cast("long") + F.col("pos")), "certification_number", "_at", "employer_name", "certification_pdf_url")
    placeholder = F.lower(F.trim("_union")).isin(*FL_BLANK)
    known = (F.trim("employer_name") != "") & ~placeholder
    d = frames["dossiers"].select(F.col("url").alias("_url"), F.lit(True).alias("_read"), "text", "method", "whole", "problem", "is_image_only", "text_chars").withColumn("_s", dossier_status("text", as_of, F.col("whole")))
    r = r.join(d, F.col("certification_pdf_url") == F.col("_url"), "left")
    told = F.col("_read").isNotNull() & (F.col("problem") == "")
    status = F.when(F.col("certification_pdf_url") == "", "no_link").when(F.col("_read").isNull(), "fetch_failed").when(F.col("problem") != "", F.col("problem")).otherwise(F.col("_s.pdf_fetch_status"))
    own = {c: F.when(told, F.col(f"_s.{c}")).otherwise(F.lit("")) for c in ("latest_order_title", "latest_order_date", "revocation_signal", "certification_order_date", "certification_order_date_source")}
    link = F.concat("_site", F.lit("/co/certResults.aspx?CertNo="), "certification_number")
    return r.withColumns({
        **own, "certification_status": F.when(told, F.col("_s.certification_status")).when(F.col("_read").isNotNull(), "unknown").otherwise(F.lit("")), "pdf_fetch_status": status,
        "is_image_only": flag(F.col("is_image_only")), "text_chars": blank(F.when(F.col("is_image_only").isNotNull(), F.col("text_chars").cast("string"))), "dossier_text_method": F.when(told, F.col("method")).otherwise(F.lit("")),
        "union_name": F.when(placeholder, F.lit("")).otherwise(F.col("_union")), "jurisdiction_city": F.when(known, first_clause(F.regexp_replace(F.trim("employer_name"), r"(?i),\s*Florida\s*$", ""))).otherwise(F.lit("")), "jurisdiction_state": F.when(known, "FL").otherwise(F.lit("")),
        "pdf_file_name": query_value("certification_pdf_url", "File"), "row_key": key("FL_PERC", "certification_number"), "source_page_url": link, "source_url": or_else("certification_pdf_url", link), "_number": F.col("certification_number").try_cast("bigint"),
    })


# --- Delaware and Pennsylvania: year pages and orders behind them ----------------------------------------------------------------

DE_LABEL = r"(?i)^(Order of Dismissal|Probable Cause Determination|Unfair Labor Practice|Declaratory Statement|Representation Petition|Hearing Officer|PERB Decision|Executive Director|Board Decision|Bd Decision|Decision and Order|DS\s+\d|REP\s+\d|View decision)"
DE_LEAD = r"(?i)^(?:\d+[A-Z]?\s+)?(?:(?:ULP|PCD|Dec|OOD|CLAR|Bd Decision on Review|Order of Dismissal|Decision on the Merits|Appropriateness Determination|Bd)\s+)+"


def delaware_file_parties(name: str) -> tuple[str, str]:
    """(employer, union) of a file name: sides around "-v-" by content, else the words behind its codes."""
    stem = re.sub(r"(?i)-website$", "", re.sub(r"(?i)\.pdf$", "", name or ""))
    sides = re.match(r"(?i)(.+?)-vs?\.?-(.+)$", stem)
    if sides:
        left, right = (re.sub(r"[.\-_]+", " ", s).strip() for s in sides.groups())
        left, right = re.sub(DE_LEAD, "", left).strip(), re.sub(r"\s+\d{1,2}\s+\d{1,2}\s+\d{2,4}$", "", right).strip()
        return roles.roles_of_sides(*("" if re.match(DE_LABEL, s) else s for s in (left, right)))
    words = [w for w in re.split(r"[-_]+", stem.replace(".", " ")) if w]
    while words and re.fullmatch(r"(?i)\d+[a-z]?|ULP|PCD|CLAR|OOD|DS|REP|Dec|Decision|Bd", words[0].strip()):
        words.pop(0)
    party = " ".join(" ".join(words).split())
    if not party or re.match(DE_LABEL, party):
        return "", ""
    return ("", party) if re.search(r"(?i)\b(Assn|Association|Union|Federation|Council|Local)\b", party) else (party, "")


@arrow_udf("struct<employer:string,union:string>")
def delaware_parties(names: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([delaware_file_parties(n) for n in names], columns=["employer", "union"])


def delaware_city(employer: Column) -> Column:
    city = first_clause(without_place_word(employer, "City|Town|County"))
    return F.when((F.trim(employer) == "") | F.trim(employer).rlike(DE_LABEL) | city.rlike(r"(?i)\b(Board|Department|Commission|Authority|Assn|Association)\b"), F.lit("")).otherwise(city)


DE_TYPES = [
    ("decertif", "DECERTIFICATION"), ("clarif", "UNIT_CLARIFICATION"), ("appropriateness|unit determination", "UNIT_MODIFICATION"), ("(?=.*supervisory)(?=.*rep)", "UNIT_CLARIFICATION"),
    ("ulp", "ULP"), ("^rep |recognition|election", "CERTIFICATION"), ("probable cause", "ULP"),
]


@dataset(
    slug="de-perb-decisions", agency="DE_PERB", constants={"jurisdiction_state": "DE"}, order=["decision_year", "case_number", "pdf_url"], inputs={"pages": "url string, year string, html string", "documents": DOCUMENTS}, first_wins=(["url", "_low"], ["pos"]),
    columns=("row_key", "source_agency_code", "case_number", "canonical_case_type", "native_case_type", "decision_year", "employer_name", "union_name", "party_source", "petitioner", "respondent", "intervenor", "order_date", "order_date_raw", "order_date_source", "order_date_precision", "document_text_method", "document_title", "pdf_url", *PLACE, *ENDS),
)
def delaware(frames, as_of) -> DataFrame:
    """Delaware PERB decisions; a caption that was read replaces what the file name says."""
    links = link_rows(frames["pages"]).filter(F.col("href").rlike(r"(?i)\.pdf"))
    title = F.regexp_replace("label", r"(?i)^View decision\s+", "View decision ")
    shape = r"(?i)^View decision\s+(?:((?:19|20)\d{2})\s+)?(?:(ULP|REP)\s+)?(\d+[A-Z]?)\s+(.+)$"
    r = links.withColumns({"pdf_url": absolute_url(F.regexp_replace("url", "/*$", "/"), F.col("href")), "_title": title}).withColumn("_file", file_name("pdf_url"))
    part = lambda k: F.regexp_extract("_title", shape, k)
    r = r.withColumns({"_low": F.lower("pdf_url"), "decision_year": or_else(part(1), "year"), "_kind": F.upper(part(2)), "_desc": or_else(F.trim(part(4)), "_title"), "case_number": or_else(part(3), F.regexp_extract("_file", r"(?i)^(?:ULP-)?(\d+[A-Z]?)\b", 1), F.substring(F.regexp_replace("_file", "[^A-Za-z0-9]+", "-"), 1, 40)), "_p": delaware_parties("_file")})
    by_title = F.when((F.col("_desc") != "") & ~F.col("_desc").rlike(DE_LABEL), F.substring("_desc", 1, 120)).otherwise(F.lit(""))
    r = r.withColumn("_e", or_else("_p.employer", by_title)).withColumn("_e", F.when(F.col("_e").rlike(DE_LABEL), F.lit("")).otherwise(F.col("_e")))
    low = F.lower("_title")
    r = r.withColumn("native_case_type", or_else("_kind", F.when(F.contains(low, F.lit("ulp")), "ULP").when(F.contains(low, F.lit("rep")), "REP").otherwise("DECISION")))
    r = with_documents(r, frames["documents"], "pdf_url")
    end = r"^\s*:?\s*(?:unfair\s+labor\s+practice\s+charge|representation\s+petition|declaratory\s+statement|appearances\b|decision\s+and\s+order|order\s+of\s+dismissal|probable\s+cause|board\s+decision|(?:ulp\s+|case\s+)?no\.\s*\d)"
    r = r.withColumn("_c", captions.labelled_caption("text", r"PUBLIC\s+EMPLOYMENT\s+RELATIONS\s+BOARD", end))
    r = r.withColumns({"petitioner": blank(captions.names(F.col("_c.petitioner"))), "respondent": blank(captions.names(F.concat("_c.respondent", "_c.agency"))), "intervenor": blank(captions.names(F.col("_c.intervenor")))})
    line, ordered = dates.date_after("text", (r"\bDATE\s*:",), as_of, 60), dates.date_after("text", (r"IT\s+IS\s+SO\s+ORDERED", "WHEREFORE"), as_of, 300)
    r = r.withColumns({"_hit": F.coalesce(line, ordered), "_source": F.when(line.isNotNull(), "date_line").when(ordered.isNotNull(), "so_ordered").otherwise(F.lit("")), "_r": roles.assign_roles("petitioner", "respondent")})
    caption = (F.col("petitioner") != "") & (F.col("respondent") != "")
    e, u = F.when(caption, F.substring("_r.employer", 1, 240)).otherwise(F.col("_e")), F.when(caption, F.substring("_r.union", 1, 240)).otherwise(F.col("_p.union"))
    listed = F.when((F.col("_p.employer") != "") | (F.col("_p.union") != ""), "filename").when(F.col("_e") != "", "title").otherwise(F.lit(""))
    return r.withColumns({
        "employer_name": e, "union_name": u, "party_source": F.when(caption, "caption").when((F.col("_e") == "") & (F.col("_p.union") == ""), F.lit("")).otherwise(listed), "order_date": blank(F.col("_hit.iso")), "order_date_raw": blank(F.col("_hit.raw")), "order_date_source": F.col("_source"), "order_date_precision": blank(F.col("_hit.precision")),
        "document_text_method": F.col("method"), "document_title": F.col("_desc"), "canonical_case_type": rules.first_match(F.lower(F.concat_ws(" ", "native_case_type", "_title")), DE_TYPES, "CERTIFICATION"), "row_key": key("DE_PERB", "decision_year", "case_number", F.substring("_file", 1, 60)), "source_page_url": F.col("url"), "source_url": F.col("pdf_url"),
    }).withColumn("jurisdiction_city", delaware_city(F.col("employer_name")))


PA_DOCKET = r"(?i)\b((?:PERA|PF|PLRA|PLRB|PERB)-[A-Z]{1,2}-\d{2}-\d+-[A-Z])\b"
PA_LETTERS = {"R": "CERTIFICATION", "C": "ULP", "U": "UNIT_CLARIFICATION", "D": "DECERTIFICATION", "A": "ARBITRATION"}
PA_TYPES = [
    ("decertif", "DECERTIFICATION"), ("clarif", "UNIT_CLARIFICATION"), (r"\bpera-r\b|\brepresentation\b|\belection\b", "CERTIFICATION"), (r"\bpera-c\b|\bunfair\b|\bulp\b", "ULP"),
    ("fact[ -]finding", "FACT_FINDING"), (r"interest arbitration|\bpera-a\b", "ARBITRATION"),
]


def pennsylvania_type(title: Column, case: Column) -> Column:
    """By the docket's letter, else by words."""
    letter = F.regexp_extract(F.upper(case), r"\b(?:PERA|PF|PLRA|PLRB|PERB)-([A-Z]{1,2})-\d{2}-\d+-[A-Z]\b", 1)
    return or_else(rules.lookup(letter, PA_LETTERS), rules.first_match(F.lower(F.concat_ws(" ", title, case)), PA_TYPES, "ULP"))


def pennsylvania_city(employer: Column) -> Column:
    return first_clause(F.regexp_replace(without_place_word(employer, "City|Borough|Township|County"), r"(?i)\s+County\b.*$", " County"))


@dataset(
    slug="pa-plrb-final-orders", agency="PA_PLRB", constants={"jurisdiction_state": "PA"}, order=["-decision_year", "-case_number", "-pdf_url"], inputs={"pages": "url string, year string, html string", "documents": DOCUMENTS}, first_wins=(["url", "_low"], ["_start"]),
    columns=("row_key", "source_agency_code", "case_number", "canonical_case_type", "native_case_type", "decision_year", "docket_number", "employer_name", "union_name", "party_source", "petitioner", "order_disposition", "order_date", "order_date_raw", "order_date_source", "order_date_precision", "document_text_method", "document_title", "pdf_url", *PLACE, *ENDS),
)
def pennsylvania(frames, as_of) -> DataFrame:
    """Pennsylvania PLRB final orders; keys stay on the file's token when a better docket is read."""
    anchor = r"(?is)<a\b[^>]*?\bhref\s*=\s*[\"']([^\"']+\.pdf[^\"']*)[\"'][^>]*>(.*?)</a>"
    a = frames["pages"].select("url", "year", "html", F.explode(spans("html", anchor)).alias("m"))
    behind = F.get(F.split(F.expr("substring(html, m.start + length(m.raw) + 1, 400)"), r"(?i)<a\s|</p>|</li>"), F.lit(0))
    r = a.select("url", F.col("year").alias("decision_year"), F.col("m.start").alias("_start"), absolute_url(F.regexp_replace("url", "/*$", "/"), F.regexp_extract("m.raw", anchor, 1)).alias("pdf_url"), squash(strip_html(F.regexp_extract("m.raw", anchor, 2))).alias("document_title"), F.upper(F.regexp_extract(strip_html(behind), PA_DOCKET, 1)).alias("_docket"))
    low = F.lower("pdf_url")
    r = r.filter((F.contains(low, F.lit("final-orders")) | F.contains(low, F.lit("/documents/"))) & ~F.contains(low, F.lit("/form/")) & ~F.contains(low, F.lit("annual-report")) & (F.col("document_title") != ""))
    r = r.withColumns({"_low": low, "_file": file_name("pdf_url")})
    token = F.regexp_extract("_file", r"(?i)(?:pera|pf|plra|plrb)-[a-z]?-?\d{2}-\d+[a-z]?-[a-z]", 0)
    r = r.withColumn("_token", F.when(token != "", F.replace(F.upper(token), F.lit("--"), F.lit("-"))).otherwise(F.substring(F.regexp_replace("_file", r"(?i)\.pdf$", ""), 1, 60)))
    sides = F.split("document_title", r"(?i)\s+v\.?\s+", 2)
    r = r.withColumn("_r", roles.assign_roles(F.get(sides, F.lit(0)), F.get(sides, F.lit(1))))
    r = with_documents(r, frames["documents"], "pdf_url").withColumn("_t", F.regexp_replace(blank(F.col("text")), r"[ \t]+", " "))
    inside = F.upper(F.regexp_extract("_t", r"(?i)Case\s+No\.?\s*((?:PERA|PF|PLRA|PLRB|PERB)-[A-Z]{1,2}-\d{2}-\d+-[A-Z])", 1))
    of = F.substring(title_case(clean_party(squash(F.regexp_extract("_t", r"(?is)IN\s+THE\s+MATTER\s+OF\s+THE\s+EMPLOY(?:E)?S\s+OF\s+(.+?)\s*(?:\n\s*\n|:|Case\s+No)", 1)))), 1, 240)
    filed = clean_party(squash(F.regexp_extract("_t", r"(?s)filed\s+with\s+the\s+Pennsylvania\s+Labor\s+Relations\s+Board[^.]{0,120}?\bby\s+(?:the\s+)?([A-Z][^,(;]{3,120}?)\s*(?:,|\()", 1)))
    body = F.lower(F.regexp_extract("_t", r"(?is)HEREBY\s+ORDERS\s+AND\s+DIRECTS(.{0,900})", 1))
    r = r.withColumns({"docket_number": or_else("_docket", inside), "_of": of, "_filed": filed, "_hit": dates.date_after("_t", (r"SEALED,?\s+DATED\s+and\s+MAILED",), as_of, 500)})
    r = r.withColumn("petitioner", F.when(roles.is_union("_filed"), F.substring("_filed", 1, 240)).otherwise(F.lit("")))
    e, u = F.substring("_r.employer", 1, 160), F.substring("_r.union", 1, 160)
    filled = ((e == "") & (F.col("_of") != "")) | ((u == "") & (F.col("petitioner") != ""))
    r = r.withColumns({"employer_name": or_else(e, "_of"), "union_name": or_else(u, "petitioner"), "party_source": F.when(filled, "document").when((e != "") | (u != ""), "title").otherwise(F.lit("")), "case_number": or_else("docket_number", "_token")})
    return r.withColumns({
        "native_case_type": F.when(F.contains(or_else("_docket", "_token"), F.lit("-")), F.substring_index(or_else("_docket", "_token"), "-", 1)).otherwise(F.lit("ORDER")), "canonical_case_type": pennsylvania_type(F.col("document_title"), F.col("case_number")),
        "order_disposition": rules.first_match(body, [("dismiss", "dismissed"), ("certif", "certified"), ("sustain", "sustained")]), "order_date": blank(F.col("_hit.iso")), "order_date_raw": blank(F.col("_hit.raw")), "order_date_source": F.when(F.col("_hit").isNotNull(), "sealed_dated_mailed").otherwise(F.lit("")), "order_date_precision": blank(F.col("_hit.precision")),
        "document_text_method": F.col("method"), "jurisdiction_city": F.when(F.col("employer_name") != "", pennsylvania_city(F.col("employer_name"))).otherwise(F.lit("")), "row_key": key("PA_PLRB", "decision_year", "_token", F.substring("_file", 1, 50)), "source_page_url": F.col("url"), "source_url": F.col("pdf_url"),
    })
