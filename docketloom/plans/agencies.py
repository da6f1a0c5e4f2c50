"""Whole datasets as queries: each one's inputs are made from the suppliers and read back by the dataset itself, with its
keys, first-wins rule, guards and order.

Every supplier is a case between its town (its number in consonants, lest it spells a word of the vocabulary) and a union (its number); what a page, payload or document
says of it varies with the number, so that fallbacks and empty values occur beside the plain forms.
"""

from __future__ import annotations

import io
import zipfile

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import roles
from ..schema import to_wide
from ..udf import arrow_udf
from . import cases, dataset, feeds, layouts, listings  # noqa: F401  (registers the datasets)
from .roundtrip import AS_OF, query, read

SCRAPED = "2026-09-30T00:00:00+00:00"
#: The town of a supplier, in SQL.
TOWN = "'Town' || translate(CAST(s_suppkey AS VARCHAR), '0123456789', 'bcdfghjkmp')"
K = "CAST(s_suppkey AS VARCHAR)"


def _suppliers(spark, sf_dir) -> DataFrame:
    """The suppliers with their town, dealt out: they come in one small file, but what is made of each takes milliseconds to read."""
    s = read(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_suppkey").cast("string").alias("k"))
    s = s.repartition(2 * spark.sparkContext.defaultParallelism, "s_suppkey")
    return s.withColumn("town", F.concat(F.lit("Town"), F.translate("k", "0123456789", "bcdfghjkmp")))


def filled(template: str) -> Column:
    """``template`` with {k} and {town} of the row."""
    out = F.lit(template)
    for name in ("k", "town"):
        out = F.replace(out, F.lit("{" + name + "}"), F.col(name))
    return F.replace(out, F.lit("{TOWN}"), F.upper("town"))


def _frames(spark, spec: dataset.Dataset, given: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The dataset's inputs; columns and frames that aren't given are empty."""
    out = {}
    for name, schema in spec.inputs.items():
        empty = spark.createDataFrame([], schema)
        df = given.get(name)
        out[name] = empty if df is None else df.select(*((F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in empty.schema))
    return out


def run(spark, slug: str, **given: DataFrame) -> DataFrame:
    """A dataset's table over made inputs, in its order and through its guards; of one with a floor of rows the rows alone, as the
    made inputs may be fewer."""
    spec = dataset.get(slug)
    frames = _frames(spark, spec, given)
    if spec.least <= 1:
        return spec.table(frames, SCRAPED, AS_OF)
    return to_wide(spec.rows(frames, SCRAPED, AS_OF), spec.columns)


def odd(yes: str, no: str) -> Column:
    return F.when(F.col("s_suppkey") % 2 == 1, filled(yes)).otherwise(filled(no))


@query(f"""SELECT '17-' || {K} || '-' || t AS case_number, CASE t WHEN 'RC' THEN 'CERTIFICATION' WHEN 'UC' THEN 'UNIT_CLARIFICATION' ELSE t END AS canonical_case_type, 'https://labor.alaska.gov/laborr/' || {K} || '.pdf' AS pdf_url
FROM (SELECT *, ['ULP', 'RC', 'UC'][s_suppkey % 3 + 1] AS t FROM supplier)""")
def dataset_alaska(spark, sf_dir):
    """Links of an index, each file once."""
    return run(spark, "ak-alra-board-decisions", **_alaska(spark, sf_dir)).select("case_number", "canonical_case_type", "pdf_url")


def _alaska(spark, sf_dir) -> dict[str, DataFrame]:
    kind = F.element_at(F.array(*map(F.lit, ("ULP", "RC", "UC"))), (F.col("s_suppkey") % 3 + 1).cast("int"))
    html = F.concat(filled('<a href="/laborr/{k}.pdf">17-{k}-'), kind, filled('</a><a href="/laborr/{k}.PDF">again</a><a href="a.html">no</a>'))
    return {"pages": _suppliers(spark, sf_dir).select(filled("https://labor.alaska.gov/{k}.html").alias("url"), html.alias("html"))}


@query(f"""SELECT 'WA_PERC:' || {K} || '-U' AS row_key, '1/2/26' AS date_filed, 'https://perc.wa.gov/d' || {K} || '.pdf' AS pdf_url, {TOWN} || ' & Co (' || {K} || '-U)' AS document_title FROM supplier""")
def dataset_washington(spark, sf_dir):
    """A table with its heading, a link in a cell, entities, and a row without a date."""
    html = filled('<table><tr><th>Date</th><th>Employer</th><th>Case Number</th><th>Status</th></tr><tr><td>1/2/26</td><td><a href="/d{k}.pdf">{town} &amp; Co</a></td><td>{k}-U</td><td>Open</td></tr><tr><td>a</td><td></td><td>1</td><td></td></tr></table>')
    return run(spark, "wa-perc-certifications", pages=_suppliers(spark, sf_dir).select("k", html.alias("html")).withColumnRenamed("k", "url")).select("row_key", "date_filed", "pdf_url", "document_title")


@query(f"""SELECT 'NYC_OCB:' || {K} || '-70' AS row_key, 'Clerks of ' || {TOWN} AS bargaining_unit_name, 'https://www.ocb-nyc.org/t' || {K} || '.pdf' AS titles_pdf_url FROM supplier""")
def dataset_new_york(spark, sf_dir):
    """Rows of units and the files of their titles."""
    html = filled('<tr><td>Certification No.</td><td>a</td><td>b</td><td>c</td></tr><tr><td>{k}-70 </td><td><a href="t{k}.pdf">Clerks of {town}</a></td><td>DC 37</td><td>12</td></tr>')
    return run(spark, "nyc-ocb-bargaining-units", pages=_suppliers(spark, sf_dir).select(F.col("k").alias("url"), html.alias("html"))).select("row_key", "bargaining_unit_name", "titles_pdf_url")


@query(f"""SELECT {K} AS media_id, CASE WHEN s_suppkey % 2 = 1 THEN 'City of ' || {TOWN} ELSE {TOWN} || ' County Jail' END AS employer_name, CASE WHEN s_suppkey % 2 = 1 THEN 'Teamsters Local ' || {K} ELSE '' END AS union_name,
  CASE WHEN s_suppkey % 2 = 1 THEN 'Police' ELSE '' END AS bargaining_unit_name FROM supplier""")
def dataset_iowa(spark, sf_dir):
    """Titles of files: employer, union and unit, or an employer alone; a later page repeats them."""
    html = odd('<a href="/media/{k}/download?inline"><h2> City of {town} and Teamsters Local {k} (Police).pdf </h2></a>', '<a href="/media/{k}/download"><h2>{town} County Jail</h2></a>')
    pages = _suppliers(spark, sf_dir).select(F.explode(F.array(filled("https://eab.iowa.gov/cities?a={k}"), filled("https://eab.iowa.gov/cities?b={k}"))).alias("url"), F.lit("cities").alias("employer_type"), html.alias("html"))
    return run(spark, "ia-eab-unit-certifications", pages=pages).select("media_id", "employer_name", "union_name", "bargaining_unit_name")


@query(f"""SELECT 'MD_PERB:9' || {K} AS row_key, CASE WHEN s_suppkey % 2 = 1 THEN 'PERB EL 2026-' || {K} ELSE '' END AS case_number, CASE WHEN s_suppkey % 2 = 1 THEN {TOWN} || ' College' ELSE 'Fixed ' || {TOWN} END AS employer_name,
  CASE WHEN s_suppkey % 2 = 1 THEN 'AFT Local ' || {K} ELSE 'AFT-Maryland' END AS union_name, 'May 1, 2026' AS event_date FROM supplier""")
def dataset_maryland(spark, sf_dir):
    """Cards whose titles name both parties, and overrides for those that don't."""
    card = '<article class="maryland-listing-item__container x"><div class="maryland-listing-item__eyebrow">State</div><a class="maryland-listing-item__title" href="/media/9{k}"><span class="maryland-link__document-title">TITLE</span></a><div class="maryland-listing-item__date">May 1, 2026</div></article>'
    html = odd(card.replace("TITLE", "PERB EL 2026-{k}, {town} College, AFT Local {k}"), card.replace("TITLE", "AFT - College"))
    s = _suppliers(spark, sf_dir)
    known = s.filter("s_suppkey % 2 = 0").select(filled("9{k}").alias("media_id"), filled("Fixed {town}").alias("employer_name"), F.lit("AFT-Maryland").alias("union_name"))
    return run(spark, "md-perb-election-certs", pages=s.select(filled("https://www.maryland.gov/{k}").alias("url"), html.alias("html")), overrides=known).select("row_key", "case_number", "employer_name", "union_name", "event_date")


@query(f"""SELECT 'EE-' || {K} AS case_number, CASE WHEN s_suppkey % 2 = 1 THEN 'Town of ' || {TOWN} ELSE {TOWN} END AS employer_name, CASE WHEN s_suppkey % 2 = 1 THEN 'AFSCME Council ' || {K} ELSE 'IBPO' END AS union_name,
  'Clerks, Aides' AS unit_description, '1/2/90' AS date_certified, CASE WHEN s_suppkey % 2 = 1 THEN '3/4/95' ELSE '' END AS date_amended FROM supplier""")
def dataset_rhode_island(spark, sf_dir):
    """A listing's rows, and the captions of those documents that could be read."""
    html = F.concat(filled('<table class="sortable"><tr><td><a href="a{k}.pdf">{town} (Clerks, Aides)</a></td><td>EE-{k}</td><td>IBPO</td><td>1/2/90'), odd(" (3/4/95)", ""), F.lit('</td><td><a href="d.pdf">x</a></td></tr></table>'))
    s = _suppliers(spark, sf_dir)
    text = filled("In the Matter of\nTown of {town} Emp1oyer -and- AFSCME Council {k} Pet1tioner. by secret ballot of all clerks. ")
    documents = s.filter("s_suppkey % 2 = 1").select(filled("http://r/a{k}.pdf").alias("url"), text.alias("text"), F.lit("ocr").alias("method"))
    made = run(spark, "rislrb-certifications", pages=s.select(F.lit("http://r/p.htm").alias("url"), F.lit("Muni").alias("category"), html.alias("html")), documents=documents)
    return made.select("case_number", "employer_name", "union_name", "unit_description", "date_certified", "date_amended")


@query(f"""SELECT '12-RC-' || {K} AS case_number, 'Department of ' || {TOWN} AS employer_name, CASE WHEN s_suppkey % 2 = 1 THEN 'Teamsters Local ' || {K} ELSE '' END AS union_name,
  CASE WHEN s_suppkey % 2 = 1 THEN 'representative_certified' ELSE 'no_representative' END AS certification_result, CASE WHEN s_suppkey % 2 = 1 THEN '2018-12-05' ELSE '' END AS order_date FROM supplier""")
def dataset_district_of_columbia(spark, sf_dir):
    """The operative section names the union: a winner that isn't the petitioner, or none."""
    row = filled('<tr><td>12-RC-{k}</td><td>1/1/12</td><td>165</td><td>RC - Recognition</td><td>FOP Lodge 1,</td><td>Department of {town}</td><td>59 DCR</td><td>Cert</td><td><a href="/f?fileid={12345678-1234-1234-1234-123456789abc}{k}">x</a></td></tr>')
    text = odd("In the Matter of:\nFOP Lodge 1,\nPetitioner,\nand\nDepartment of {town},\nAgency,\nand\nTeamsters Local {k},\nIntervenor.\nCERTIFICATION OF REPRESENTATIVE\nIT IS HEREBY CERTIFIED THAT Teamsters Local {k} has been designated. BY ORDER OF THE PUBLIC EMPLOYEE RELATIONS BOARD Washington December 5, 2018", "IT IS HEREBY CERTIFIED THAT no representative has been selected")
    s = _suppliers(spark, sf_dir)
    documents = s.select(filled("https://casesearch.perb.dc.gov/f?fileid={12345678-1234-1234-1234-123456789abc}{k}").alias("url"), text.alias("text"), F.lit("ocr").alias("method"))
    made = run(spark, "dc-perb-certifications", pages=s.select(F.lit("https://casesearch.perb.dc.gov/").alias("url"), row.alias("html")), documents=documents)
    return made.select("case_number", "employer_name", "union_name", "certification_result", "order_date")


@query(f"""SELECT {K} AS certification_number, 'City of ' || {TOWN} || ', Florida' AS employer_name, 'PBA ' || {K} AS union_name, CASE WHEN s_suppkey % 2 = 1 THEN 'revoked' ELSE 'in_effect' END AS certification_status, '1992-06-01' AS certification_order_date,
  CASE WHEN s_suppkey % 2 = 1 THEN '1994-05-02' ELSE '1992-06-01' END AS latest_order_date FROM supplier""")
def dataset_florida(spark, sf_dir):
    """A grid's rows, the later page filling the earlier's gaps, and the status by each dossier's last order."""
    made = run(spark, "fl-perc-certifications", **_florida(spark, sf_dir))
    return made.select("certification_number", "employer_name", "union_name", "certification_status", "certification_order_date", "latest_order_date")


def _florida(spark, sf_dir) -> dict[str, DataFrame]:
    row = '<table id="gridCases"><tr><td>{k}</td><td>PBA {k}</td><td>EMPLOYER</td><td><a href="/f.aspx?File={k}.pdf&amp;x=1">d</a></td></tr></table>'
    s = _suppliers(spark, sf_dir)
    pages = s.select(F.lit("https://perc.myflorida.com/r").alias("url"), F.explode(F.array(F.struct(F.lit(1).alias("page"), filled(row.replace("EMPLOYER", "")).alias("html")), F.struct(F.lit(2).alias("page"), filled(row.replace("EMPLOYER", "City of {town}, Florida")).alias("html")))).alias("p")).select("url", "p.*")
    text = F.concat(F.lit("ORDER AND CERTIFICATION\nserved June 1, 1992\n"), odd("ORDER REVOKING CERTIFICATION\nMay 2, 1994", ""))
    dossiers = s.select(filled("https://perc.myflorida.com/f.aspx?File={k}.pdf&x=1").alias("url"), text.alias("text"), F.lit("ocr").alias("method"), F.lit(True).alias("whole"), F.lit("").alias("problem"), F.lit(True).alias("is_image_only"), F.lit(50).alias("text_chars"))
    return {"pages": pages, "dossiers": dossiers}


@query(f"""SELECT CAST(10000 + s_suppkey AS VARCHAR) AS case_number, CASE WHEN s_suppkey % 2 = 1 THEN 'CITY OF ' || upper({TOWN}) ELSE 'City of Dover' END AS employer_name, CASE WHEN s_suppkey % 2 = 1 THEN 'TEAMSTERS LOCAL ' || {K} ELSE 'LiUNA Local 1029' END AS union_name,
  CASE WHEN s_suppkey % 2 = 1 THEN 'caption' ELSE 'filename' END AS party_source FROM supplier""")
def dataset_delaware(spark, sf_dir):
    """Parties by a document's caption, else by its file's name."""
    s = _suppliers(spark, sf_dir).withColumn("k2", (F.col("s_suppkey") + 10_000).cast("string"))
    href = F.concat(F.lit("/"), F.col("k2"), F.lit("-OOD-LiUNA-Local-1029-v-City-of-Dover-1-29-26.pdf"))
    html = F.concat(F.lit('<a href="'), href, F.lit('">View decision 2026 ULP '), F.col("k2"), F.lit(" LiUNA v Dover</a>"))
    text = filled("PUBLIC EMPLOYMENT RELATIONS BOARD\nTEAMSTERS LOCAL {k},\nCharging Party,\nV.\nCITY OF {TOWN},\nRespondent.\nULP No. 1\nIT IS SO ORDERED.\nDATE: June 29, 2026")
    documents = s.filter("s_suppkey % 2 = 1").select(F.concat(F.lit("https://d"), href).alias("url"), text.alias("text"), F.lit("text_layer").alias("method"))
    made = run(spark, "de-perb-decisions", pages=s.select(F.lit("https://d/2026").alias("url"), F.lit("2026").alias("year"), html.alias("html")), documents=documents)
    return made.select("case_number", "employer_name", "union_name", "party_source")


@query(f"""SELECT 'PF-R-25-' || {K} || '-W' AS case_number, {TOWN} || ' Township' AS employer_name, 'Teamsters Local No. ' || {K} AS union_name, 'CERTIFICATION' AS canonical_case_type, 'dismissed' AS order_disposition, '2026-03-17' AS order_date FROM supplier""")
def dataset_pennsylvania(spark, sf_dir):
    """Final orders: parties of the document, its disposition and a date in words."""
    made = run(spark, "pa-plrb-final-orders", **_pennsylvania(spark, sf_dir))
    return made.select("case_number", "employer_name", "union_name", "canonical_case_type", "order_disposition", "order_date")


def _pennsylvania(spark, sf_dir) -> dict[str, DataFrame]:
    s = _suppliers(spark, sf_dir)
    html = filled('<p><a href="/documents/final-orders/pf-r-25-{k}-w.pdf">Teamsters</a> PF-R-25-{k}-W</p><a href="/form/x.pdf">form</a>')
    text = filled("IN THE MATTER OF THE EMPLOYES OF {TOWN} TOWNSHIP\n\nCase No. PF-R-25-{k}-W. It was filed with the Pennsylvania Labor Relations Board (Board) on May 1, 2025, by Teamsters Local No. {k}, affiliated. HEREBY ORDERS AND DIRECTS that it is dismissed. SEALED, DATED and MAILED this seventeenth day of March, 2026")
    documents = s.select(filled("https://www.pa.gov/documents/final-orders/pf-r-25-{k}-w.pdf").alias("url"), text.alias("text"), F.lit("text_layer").alias("method"))
    return {"pages": s.select(filled("https://www.pa.gov/y").alias("url"), F.lit("2026").alias("year"), html.alias("html")), "documents": documents}


@query(f"""SELECT 'CA_PERB:' || {K} || 'H:' || {K} AS row_key, 'HEERA' AS jurisdiction_statute, 'Regents of the University of California' AS employer_name, 'Teamsters Local ' || {K} AS union_name, 'Dismissed.' AS disposition, '2026-01-02' AS decision_date FROM supplier""")
def dataset_california(spark, sf_dir):
    """Posts of a JSON feed: statute by suffix, parties out of the description."""
    content = filled("<p><strong>Description:</strong> Charging Party Teamsters Local {k} alleged that Respondent Regents of the University of California violated the Act &amp; more.</p><p><strong>Disposition:</strong> Dismissed.</p>")
    post = F.struct(F.col("s_suppkey").alias("id"), filled("{k}h").alias("slug"), F.lit("2026-01-02T10:00:00").alias("date"), F.lit("").alias("link"), F.struct(F.lit("D").alias("rendered")).alias("title"), F.struct(content.alias("rendered")).alias("content"))
    pages = _suppliers(spark, sf_dir).select(F.col("s_suppkey").cast("int").alias("page"), F.to_json(F.array(post)).alias("payload"))
    return run(spark, "ca-perb-decisions", pages=pages).select("row_key", "jurisdiction_statute", "employer_name", "union_name", "disposition", "decision_date")


@query(f"""SELECT {K} AS document_id, CASE WHEN s_suppkey % 2 = 1 THEN 'City of ' || {TOWN} || ', MN' ELSE 'ISD 709, ' || {TOWN} END AS employer_name, {TOWN} AS jurisdiction_city, 'U' || {K} AS union_name, 'c' || {K} || '.pdf' AS pdf_file_name FROM supplier""")
def dataset_minnesota(spark, sf_dir):
    """A harvest of documents; of two lines of one document the later one that names an employer counts."""
    named = odd("City of {town}, MN", "ISD 709, {town}")
    lines = F.explode(F.array(F.struct(F.lit(1).alias("line"), F.lit("").alias("employer_name")), F.struct(F.lit(2).alias("line"), named.alias("employer_name"))))
    harvest = _suppliers(spark, sf_dir).select("*", lines.alias("l")).select("l.*", F.col("k").alias("document_id"), filled("U{k}").alias("union_name"), F.lit("c").alias("case_number"), F.lit("T").alias("title"), F.lit("2020-01-02").alias("decision_date"), filled("https://x/c{k}.pdf").alias("pdf_url"))
    return run(spark, "mn-bms-certifications", harvest=harvest).select("document_id", "employer_name", "jurisdiction_city", "union_name", "pdf_file_name")


@query(f"""SELECT {K} AS document_id, {TOWN} || CASE WHEN s_suppkey % 2 = 1 THEN ' Teachers' ELSE ' Police' END AS employer_name, CASE WHEN s_suppkey % 2 = 1 THEN '' ELSE 'AFSCME' END AS union_name, {TOWN} AS jurisdiction_city FROM supplier""")
def dataset_new_hampshire(spark, sf_dir):
    """Titles with an affiliate behind a dash, which is no union by itself, or with the union in a column of its own."""
    harvest = _suppliers(spark, sf_dir).select(F.col("k").alias("id"), odd("{town} Teachers - NEA", "{town} Police AFSCME").alias("title"), F.lit("2020").alias("date_posted"), odd("", "AFSCME").alias("union"), F.lit("").alias("pdf_url"), filled("f{k}.pdf").alias("pdf_filename"))
    return run(spark, "nh-pelrb-certifications", harvest=harvest).select("document_id", "employer_name", "union_name", "jurisdiction_city")


@query(f"""SELECT '19 CIR ' || {K} || ' (2017)' AS case_number, 'CITY OF ' || upper({TOWN}) AS employer_name, 'IBEW LOCAL ' || {K} AS union_name, '14' || {K} AS cir_case_number, '2017-03-06' AS decision_date, 'caption' AS party_source FROM supplier""")
def dataset_nebraska(spark, sf_dir):
    """Decisions as word processors export them: metadata stays out, the caption names the parties, the first filing the date."""
    s = _suppliers(spark, sf_dir)
    href = filled("/ncir/data/reporter/19_CIR_{k}_(2017)_IBEW_v_LES.htm")
    html = filled("<html><head><title>x</title></head><!--[if gte mso 9]><xml><w>99 28</w></xml><![endif]--><p>NEBRASKA COMMISSION OF INDUSTRIAL RELATIONS</p><p>IBEW LOCAL {k},<br>Petitioner,</p><p>v.</p><p>CITY OF {TOWN},<br>Respondent.</p><p>Case\nNo. 14{k}</p><p>Filed March 6, 2017</p><p>The Petitioner filed on May 1, 2015</p></html>")
    made = run(spark, "ne-cir-reporter", links=s.select(F.lit("https://n/i").alias("url"), F.lit("19_CIR_xx").alias("volume_dir"), href.alias("href")), documents=s.select(F.concat(F.lit("https://www.nebraska.gov"), href).alias("url"), html.alias("html")))
    return made.select("case_number", "employer_name", "union_name", "cir_case_number", "decision_date", "party_source")


@query(f"""SELECT CASE WHEN s_suppkey % 2 = 1 THEN 'MSAD NO. ' || {K} ELSE 'Town of ' || {TOWN} END AS employer_name, CASE WHEN s_suppkey % 2 = 1 THEN 'MSAD NO. ' || {K} || ' TEACHERS (MSEA)' ELSE 'Teamsters' END AS union_name,
  CASE WHEN s_suppkey % 2 = 1 THEN 'August 20, 2013' ELSE 'May 1, 1993' END AS decision_date, CASE WHEN s_suppkey % 2 = 1 THEN 'UNIT_CLARIFICATION' ELSE 'CERTIFICATION' END AS canonical_case_type, 'https://m/' || {K} || '/' || CASE WHEN s_suppkey % 2 = 1 THEN '02-uc-01.htm' ELSE '93-e-01.htm' END AS source_url FROM supplier""")
def dataset_maine(spark, sf_dir):
    """Case pages: parties by the caption's labels, else by the title."""
    html = odd("<title>A and B, 02-UC-01</title><pre>STATE OF MAINE\nCase No. 02-UC-01\nIssued: August 20, 2013\n_________________ )\nMSAD NO. {k} TEACHERS (MSEA), )\nPetitioner, ) UNIT CLARIFICATION\nand )\nMSAD NO. {k}, )\nPublic Employer. )\n__________________ )\nThe body.</pre>", "<title>In Re: Petition for Certification, Town of {town} (Teamsters), May 1, 1993</title>")
    pages = _suppliers(spark, sf_dir).select(odd("https://m/{k}/02-uc-01.htm", "https://m/{k}/93-e-01.htm").alias("url"), html.alias("html"))
    return run(spark, "me-mlrb-unit-rep-cases", pages=pages).select("employer_name", "union_name", "decision_date", "canonical_case_type", "source_url")


@query(f"""SELECT 'NMB:R-' || CAST(6000 + s_suppkey AS VARCHAR) || ':DISPATCHERS:' || {K} || ':5-1-04' AS row_key, CASE WHEN s_suppkey % 2 = 1 THEN 'true' ELSE 'false' END AS representation_asserted, CASE WHEN s_suppkey % 2 = 1 THEN 'Transport Workers Local ' || {K} ELSE '' END AS certified_representative,
  '2004' AS fiscal_year, 'U' || {K} AS applicant_union FROM supplier""")
def dataset_determinations(spark, sf_dir):
    """Determinations by volume; whom the linked document certifies, and none for a dismissal."""
    s = _suppliers(spark, sf_dir).withColumn("r", (F.col("s_suppkey") + 6000).cast("string"))
    head = "<table><tr><th>Page Cite</th><th>Date</th><th>Case</th><th>Carrier</th><th>Union</th><th>Craft/Class</th><th>Disposition</th><th>31 NMB Number</th></tr>"
    html = F.concat(filled(head + "<tr><td>{k}</td><td>5/1/04</td><td>R-"), "r", odd("</td><td>American</td><td>U{k}</td><td>Dispatchers</td><td>Certification</td><td><a href='/a{k}.pdf'>15</a></td></tr></table>", "</td><td>American</td><td>U{k}</td><td>Dispatchers</td><td>Dismissed</td><td>16</td></tr></table>"))
    text = filled("the Board certifies that the Transport Workers Local {k} has been duly designated and authorized to represent for the purposes")
    documents = s.filter("s_suppkey % 2 = 1").select(filled("https://n/a{k}.pdf").alias("url"), text.alias("text"), F.lit("text_layer").alias("method"))
    made = run(spark, "nmb-representation-determinations", pages=s.select(F.lit("https://n/fy2004-determinations/").alias("url"), html.alias("html")), documents=documents)
    return made.select("row_key", "representation_asserted", "certified_representative", "fiscal_year", "applicant_union")


@query(f"""SELECT {TOWN} || ', City of' AS employer_name, CASE WHEN s_suppkey % 2 = 1 THEN 'AFSCME Local ' || {K} ELSE '' END AS union_name, CASE WHEN s_suppkey % 2 = 1 THEN 'Blue collar workers' ELSE 'Anthony Police Dept (Full-time officers)' END AS bargaining_unit_name,
  CASE WHEN s_suppkey % 2 = 1 THEN '1200' ELSE '' END AS approx_employees, {TOWN} AS jurisdiction_city, '2026-02-01' AS roster_as_of_date FROM supplier""")
def dataset_new_mexico(spark, sf_dir):
    """An outline of employers and their units, wrapped lines joined; a unit whose union isn't named."""
    text = F.concat(filled("NEW MEXICO PUBLIC BARGAINING\nUpdated Feb. 2026\nUNITS SUBJECT TO LOCAL BOARDS:\n 1. {town}, City of\n"), odd("   a. AFSCME Local {k} (Blue collar\n      workers) (approx.. 1,200 employees).\n", "   a. Anthony Police Dept (Full-time officers)\n"), F.lit("1 | P a g e\n"))
    made = run(spark, "nm-pelrb-bargaining-units", documents=_suppliers(spark, sf_dir).select(filled("https://n/{k}.pdf").alias("url"), text.alias("text")))
    return made.select("employer_name", "union_name", "bargaining_unit_name", "approx_employees", "jurisdiction_city", "roster_as_of_date")


@query(f"""SELECT {TOWN} || ' County' AS employer_name, 'Teamsters Local ' || {K} AS union_name, 'All staff' AS bargaining_unit_name, 'Bob Roe' AS contact_name, 'b' || {K} || '@e.gov' AS contact_email FROM supplier
UNION ALL SELECT {TOWN} || ' County', 'IAFF Local ' || {K}, 'Fire', 'Bob Roe', 'b' || {K} || '@e.gov' FROM supplier WHERE s_suppkey % 2 = 1""")
def dataset_nevada(spark, sf_dir):
    """Directory lines: the contact is no union, and a further union stands on a line of its own."""
    text = F.concat(filled("LOCAL GOVERNMENT\n{town} County    Bob   Roe   1 Main St.   Elko NV 89801   775-738-5398   b{k}@e.gov   Teamsters Local {k}   All staff   www.bc.gov\n"), odd("                 IAFF Local {k}   Fire\n", ""), F.lit("Page 1 of 2\n"))
    made = run(spark, "nv-emrb-employer-directory", documents=_suppliers(spark, sf_dir).select(filled("https://n/{k}.pdf").alias("url"), text.alias("text")))
    return made.select("employer_name", "union_name", "bargaining_unit_name", "contact_name", "contact_email")


@query(f"""SELECT {K} AS unit_number, 'Unit ' || {K} || ' (Firefighters of ' || {TOWN} || ')' AS bargaining_unit_name, 'HAWAII FIRE FIGHTERS ASSOCIATION, LOCAL ' || {K} || ' (HFFA)' AS union_name, 'Bobby Lee' AS contact_name, 'President' AS contact_title,
  CASE WHEN s_suppkey % 2 = 1 THEN 'Y' ELSE 'N' END AS recertified, '2/4/72' AS certification_date FROM supplier""")
def dataset_hawaii(spark, sf_dir):
    """Two columns: an organisation's lines on the left, its units on the right, one of them over two lines."""
    unit = odd("Unit {k} (Firefighters of {town}) 2/4/72*\n", "Unit {k} (Firefighters of 2/4/72\n     {town})\n")
    text = F.concat(F.lit("HRS CHAPTER 89\nHAWAII FIRE FIGHTERS                "), unit, filled("ASSOCIATION, LOCAL {k} (HFFA)\nBobby Lee\nPresident\n2305 S. Beretania Street, Honolulu, Hawaii 96826\nTel. 949-1566\n"))
    made = run(spark, "hi-hlrb-employee-orgs", documents=_suppliers(spark, sf_dir).select(filled("https://h/{k}.pdf").alias("url"), text.alias("text")))
    return made.select("unit_number", "bargaining_unit_name", "union_name", "contact_name", "contact_title", "recertified", "certification_date")


@query(f"SELECT s_suppkey, 'City of ' || {TOWN} AS employer_name, 'AFSCME Local ' || {K} AS union_name FROM supplier")
def cross_petitions(spark, sf_dir):
    """Case names of four parties, two captions in one, in either order, and petitions filed jointly."""
    forms = ("City of {town} v. AFSCME Local {k} and AFSCME Local {k} v. City of {town}", "AFSCME Local {k} v. City of {town} & City of {town} v. AFSCME Local {k}", "Petition for Clarification jointly filed by City of {town} and AFSCME Local {k}")
    name = F.element_at(F.array(*map(filled, forms)), (F.col("s_suppkey") % 3 + 1).cast("int"))
    return _suppliers(spark, sf_dir).withColumn("r", roles.caption_roles(name)).select("s_suppkey", F.col("r.employer").alias("employer_name"), F.col("r.union").alias("union_name"))


#: The heading of a tally, with its two columns of challenged ballots.
_TALLY = "Code   Employer   Union   Unit".ljust(92) + "Pop Cast Yes No   Challenged   Challenged"
_UNIT = "printf('%03d.%04d', s_suppkey % 1000, s_suppkey // 1000)"


@query(f"""SELECT 'WI_WERC:2026_spring:' || {_UNIT} AS row_key, 'City of ' || {TOWN} AS employer_name, 'AFSCME Local ' || {K} AS union_name, 'Clerks and Aides' AS bargaining_unit_name, CAST(45 + s_suppkey % 12 AS VARCHAR) AS votes_yes,
  CASE WHEN s_suppkey % 5 = 0 THEN '' WHEN s_suppkey % 12 >= 6 THEN 'true' ELSE 'false' END AS meets_51pct_threshold, CASE s_suppkey % 4 WHEN 1 THEN '2' WHEN 3 THEN '4' ELSE '' END AS challenged_unit_population,
  CASE s_suppkey % 4 WHEN 2 THEN '3' WHEN 3 THEN '5' ELSE '' END AS challenged_votes, '2026-03-18' AS election_open_date, 'April 8, 2026' AS tally_as_of, {TOWN} AS jurisdiction_city FROM supplier""")
def dataset_wisconsin(spark, sf_dir):
    """Tally lines: a threshold of the unit, units of nobody, challenged ballots by the heading that is nearer."""
    s = _suppliers(spark, sf_dir)
    left, right = _TALLY.index("Challenged"), _TALLY.rindex("Challenged")
    pop = F.when(F.col("s_suppkey") % 5 == 0, 0).otherwise(100)
    names = F.concat(F.format_string("%03d.%04d", F.col("s_suppkey") % 1000, F.floor(F.col("s_suppkey") / 1000)), filled("   City of {town}   AFSCME Local {k}   Clerks and  Aides"))
    line = F.concat(F.rpad(names, 92, " "), F.format_string("%d  60  %d  9", pop, F.col("s_suppkey") % 12 + 45))
    at = lambda c, n, value: F.concat(F.rpad(c, n, " "), F.lit(value))
    kind = F.col("s_suppkey") % 4
    line = F.when(kind == 1, at(line, left, "2")).when(kind == 2, at(line, right, "3")).when(kind == 3, at(at(line, left, "4"), right, "5")).otherwise(line)
    text = F.concat(F.lit(f"VOTES CAST AS OF April 8, 2026 IN ANNUAL\nCONDUCTED 3/18/2026 THROUGH 4/7/2026\n{_TALLY}\n"), line)
    made = run(spark, "werc-election-results", documents=s.select(filled("https://w.example/2026-spring-results-{k}x.pdf").alias("url"), text.alias("text")))
    return made.select("row_key", "employer_name", "union_name", "bargaining_unit_name", "votes_yes", "meets_51pct_threshold", "challenged_unit_population", "challenged_votes", "election_open_date", "tally_as_of", "jurisdiction_city")


@arrow_udf("binary")
def _archive(names: pd.Series) -> pd.Series:
    """An archive of empty files of these names."""

    def packed(members) -> bytes:
        data = io.BytesIO()
        with zipfile.ZipFile(data, "w") as z:
            for name in members:
                z.writestr(name, "")
        return data.getvalue()

    return pd.Series([packed(x) for x in names], dtype="object")


@query(f"""SELECT '34-' || {K} AS case_number, {TOWN} || ' Sch. Bd' AS employer_name, {TOWN} || ' EA' AS union_name, 'ARBITRATION' AS canonical_case_type, 'VT_VLRB:34-' || {K} || ':34-' || {K} || ' ' || {TOWN} || ' EA v. ' || {TOWN} || ' Sch. Bd.pdf' AS row_key FROM supplier
UNION ALL SELECT '35-' || {K}, 'State of Vermont', CASE WHEN s_suppkey % 2 = 1 THEN 'Gr. of VSEA' ELSE '' END, 'ARBITRATION', 'VT_VLRB:35-' || {K} || ':35-' || {K} || ' Gr. of ' || CASE WHEN s_suppkey % 2 = 1 THEN 'VSEA' ELSE {TOWN} END || '.pdf' FROM supplier""")
def dataset_vermont(spark, sf_dir):
    """The names of files in archives: parties, grievances of unions and of persons; what is no PDF is left out, repeats of a later volume too."""
    s = _suppliers(spark, sf_dir)
    members = F.array(filled("v/34-{k} {town} EA v. {town} Sch. Bd.pdf"), F.concat(filled("35-{k} Gr. of "), odd("VSEA", "{town}"), F.lit(".pdf")), F.lit("notes.txt"), filled("34-{k} {town} EA v. {town} Sch. Bd.pdf"))
    archives = s.select(filled("https://v.example/V34-{k}.zip").alias("url"), F.lit("34").alias("volume_number"), F.lit("Volume 34").alias("volume_label"), _archive(members).alias("content"))
    return run(spark, "vt-vlrb-volume-decisions", archives=archives).select("case_number", "employer_name", "union_name", "canonical_case_type", "row_key")


@query(f"""SELECT 'ak-alra-board-decisions' AS slug, 'AK_ALRA:' || {K} || ':17-' || {K} || '-' || ['ULP', 'RC', 'UC'][s_suppkey % 3 + 1] AS row_key,
  row_number() OVER (ORDER BY CASE WHEN length({K}) < 6 THEN lpad({K}, 6, '0') ELSE {K} END, '17-' || {K} || '-' || ['ULP', 'RC', 'UC'][s_suppkey % 3 + 1]) AS position FROM supplier
UNION ALL SELECT 'fl-perc-certifications', 'FL_PERC:' || {K}, row_number() OVER (ORDER BY s_suppkey) FROM supplier
UNION ALL SELECT 'pa-plrb-final-orders', 'PA_PLRB:2026:PF-R-25-' || {K} || '-W:pf-r-25-' || {K} || '-w.pdf', row_number() OVER (ORDER BY 'PF-R-25-' || {K} || '-W' DESC) FROM supplier""")
def dataset_positions(spark, sf_dir):
    """Each row's place in its dataset: numbers padded, numbers as numbers, and text descending."""
    made = None
    for slug, given in (("ak-alra-board-decisions", _alaska), ("fl-perc-certifications", _florida), ("pa-plrb-final-orders", _pennsylvania)):
        spec = dataset.get(slug)
        rows = spec.positions(_frames(spark, spec, given(spark, sf_dir)), SCRAPED, AS_OF).select(F.lit(slug).alias("slug"), "row_key", "position")
        made = rows if made is None else made.union(rows)
    return made
