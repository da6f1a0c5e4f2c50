"""Datasets of case pages and determinations: Nebraska, Maine, the mediation board; and the outline and prose rosters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import captions, dates, roles
from ..functions.text import absolute_url, before_unbalanced, blank, clean_party, file_name, header_key, html_lines, key_part, plain_punctuation, roster_entries, slug, squash, strip_html
from ..operators import carry, rules
from ..sources.tables import title
from . import rosters, weekly
from .dataset import ENDS, PLACE, dataset, first_clause, key, or_else, without_place_word
from .listings import DOCUMENTS, HREF, with_documents

# --- Nebraska -------------------------------------------------------------------------------------------------------------

NE_SITE = "https://www.nebraska.gov"
NE_FILE = r"(?i)^(\d+)_CIR_?(\d+)__?\((\d{4})\)(?:_(.+))?$"
NE_STATE = r"(?i)^(STATE OF NE(?:BRASKA)?|THE STATE OF NE(?:BRASKA)?)\b"
NE_TYPES = [("(?i)decertif", "DECERTIFICATION"), ("(?i)certif|represent|election|bargaining unit", "CERTIFICATION")]


def nebraska_file(rest: Column) -> Column:
    """struct(employer, union) of a reporter file's words: around the last " v ", else before "City of"."""
    t = F.trim(F.regexp_replace(blank(rest), "_+", " "))
    t = F.replace(F.replace(t, F.lit(" Ass n"), F.lit(" Ass'n")), F.lit(" Int l"), F.lit(" Int'l"))
    versus, city = r"(?i)^(.*)\s(?:v|vs)\s(.*)$", r"(?i)^(.+?)\s+(City of .+)$"
    part = lambda p, k: F.trim(F.regexp_extract(t, p, k), F.lit(" -_"))
    return F.struct(
        F.when(t.rlike(versus), part(versus, 2)).when(t.rlike(city), part(city, 2)).otherwise(t).alias("employer"),
        F.when(t.rlike(versus), part(versus, 1)).when(t.rlike(city), part(city, 1)).otherwise(F.lit("")).alias("union"),
    )


@dataset(
    slug="ne-cir-reporter", agency="NE_CIR", constants={"native_case_type": "CIR_REPORTER", "jurisdiction_state": "NE"}, order=["_volume", "_page"], inputs={"links": "url string, volume_dir string, href string", "documents": "url string, html string"}, first_wins=(["row_key"], ["_volume", "href"]),
    columns=("row_key", "source_agency_code", "case_number", "canonical_case_type", "native_case_type", "cir_volume", "cir_page", "decision_year", "decision_date", "decision_date_raw", "decision_date_precision", "cir_case_number", "employer_name", "union_name", "petitioner", "respondent", "party_source", "document_title", *PLACE, *ENDS),
)
def nebraska(frames, as_of) -> DataFrame:
    """Nebraska CIR reporter; a caption in the decision decides both parties."""
    r = frames["links"].withColumns({"document_title": F.regexp_replace(file_name("href"), r"(?i)\.html?$", ""), "source_url": absolute_url(F.lit(f"{NE_SITE}/"), F.col("href"))})
    part = lambda k: F.regexp_extract("document_title", NE_FILE, k)
    fits = F.col("document_title").rlike(NE_FILE)
    r = r.withColumns({"cir_volume": F.when(fits, part(1)).otherwise(F.substring_index("volume_dir", "_", 1)), "cir_page": part(2), "decision_year": part(3), "_f": F.when(fits, nebraska_file(part(4))).otherwise(F.struct(F.replace(F.col("document_title"), F.lit("_"), F.lit(" ")).alias("employer"), F.lit("").alias("union")))})
    r = r.withColumn("case_number", F.when(fits, F.concat("cir_volume", F.lit(" CIR "), "cir_page", F.lit(" ("), "decision_year", F.lit(")"))).otherwise(F.substring(F.replace(F.col("document_title"), F.lit("_"), F.lit(" ")), 1, 80)))
    d = frames["documents"].select(F.col("url").alias("_url"), html_lines(F.regexp_replace("html", "(?is)<head\\b.*?</head>", " ")).alias("_lines"))
    r = r.join(d, F.col("source_url") == F.col("_url"), "left").withColumn("_lines", F.coalesce("_lines", F.array().cast("array<string>")))
    index = lambda test: F.array_position(F.transform("_lines", test), F.lit(True)).cast("int")
    r = r.withColumn("_start", index(lambda x: F.contains(F.lower(x), F.lit("commission of industrial relations"))))
    r = r.withColumn("_rest", F.expr("slice(_lines, _start + 1, 100000)"))
    stop = F.array_position(F.transform("_rest", lambda x: F.lower(x).rlike("^case no|findings and order|^nature of the case")), F.lit(True)).cast("int")
    r = r.withColumn("_stop", F.when(stop > 0, stop - 1).otherwise(F.size("_rest")))
    caption = squash(F.array_join(F.expr("slice(_rest, 1, _stop)"), " "))
    sides = F.split(caption, r"(?i)(?<![A-Za-z])vs?\.?(?![A-Za-z])", 2)
    filed = F.get(F.filter(F.expr("slice(_rest, _stop + 1, 12)"), lambda x: x.rlike(r"(?i)^filed\b")), F.lit(0))
    r = r.withColumns({"_l": F.substring(clean_party(F.get(sides, F.lit(0))), 1, 240), "_r": F.substring(clean_party(blank(F.get(sides, F.lit(1)))), 1, 240), "_hit": F.get(dates.find_dates(blank(filed), as_of), F.lit(0)), "cir_case_number": F.regexp_extract(F.array_join("_rest", "\n"), r"(?i)\bcase\s+no\.?\s*(\d+(?:\.\d+)?)", 1)})
    both = (F.col("_l") != "") & (F.col("_r") != "")
    r = r.withColumn("_roles", roles.assign_roles(F.when(both, F.col("_l")), F.when(both, F.col("_r"))))
    decided = (F.col("_roles.employer") != "") | (F.col("_roles.union") != "")
    e, u = F.when(decided, F.substring("_roles.employer", 1, 240)).otherwise(F.col("_f.employer")), F.when(decided, F.substring("_roles.union", 1, 240)).otherwise(F.col("_f.union"))
    stray = F.trim(u).rlike(NE_STATE)  # the respondent state is no union
    employer = F.when(stray & ((e == "") | F.trim(e).rlike(NE_STATE)), F.trim(u)).otherwise(e)
    union = F.when(stray, F.lit("")).otherwise(u)
    named = (employer != "") | (union != "")
    return r.withColumns({
        "employer_name": F.when(named, employer).when(fits, F.concat(F.lit("CIR Volume "), "cir_volume", F.lit(" p."), "cir_page")).otherwise(employer), "union_name": union, "party_source": F.when(decided, "caption").otherwise(F.lit("filename")),
        "petitioner": F.when(both, F.col("_l")).otherwise(F.lit("")), "respondent": F.when(both, F.col("_r")).otherwise(F.lit("")), "decision_date": blank(F.col("_hit.iso")), "decision_date_raw": blank(F.col("_hit.raw")), "decision_date_precision": blank(F.col("_hit.precision")),
        "canonical_case_type": F.when(fits, rules.first_match("document_title", NE_TYPES, "ARBITRATION")).otherwise(F.lit("ARBITRATION")), "row_key": F.when(fits, key("NE_CIR", F.concat("cir_volume", F.lit("_CIR_"), "cir_page", F.lit("_"), "decision_year"))).otherwise(key("NE_CIR", F.substring("document_title", 1, 120))),
        "source_page_url": F.col("url"), "_volume": F.lpad("cir_volume", 3, "0"), "_page": F.lpad("cir_page", 5, "0"),
    })


# --- Maine ----------------------------------------------------------------------------------------------------------------

ME_INDEX = "https://www.maine.gov/mlrb/decisions/rep/"
ME_DATE = r"(?:January|February|March|April|May|June|July|August|September|October|November|December)\s+\d{1,2},\s+\d{4}"
ME_TYPES = {"E": "CERTIFICATION", "EA": "CERTIFICATION", "UC": "UNIT_CLARIFICATION", "UCA": "UNIT_CLARIFICATION", "UD": "UNIT_MODIFICATION", "UDA": "UNIT_MODIFICATION", "A": "ARBITRATION", "MERGER": "UNIT_MODIFICATION", "IR": "CERTIFICATION", "AP": "CERTIFICATION"}
ME_ROLES = [(r"(?i)^petitioners?\s+and\s+public\s+employer$", "both"), (r"(?i)^(?:public\s+)?employer$", "employer"), (r"(?i)^(?:certified\s+|incumbent\s+)?bargaining\s+agent(?:\s*/\s*intervenor)?$", "union"), (r"(?i)^petitioners?$", "petitioner")]
ME_FURNITURE = r"(?i)^(?:STATE\s+OF\s+MAINE|MAINE\s+LABOR\s+RELATIONS\s+BOARD|Case\s+No\.|Issued:|and|v\.)\b"
ME_CASE_TAIL = r"(?i),?\s*(?:Case\s+)?No\.\s*\d{2}-[A-Z]+(?:-\d+[A-Z]?)?\.?\s*$"
ME_CITE_TAIL = r"(?i),?\s*(?:No\.\s*)?(?:\d{2}-[A-Z]+(?:-\d+[A-Z]?)?|\d+\s*A\.?\s*2d\s*\d+)\.?\s*$"


def maine_name(line: Column) -> Column:
    bare = F.regexp_replace(squash(line), "[,.]+$", "")
    return F.regexp_replace(F.trim(F.regexp_replace(F.regexp_replace(F.trim(F.regexp_replace(bare, ME_CASE_TAIL, "")), ",+$", ""), ME_CITE_TAIL, "")), ",+$", "")


@dataset(
    slug="me-mlrb-unit-rep-cases", agency="ME_MLRB", constants={"jurisdiction_state": "ME", "source_page_url": ME_INDEX}, order=["case_number"], inputs={"pages": "url string, html string"},
    columns=("row_key", "source_agency_code", "case_number", "canonical_case_type", "native_case_type", "employer_name", "union_name", "document_title", "decision_date", *PLACE, *ENDS),
)
def maine(frames, as_of) -> DataFrame:
    """Maine unit and representation cases; roles come from printed labels, never from the caption's order."""
    p = frames["pages"].withColumns({"_file": file_name("url"), "document_title": or_else(title("html"), file_name("url")), "_text": F.translate(strip_html("html"), " ", " ")})
    issued = rf"(?i)Issued:\s*({ME_DATE})"
    p = p.withColumns({"_issued": F.regexp_extract("_text", issued, 1), "_body": F.when(F.col("_text").rlike(issued), F.try_element_at(F.split("_text", issued, 2), F.lit(2))).otherwise(F.col("_text"))})
    lines = p.select("url", F.posexplode(F.slice(F.split("_body", "\n"), 1, 80)).alias("pos", "raw"))
    ruled = F.trim("raw").rlike(r"^(?=[^_\-]*[_\-]{5})[_\-—)\s]+$")
    lines = lines.withColumn("line", F.trim(before_unbalanced(F.trim("raw")))).withColumn("line", F.when(F.col("line").rlike("[A-Za-z0-9]"), F.col("line")))
    lines = lines.withColumn("_over", ruled | (F.length("line") > 100)).withColumn("_long", F.length("line") > 100)
    w = carry.Window.partitionBy("url").orderBy("pos")
    seen = F.count(F.when(~F.col("_over"), F.col("line"))).over(w.rowsBetween(carry.Window.unboundedPreceding, carry.Window.currentRow))
    # the block ends at a long paragraph, or at a rule that is not the first and has lines before it
    rule_no = F.sum(F.when(ruled, 1).otherwise(0)).over(w)
    lines = lines.withColumns({"_n": seen, "_r": rule_no}).withColumn("_end", F.max(F.when(F.coalesce("_long", F.lit(False)) | (ruled & (F.col("_r") > 1) & (F.col("_n") > 0)), 1).otherwise(0)).over(w))
    lines = lines.filter((F.col("_end") == 0) & F.col("line").isNotNull() & ~ruled & (F.col("_n") <= 40))
    label = F.trim(F.col("line"), F.lit(" ,.;:"))
    lines = lines.withColumn("role", F.nullif(rules.first_match(label, ME_ROLES), F.lit("")))
    name = F.when(F.col("role").isNull() & ~F.trim("line").rlike(ME_FURNITURE), F.nullif(maine_name(F.col("line")), F.lit("")))
    lines = carry.carry_forward(lines.withColumn("name", name), {"above": F.col("name")}, ["url"])
    lines = carry.carry_backward(lines, {"below": F.col("name")}, ["url"])
    of = lambda role, c="above": F.min_by(F.col(c), F.when((F.col("role") == role) & F.col(c).isNotNull(), F.col("pos")))
    last_both = F.max_by("below", F.when((F.col("role") == "both") & F.col("above").isNotNull(), F.col("pos")))
    employer = F.min_by("above", F.when(F.col("role").isin("both", "employer") & F.col("above").isNotNull(), F.col("pos")))
    petitioners = F.array_distinct(F.transform(F.array_sort(F.collect_list(F.when((F.col("role") == "petitioner") & F.col("above").isNotNull(), F.struct("pos", F.col("above").alias("n"))))), lambda x: x["n"]))
    told = lines.groupBy("url").agg(employer.alias("_e"), of("union").alias("_u"), last_both.alias("_b"), petitioners.alias("_p")).withColumnRenamed("url", "_url")
    p = p.join(told, F.col("url") == F.col("_url"), "left")
    other = F.array_join(F.filter(F.coalesce("_p", F.array().cast("array<string>")), lambda x: F.lower(x) != F.lower("_e")), "; ")
    by_label = F.when(F.col("_e").isNotNull(), or_else("_u", F.when(F.lower("_b") != F.lower("_e"), F.col("_b")), other)).otherwise(F.lit(""))
    dated = rf"(?i),\s*({ME_DATE})\s*$"
    bare = F.regexp_replace(F.trim(F.regexp_replace(F.regexp_replace("document_title", dated, ""), ME_CITE_TAIL, "")), ",+$", "")
    in_re = F.trim(F.regexp_replace(F.when(F.size(F.split(bare, r"(?i)\s+v\.\s+|\s+and\s+")) > 1, F.lit("")).otherwise(F.regexp_extract(bare, r"(?i)^In\s+Re:\s*(.+)$", 1)), r"(?i)^Petition for (?:Decertification|Certification)\s*,?\s*", ""))
    unlabelled = F.col("_e").isNull()
    employer_name = F.when(unlabelled, F.trim(F.regexp_replace(in_re, r"\(([^)]+)\)\s*$", ""))).otherwise(F.col("_e"))
    p = p.withColumns({"employer_name": blank(employer_name), "union_name": F.when(unlabelled, F.regexp_extract(in_re, r"\(([^)]+)\)\s*$", 1)).otherwise(by_label), "decision_date": or_else("_issued", F.regexp_extract("document_title", dated, 1))})
    stem = F.regexp_replace("_file", r"\.[^.]*$", "")
    pieces = F.split(F.upper(stem), "-")
    prefix = or_else(F.upper(F.regexp_extract("_file", r"(?i)^\d{2}-([A-Z]+)(?:-\d+[A-Z]?)?\.htm$", 1)), F.when(F.get(pieces, F.lit(0)).rlike("^[A-Z]+$"), F.get(pieces, F.lit(0))), F.when(F.get(pieces, F.lit(1)).rlike("^[A-Z]+$"), F.get(pieces, F.lit(1))), F.lit("UNKNOWN"))
    kinds = [("(?i)decertif", "DECERTIFICATION"), ("(?i)voluntary recognition|unit agreement", "RECOGNITION"), ("(?i)unit clarification", "UNIT_CLARIFICATION")]
    city = first_clause(without_place_word(F.col("employer_name"), "City|Town|Village"), 1000)
    return p.withColumns({
        "case_number": F.upper(stem), "native_case_type": prefix, "canonical_case_type": or_else(rules.first_match("document_title", kinds), rules.lookup(prefix, ME_TYPES, "CERTIFICATION")), "row_key": key("ME_MLRB", F.upper(stem)), "source_url": F.col("url"),
        "jurisdiction_city": F.when(F.col("employer_name").rlike(r"(?i)\bv\.|No\.|A\.2d") | (F.length(city) > 60), F.lit("")).otherwise(city),
    })


# --- the mediation board: determinations ------------------------------------------------------------------------------------

#: Words by which a disposition certifies nobody. Fixed values.
NOT_CERTIFIED = r"transfer|revocation|revoke|decert|dismiss|denied|deny|withdraw|extinguish|not subject|not confirmed|re-run|rerun"


def certifies(disposition: Column) -> Column:
    t = F.lower(squash(blank(disposition)))
    return ~t.rlike(NOT_CERTIFIED) & t.rlike(r"\bcertif(?:ication|ications|ies|ied|y)\b|\bcert\b")


@dataset(
    slug="nmb-representation-determinations", agency="NMB", order=["determination_date", "row_key"], unique=True, inputs={"pages": "url string, html string", "documents": DOCUMENTS},
    columns=("row_key", "source_agency_code", "case_number", "case_cross_references", "canonical_case_type", "native_case_type", "employer_name", "union_name", "applicant_union", "certified_representative", "certification_text_snippet", "representation_asserted", "craft_class", "nmb_volume_number", "page_cite", "determination_date", "fiscal_year", *PLACE, *ENDS),
)
def determinations(frames, as_of) -> DataFrame:
    """Representation determinations; only a read certification names a representative."""
    table = r"(?is)<table\b[^>]*>(.*?)</table>"
    rows = F.regexp_extract_all(F.regexp_extract("html", table, 1), F.lit(r"(?is)<tr\b[^>]*>(.*?)(?=<tr\b|$)"), F.lit(1))
    cells_of = F.transform(rows, lambda r: F.regexp_extract_all(r, F.lit(r"(?is)<t[dh]\b[^>]*>(.*?)(?=</t[dh]>|<t[dh]\b|$)"), F.lit(1)))
    t = frames["pages"].select("url", F.filter(cells_of, lambda r: F.size(r) > 0).alias("_rows")).filter(F.size("_rows") > 1)
    t = t.withColumn("_head", F.transform(F.get("_rows", F.lit(0)), lambda c: header_key(F.regexp_replace(c, "<[^>]+>", " "))))
    place = lambda k: F.array_position("_head", F.lit(k)).cast("int")
    number = F.array_position(F.transform("_head", lambda h: h.rlike(r"^\d+nmbnumber$")), F.lit(True)).cast("int")
    wanted = ("pagecite", "date", "case", "carrier", "union", "craftclass", "disposition")
    t = t.withColumns({**{f"_{k}": place(k) for k in wanted}, "_number": number})
    missing = F.expr(" or ".join(f"_{k} = 0" for k in wanted))
    t = t.withColumn("_ok", F.when(missing, F.raise_error(F.concat(F.lit("determinations table without its headings: "), "url"))).otherwise(F.lit(True))).filter("_ok")
    r = t.select("url", *(f"_{k}" for k in wanted), "_number", F.explode(F.expr("slice(_rows, 2, 100000)")).alias("raw"))
    at = lambda k: blank(F.expr(f"get(raw, _{k} - 1)"))
    r = r.withColumns({f"c_{k}": squash(strip_html(at(k))) for k in (*wanted, "number")})
    hrefs = F.filter(F.array(F.regexp_extract(at("pagecite"), HREF, 1), F.when(F.col("_number") > 0, F.regexp_extract(at("number"), HREF, 1)).otherwise(F.lit("")), F.regexp_extract(F.array_join("raw", " "), HREF, 1)), lambda x: x != "")
    r = r.withColumns({"case_number": squash(F.regexp_replace("c_case", r"\s*\([^)]*\)", "")), "_href": F.get(hrefs, F.lit(0))}).filter("case_number <> '' and c_craftclass <> ''")
    r = r.withColumn("source_url", F.when(F.col("_href").isNotNull(), absolute_url(F.col("url"), F.col("_href"))).otherwise(F.col("url")))
    certified = certifies(F.col("c_disposition"))
    r = with_documents(r.withColumn("_pdf", F.when(certified & F.lower("source_url").endswith(".pdf"), F.col("source_url")).otherwise(F.lit(""))), frames["documents"], "_pdf").withColumn("_s", captions.certification_sentence("text"))
    return r.withColumns({
        "row_key": key("NMB", key_part("case_number"), key_part("c_craftclass"), key_part("c_pagecite"), key_part("c_date")), "case_cross_references": F.array_join(F.regexp_extract_all("c_case", F.lit(r"(?i)\b(?:RD|CR)-\d+\b"), F.lit(0)), "; "),
        "canonical_case_type": F.when(certified, "CERTIFICATION").otherwise(F.lit("")), "native_case_type": F.col("c_disposition"), "employer_name": F.col("c_carrier"), "union_name": F.col("c_union"), "applicant_union": F.col("c_union"), "certified_representative": F.col("_s.name"), "certification_text_snippet": F.col("_s.snippet"),
        "representation_asserted": F.when(certified, "true").otherwise("false"), "craft_class": F.col("c_craftclass"), "nmb_volume_number": F.when(F.col("_number") > 0, F.col("c_number")).otherwise(F.lit("")), "page_cite": F.col("c_pagecite"), "determination_date": F.col("c_date"),
        "fiscal_year": F.regexp_extract("url", r"(?i)(?:fy)?(19\d{2}|20\d{2})-determinations/?$", 1), "source_page_url": F.col("url"),
    })


@dataset(slug="nmb-weekly-activity-reports", agency="NMB", order=weekly.ORDER, unique=True, inputs={"pages": "source_url string, source_page_url string, html string"}, columns=weekly.COLUMNS)
def weekly_reports(frames, as_of) -> DataFrame:
    """Weekly activity reports of the mediation board."""
    return weekly.keyed_reports(frames["pages"])


# --- Wisconsin, New Mexico, Kansas -------------------------------------------------------------------------------------------

WI_PAGE = "https://werc.wi.gov/"


def election_cycle(url: Column) -> Column:
    """SPRING_2026 and the like out of an address, in either order of season and year; empty if it names none."""
    season, year = F.lower(F.regexp_extract(url, r"(?i)(spring|fall|apr(?:il)?|nov(?:ember)?)", 1)), F.regexp_extract(url, r"(20\d{2})", 1)
    name = F.when(season.rlike("^(spring|apr)"), "spring").when(season != "", "fall").otherwise(F.lit(""))
    return F.when((name != "") & (year != ""), F.concat_ws("_", year, name)).otherwise(F.lit(""))


@dataset(
    slug="werc-election-results", agency="WI_WERC", constants={"canonical_case_type": "CERTIFICATION", "native_case_type": "ANNUAL_CERTIFICATION_ELECTION", "document_status": "endpoint_tally", "jurisdiction_state": "WI", "source_page_url": WI_PAGE}, order=["election_cycle", "unit_code"], inputs={"documents": "url string, text string"},
    columns=("row_key", "source_agency_code", "unit_code", "canonical_case_type", "native_case_type", "employer_name", "union_name", "bargaining_unit_name", "unit_population", "votes_cast", "votes_yes", "votes_no", "challenged_unit_population", "challenged_votes", "meets_51pct_threshold", "document_status", "tally_as_of", "election_open_date", "election_close_date", *PLACE, "election_cycle", "source_pdf_url", *ENDS),
)
def wisconsin(frames, as_of) -> DataFrame:
    """Wisconsin election tallies: a tally is no result, and says so."""
    window = r"(?i)CONDUCTED\s+(\d{1,2}/\d{1,2}/\d{4})\s+THROUGH\s+(\d{1,2}/\d{1,2}/\d{4})"
    day = lambda k: dates.iso(dates.slash_date(F.regexp_extract("text", window, k), 80))
    d = frames["documents"].select("url", "text", rosters.challenged_columns("text").alias("_x"), squash(F.regexp_extract("text", r"(?i)VOTES\s+CAST\s+AS\s+OF\s+([^\n]*?)\s+IN\s+ANNUAL", 1)).alias("tally_as_of"), day(1).alias("election_open_date"), day(2).alias("election_close_date"), election_cycle(F.col("url")).alias("election_cycle"))
    r = rosters.tally_lines(rosters.text_lines(d), challenged="_x")
    city = first_clause(without_place_word(F.col("employer_name"), "City|Town|Village|County"))
    return r.withColumns({"meets_51pct_threshold": F.col("meets_51_percent"), "row_key": key("WI_WERC", "election_cycle", "unit_code"), "source_pdf_url": F.col("url"), "source_url": F.col("url"), "jurisdiction_city": city})


NM_SECTIONS = {"UNITS SUBJECT TO LOCAL BOARDS": "local_boards", "UNIONS REPRESENTING STATE EMPLOYEES": "state_employees", "LOCAL BARGAINING UNITS SUBJECT TO THE PELRB": "pelrb_local"}
NM_UNION = r"(?i)\b(Association|Ass'?n|Union|Federation|AFSCME|NEA|AFT|CWA|IAFF|Teamsters|Council\s+\d+)\b"
NM_ORGANISED = r"(?i)\b(Local|Union|Assn|Ass'?n|Association|AFSCME|CWA|NEA|AFT|SEIU|IAFF|FOP|Teamsters|Federation|Council|Chapter|Alliance|Guild|Brotherhood|Employees\s+Association)\b"
NM_JOBS = r"(?i)\b(Operators?|Drivers?|Clerks?|Technicians?|Laborers?|Mechanics?)\b"
NM_ROMAN = r"(?i)^\s*(i{1,3}|iv|vi{0,3}|ix|x)\.\s+"


def new_mexico_count(c: Column) -> Column:
    """struct(rest, count): "(approx.. 10 employees)" out of a roster line."""
    closed, open_ = r"(?i)\(approx\.+\s*([\d,]+)\s+employees?\)\.?", r"(?i)approx\.+\s*([\d,]+)\s+employees?"
    count = F.replace(or_else(F.regexp_extract(c, closed, 1), F.regexp_extract(c, open_, 1)), F.lit(","))
    rest = squash(F.regexp_replace(F.regexp_replace(F.regexp_replace(c, closed, ""), open_, ""), r"\(\s*\)", ""))
    return F.struct(F.regexp_replace(F.when(count != "", rest).otherwise(F.trim(c)), r"[.,:]+$", "").alias("rest"), count.alias("count"))


def union_and_unit(c: Column) -> Column:
    """struct(union, unit): the last telling parenthesis is the unit; a number or a short one belongs to the name."""
    inner = F.trim(F.try_element_at(F.regexp_extract_all(c, F.lit(r"\(([^)]+)\)"), F.lit(1)), F.lit(-1)))
    telling = inner.isNotNull() & ~inner.rlike(r"(?i)^(Local\s+)?\d+$") & (F.length(inner) >= 6)
    head = F.regexp_replace(F.trim(F.regexp_replace(c, r"\([^)]+\)(?!.*\([^)]+\)).*$", "")), "[, ]+$", "")
    return F.struct(F.when(telling, or_else(head, c)).otherwise(c).alias("union"), F.when(telling, inner).otherwise(F.lit("")).alias("unit"))


@dataset(
    slug="nm-pelrb-bargaining-units", agency="NM_PELRB", constants={"canonical_case_type": "CERTIFICATION", "native_case_type": "BARGAINING_UNIT_ROSTER", "jurisdiction_state": "NM", "source_page_url": "https://www.pelrb.nm.gov/nm-public-bargaining/"}, order=["row_key"], inputs={"documents": "url string, text string"},
    columns=("row_key", "source_agency_code", "canonical_case_type", "native_case_type", "jurisdiction_section", "employer_name", "union_name", "bargaining_unit_name", "unit_letter", "approx_employees", *PLACE, "roster_as_of_date", "source_pdf_url", *ENDS),
)
def new_mexico(frames, as_of) -> DataFrame:
    """New Mexico's outline of units: section, numbered employer, lettered unit; wrapped lines belong to what is open."""
    month = r"(?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)[a-z]*"
    header, named = rf"(?i)Updated\s+({month})\.?\s+((?:19|20)\d{{2}})", rf"(?i)-({month})-((?:19|20)\d{{2}})\.pdf$"
    part = lambda k: or_else(F.regexp_extract("text", header, k), F.regexp_extract("url", named, k))
    as_of_date = dates.iso(dates.date_of(F.nullif(part(2), F.lit("")), F.nullif(dates.month_number(part(1)), F.lit(0)), F.lit("1")))
    lines = rosters.text_lines(frames["documents"].select("url", as_of_date.alias("roster_as_of_date"), "text"))
    noise = rf"^\s*\d+\s*\|\s*P\s*a\s*g\s*e\s*$|(?i)NEW MEXICO PUBLIC BARGAINING|UNIT INFORMATION|^Table of Contents|Updated\s+{month}\.?\s+(?:19|20)\d{{2}}"
    lines = lines.filter((F.trim("line") != "") & ~F.col("line").rlike(noise))
    section = F.upper(F.regexp_extract(F.trim("line"), r"(?i)^\s*(UNITS SUBJECT TO LOCAL BOARDS|UNIONS REPRESENTING STATE EMPLOYEES|LOCAL BARGAINING UNITS SUBJECT TO THE PELRB)\s*:?\s*$", 1))
    lines = carry.carry_forward(lines.withColumn("_heads", section != ""), {"section": F.nullif(section, F.lit(""))}, ["url"])
    roman = F.col("line").rlike(NM_ROMAN)
    state = F.coalesce(F.col("section") == "UNIONS REPRESENTING STATE EMPLOYEES", F.lit(False))
    kind = F.when(F.col("_heads"), "section").when(state & roman, F.lit(None)).when(F.col("line").rlike(r"^\s*\d+\.\s+\S"), "emp").when(F.col("line").rlike(r"(?i)^\s*[a-z]\.\s+\S") & ~roman, "unit")
    lines = carry.islands(lines.withColumn("kind", kind), F.col("kind").isNotNull(), ["url"])
    items = lines.groupBy("url", "roster_as_of_date", "island").agg(F.min("pos").alias("pos"), F.min_by("section", "pos").alias("section"), F.max("kind").alias("kind"), plain_punctuation(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "line"))), lambda x: x["line"]), " ")).alias("item")).filter("kind in ('emp', 'unit')")
    heading = new_mexico_count(F.regexp_replace(F.trim(F.regexp_extract("item", r"^(\d+)\.\s+(.+)$", 2)), ":+$", ""))["rest"]
    items = carry.carry_forward(items, {"heading": F.when(F.col("kind") == "emp", F.nullif(heading, F.lit("")))}, ["url"]).filter("kind = 'unit' and heading is not null")
    body = new_mexico_count(F.trim(F.regexp_extract("item", r"(?i)^([a-z])\.\s+(.+)$", 2)))
    u = items.withColumns({"unit_letter": F.lower(F.substring(F.trim("item"), 1, 1)), "_b": body}).withColumns({"_body": F.col("_b.rest"), "approx_employees": F.col("_b.count")}).withColumn("_s", union_and_unit(F.col("_body")))
    unionish, before = lambda c: c.rlike(NM_UNION), F.trim(F.substring_index("_body", "(", 1))
    in_state, under_union = F.col("section") == "UNIONS REPRESENTING STATE EMPLOYEES", unionish(F.col("heading"))
    lone = ~unionish(F.col("_body")) & F.trim("_body").rlike(r"^[A-Z].+\([^)]+\)\s*$")
    invented = ~F.col("_s.union").rlike(NM_ORGANISED) & ((F.size(F.filter(F.split("_s.union", ","), lambda x: F.trim(x) != "")) >= 3) | F.col("_s.union").rlike(NM_JOBS))
    union = F.when(in_state & under_union, F.col("heading")).when(in_state, F.when(unionish(before), F.col("_s.union")).otherwise(F.lit(""))).when(lone | invented, F.lit("")).otherwise(F.col("_s.union"))
    unit = F.when(in_state & under_union, F.col("_body")).when(in_state, F.when(unionish(before), F.col("_s.unit")).otherwise(F.col("_body"))).when(lone, F.col("_body")).when(invented, or_else("_s.unit", "_body")).otherwise(F.col("_s.unit"))
    u = u.withColumns({"employer_name": F.when(in_state & under_union, or_else(before, "_body")).otherwise(F.col("heading")), "union_name": union, "bargaining_unit_name": unit, "jurisdiction_section": rules.lookup("section", NM_SECTIONS)})
    city = F.when(F.regexp_extract("employer_name", ",(.*)$", 1).rlike(r"(?i)\b(City|Town|Village)\s+of\b"), F.trim(F.substring_index("employer_name", ",", 1))).otherwise(F.lit(""))
    return u.withColumns({"row_key": key("NM_PELRB", "jurisdiction_section", slug("employer_name"), "unit_letter"), "jurisdiction_city": city, "source_pdf_url": F.col("url"), "source_url": F.col("url")})


def kansas_status(c: Column) -> Column:
    """struct(name, status, type): a star, or the word, marks what was decertified."""
    gone = F.rtrim(c).endswith("*") | F.contains(F.lower(c), F.lit("decertified"))
    return F.struct(F.trim(F.regexp_replace(F.rtrim(c), r"\*+$", "")).alias("name"), F.when(gone, "DECERTIFIED").otherwise("CERTIFIED").alias("status"), F.when(gone, "DECERTIFICATION").otherwise("CERTIFICATION").alias("type"))


@dataset(
    slug="ks-peera-unit-rosters", agency="KS_PEERA", constants={"native_case_type": "PEERA_UNIT_ROSTER", "jurisdiction_state": "KS"}, order=["employer_name", "bargaining_unit_name"], inputs={"pages": "url string, priority int, html string"},
    columns=("row_key", "source_agency_code", "employer_name", "bargaining_unit_name", "representation_status", "canonical_case_type", "native_case_type", *PLACE, *ENDS),
)
def kansas(frames, as_of) -> DataFrame:
    """Kansas rosters in prose or blocks; of several sources the first that gives rows counts, blocked pages never do."""
    low = F.lower("html")
    blocked = F.contains(low, F.lit("access denied")) & (F.contains(low, F.lit("akamai")) | (F.length("html") < 2000))
    pages = frames["pages"].filter(~blocked)
    prose = lambda word: F.regexp_extract("html", rf"(?is)<strong>\s*{word}\s*</strong>\s*:\s*(.*?)<br\s*/?>", 1)
    sections = pages.select("url", "priority", F.explode(F.array(F.struct(F.lit(False).alias("county"), prose("Cities").alias("body")), F.struct(F.lit(True).alias("county"), prose("Counties").alias("body")))).alias("s"))
    entries = sections.select("url", "priority", "s.county", F.explode(F.transform(roster_entries(strip_html("s.body")), lambda x: F.trim(x, F.lit(" ,")))).alias("entry")).filter("entry <> ''")
    two = F.contains("entry", F.lit(" - "))
    employer = kansas_status(F.when(two, F.substring_index("entry", " - ", 1)).otherwise(F.col("entry")))
    units = F.filter(F.transform(F.split(F.when(two, F.regexp_replace("entry", r"^.*? - ", "")).otherwise(F.lit("")), ";"), lambda x: F.trim(x)), lambda x: x != "")
    entries = entries.select("url", "priority", "county", employer.alias("e"), F.explode_outer(units).alias("u")).withColumn("u", F.when(F.col("u").isNotNull(), kansas_status(F.col("u"))))
    named = F.when(F.col("county") & ~F.col("e.name").rlike(r"(?i)\b(USD|County|Fire|Unified|District|Government)\b"), F.concat("e.name", F.lit(" County"))).otherwise(F.col("e.name"))
    from_prose = entries.select("url", "priority", named.alias("employer_name"), blank(F.col("u.name")).alias("bargaining_unit_name"), F.coalesce("u.status", "e.status").alias("representation_status"), F.coalesce("u.type", "e.type").alias("canonical_case_type"))
    head = r"(?is)^<(?:strong|b)\b[^>]*>\s*([^<]+?)\s*</(?:strong|b)>"
    blocks = pages.select("url", "priority", F.explode(F.split("html", r"(?i)(?=<(?:strong|b)(?:\s[^>]*)?>\s*[^<]+\s*</(?:strong|b)>)")).alias("b")).filter(F.col("b").rlike(head))
    blocks = blocks.select("url", "priority", strip_html(F.regexp_extract("b", head, 1)).alias("employer_name"), F.explode(F.split(strip_html(F.regexp_replace("b", head, "")), "\n")).alias("line")).withColumn("u", kansas_status(F.trim("line")))
    blocks = blocks.filter((F.col("u.name") != "") & ~F.lower("line").startswith("bargaining unit") & ~F.lower("employer_name").isin("peera", "decisions", "cities", "counties", ""))
    from_blocks = blocks.select("url", "priority", "employer_name", F.col("u.name").alias("bargaining_unit_name"), F.col("u.status").alias("representation_status"), F.col("u.type").alias("canonical_case_type"))
    told = from_prose.select(F.col("url").alias("_p")).distinct()
    rows = from_prose.union(from_blocks.join(told, F.col("url") == F.col("_p"), "left_anti"))
    best = rows.agg(F.min("priority").alias("_best"))
    rows = rows.join(F.broadcast(best), F.col("priority") == F.col("_best"))
    inside = F.trim(F.regexp_replace(F.trim(F.regexp_extract("employer_name", r"\(([^)]+)\)", 1)), r"(?i),?\s*KS\.?$", ""))
    outside = F.trim(F.substring_index(F.regexp_replace(F.trim(F.regexp_replace("employer_name", r"(?i),?\s*KS\.?$", "")), r"(?i)\s+County$", ""), "/", 1))
    return rows.withColumns({"row_key": key("KS_PEERA", slug("employer_name"), F.when(F.col("bargaining_unit_name") != "", slug("bargaining_unit_name")).otherwise(F.lit("EMPLOYER"))), "jurisdiction_city": or_else(inside, outside), "source_page_url": F.col("url"), "source_url": F.col("url")})
