"""Datasets whose sources are payloads and harvests: JSON, XML, JSON lines, TSV."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import roles
from ..functions.text import blank, capped, capped_at_word, file_name, labelled_paragraph, squash, strip_html
from ..operators import keys, rules
from ..sources.tables import json_records
from .dataset import ENDS, PLACE, dataset, first_clause, key, or_else, without_place_word

# --- Oregon: offset-paged JSON -----------------------------------------------------------------------------------------

OR_HOST = "https://cdm17027.contentdm.oclc.org"
OR_COLLECTION = "p17027coll9"
#: Tried in order on type and title; the early rules hide later ones, as the source's own types need.
OR_TYPES = [
    ("(?i)unit clarification|representation", "UNIT_CLARIFICATION"), ("(?i)unfair labor practice|ulp", "ULP"), ("(?i)declaratory", "NEGOTIABILITY"),
    ("(?i)arbitration|interest|impasse", "ARBITRATION"), ("(?i)representation costs|attorney fees", "ULP"), ("(?i)personnel relations|sprl", "ULP"),
    ("(?i)certif", "CERTIFICATION"), ("(?i)decertif", "DECERTIFICATION"),
]


def order_case_number(title: Column, official: Column) -> Column:
    """The docket that opens the title or the case name, else one anywhere in the title, else the title itself as a code."""
    opening = r"(?i)^\s*([A-Z]{1,4}-\d{1,4}(?:-\d{2,4})?)\b"
    anywhere = r"(?i)\b([A-Z]{1,4}-\d{1,4}(?:-\d{2,4})?)\b"
    code = F.regexp_replace(F.substring(F.regexp_replace(title, "[^A-Za-z0-9]+", "-"), 1, 40), "^-+|-+$", "")
    return or_else(F.upper(F.regexp_extract(title, opening, 1)), F.upper(F.regexp_extract(official, opening, 1)), F.upper(F.regexp_extract(title, anywhere, 1)), code)


@dataset(
    slug="or-erb-contentdm-orders", agency="OR_ERB", constants={"jurisdiction_state": "OR"}, order=["decision_date", "case_number", "contentdm_pointer"],
    inputs={"pages": "start int, payload string"}, first_wins=(["contentdm_pointer"], ["start", "pos"]),
    totals=lambda frames: (frames["pages"].agg(F.max(F.get_json_object("payload", "$.pager.total").try_cast("int")).alias("total")), F.col("rows") < 0.95 * F.col("total")),
    columns=("row_key", "source_agency_code", "case_number", "canonical_case_type", "native_case_type", "employer_name", "union_name", "document_title", "official_case_name", "decision_date", "contentdm_pointer", "pdf_url", *PLACE, *ENDS),
)
def oregon(frames, as_of) -> DataFrame:
    """Oregon ERB orders from a digital collection's index."""
    records = json_records(frames["pages"], "pointer:string,title:string,subjec:string,type:string,date:string", "records")
    text = lambda c: F.trim(blank(F.col(c)))
    r = records.select("start", "pos", text("pointer").alias("contentdm_pointer"), text("title").alias("document_title"), text("subjec").alias("official_case_name"), or_else(text("type"), F.lit("ORDER")).alias("native_case_type"), text("date").alias("decision_date")).filter("contentdm_pointer <> ''")
    r = r.withColumns({"case_number": order_case_number(F.col("document_title"), F.col("official_case_name")), "_r": roles.caption_roles("official_case_name")})
    pdf = F.concat(F.lit(f"{OR_HOST}/digital/api/collection/{OR_COLLECTION}/id/"), "contentdm_pointer", F.lit("/download"))
    return r.withColumns({
        "row_key": key("OR_ERB", "contentdm_pointer", "case_number"), "canonical_case_type": rules.first_match(F.concat_ws(" ", "native_case_type", "document_title"), OR_TYPES, "ULP"),
        "employer_name": F.col("_r.employer"), "union_name": F.col("_r.union"), "pdf_url": pdf, "source_url": pdf,
        "source_page_url": F.concat(F.lit(f"{OR_HOST}/digital/collection/{OR_COLLECTION}/id/"), "contentdm_pointer"),
        "jurisdiction_city": first_clause(without_place_word(F.col("_r.employer"))),
    }).drop("_r")


# --- California: page-numbered JSON -------------------------------------------------------------------------------------

CA_SITE = "https://perb.ca.gov"
#: The statute that a decision number's letters name. Fixed values.
CA_STATUTES = {"E": "EERA", "M": "MMBA", "H": "HEERA", "S": "DILLS", "C": "TRIAL_COURT", "I": "COURT_INTERPRETER", "J": "JCEERA", "P": "PECC", "R": "TRANSIT", "N": "CHILD_CARE"}
CA_EMPLOYER = ("city", "county", "district", "state of", "school", "university", "college", "regents", "trustees", "town", "hospital", "commission", "authority", "bureau", "department", "municipal", "transit", "court")
CA_UNION = ("union", "association", "federation", "afscme", "seiu", "cta", "nea", "cwa", "teamsters", "local ", "employee organization", "bargaining unit", "guild")
CA_TYPES = [
    (r"(?i)\bdecertif", "DECERTIFICATION"), (r"(?i)\bseverance\b", "SEVERANCE"), (r"(?i)\bunit modif|\bunit clarification\b", "UNIT_MODIFICATION"),
    (r"(?i)\bamendment of certification\b", "AMENDMENT_OF_CERTIFICATION"), (r"(?i)\brequest for recognition\b|\bvoluntary recognition\b", "RECOGNITION"),
    (r"(?i)\bpetition for certification\b|\brepresentation election\b|\bcertification of", "CERTIFICATION"), (r"(?i)\bfact[- ]find", "FACT_FINDING"),
    (r"(?i)\bimpasse\b", "IMPASSE"), (r"(?i)\bnegotiab", "NEGOTIABILITY"), (r"(?i)\barbitrat", "ARBITRATION"), (r"(?i)\bunfair practice\b|\bduty of fair representation\b|\bulp\b", "ULP"),
]
CA_RESPONDENT = (
    r"(?is)Respondent\s+(.+?)\s+(?:violated|breached|retaliated|by\b|and the|thereby|under the|when it|because|for engaging|in its|in the)",
    r"(?is)alleged that(?:\s+the)?\s+(?:Respondent\s+)?(.+?)\s+(?:violated|breached|retaliated|engaged|discriminat)\b",
    r"(?is)(?:unfair practice charge|complaint)\s+against\s+(.+?)(?:\s*,|\s+alleging|\s+for\b|\s+claiming|\.|$)",
)
CA_CHARGING = r"(?is)Charging Part(?:y|ies)\s+(.+?)\s+(?:alleged|appealed|filed|asserted|charged|each appealed)"


def _prose_party(c: Column) -> Column:
    name = F.trim(squash(c), F.lit(" ,.;"))
    return capped_at_word(F.trim(F.regexp_replace(name, r"\s*\([^)]{0,80}\)\s*$", "")), 180)


def prose_parties(description: Column) -> Column:
    """struct(employer, union) named in a decision's description. A name with both kinds of words is a union; a respondent
    that isn't one is the employer."""
    respondent = or_else(*(_prose_party(F.regexp_extract(description, p, 1)) for p in CA_RESPONDENT))
    charging = _prose_party(F.regexp_extract(description, CA_CHARGING, 1))
    has = lambda c, words: F.lower(c).rlike("|".join(words))
    union = lambda c: has(c, CA_UNION)
    employer = lambda c: has(c, CA_EMPLOYER) & ~union(c)
    return F.struct(
        F.when(employer(respondent), respondent).when(employer(charging) & union(respondent), charging).when((respondent != "") & ~union(respondent), respondent).when(employer(charging), charging).otherwise(F.lit("")).alias("employer"),
        F.when(union(respondent), respondent).when(union(charging), charging).otherwise(F.lit("")).alias("union"),
    )


@dataset(
    slug="ca-perb-decisions", agency="CA_PERB", constants={"jurisdiction_state": "CA"}, order=["-decision_date", "-decision_number"],
    inputs={"pages": "page int, payload string"}, first_wins=(["wp_post_id"], ["page", "pos"]),
    columns=("row_key", "source_agency_code", "decision_number", "case_number", "canonical_case_type", "native_case_type", "jurisdiction_statute", "employer_name", "union_name", "document_title", "description", "disposition", "decision_date", "wp_post_id", "pdf_url", *PLACE, *ENDS),
)
def california(frames, as_of) -> DataFrame:
    """California PERB decisions from a publishing API."""
    posts = json_records(frames["pages"], "id:string,slug:string,date:string,link:string,title:struct<rendered:string>,content:struct<rendered:string>")
    p = posts.select("page", "pos", F.trim(blank(F.col("id"))).alias("wp_post_id"), F.trim(blank(F.col("slug"))).alias("slug"), F.substring(blank(F.col("date")), 1, 10).alias("decision_date"), F.trim(blank(F.col("link"))).alias("link"), strip_html(blank(F.col("title.rendered"))).alias("title"), blank(F.col("content.rendered")).alias("content"))
    p = p.filter("wp_post_id <> '' and slug <> ''").withColumns({"description": labelled_paragraph("content", "Description"), "disposition": labelled_paragraph("content", "Disposition")})
    token = F.regexp_replace(F.upper(F.substring_index(F.trim(F.regexp_replace(or_else("title", "slug"), r"(?i)^Decision\s+", "")), " ", 1)), r"[.,;]+$", "")
    grammar = r"^(A?)(\d+)([A-Z]+)$"
    number = F.when(token.rlike(grammar), token).otherwise(F.when(F.upper("slug").rlike(grammar), F.upper("slug")))
    suffix = F.regexp_extract(blank(number), grammar, 3)
    base = F.when((F.length(suffix) > 1) & suffix.endswith("A"), F.regexp_replace(suffix, "A$", "")).otherwise(suffix)
    p = p.withColumns({
        "decision_number": F.coalesce(number, F.nullif(token, F.lit("")), F.upper("slug")), "jurisdiction_statute": rules.lookup(base, CA_STATUTES),
        "native_case_type": F.when(number.isNull(), "DECISION").when(number.startswith("A"), "ALJ_APPEAL").otherwise("BOARD_DECISION"), "_p": prose_parties(F.col("description")),
    })
    plain = or_else("title", "decision_number")
    dashed = F.contains(plain, F.lit(" – ")) | F.contains(plain, F.lit(" - "))
    named = F.when((F.col("_p.employer") != "") & ~dashed, F.concat(F.lit("Decision "), "decision_number", F.lit(" – "), "_p.employer")).otherwise(plain)
    city = F.regexp_replace(without_place_word(F.col("_p.employer"), "City|Town|County|Regents|Trustees", article=True), r"(?i)^State of California\s*(?:\(|$)", "Sacramento")
    p = p.withColumns({"document_title": named, "employer_name": F.col("_p.employer"), "union_name": F.col("_p.union"), "jurisdiction_city": first_clause(city)})
    page = or_else("link", F.concat(F.lit(f"{CA_SITE}/decision/"), "slug", F.lit("/")))
    return p.withColumns({
        "case_number": F.col("decision_number"), "row_key": key("CA_PERB", "decision_number", "wp_post_id"), "pdf_url": F.concat(F.lit(f"{CA_SITE}/wp-content/uploads/decisionbank/decision-"), F.lower("slug"), F.lit(".pdf")),
        "canonical_case_type": rules.first_match(F.concat_ws(" ", "description", "disposition", "document_title"), CA_TYPES, "ULP"),
        "description": capped("description", 4000), "disposition": capped("disposition", 2000), "source_page_url": page, "source_url": page,
    }).drop("_p")


# --- New Jersey: cursor-paged XML ----------------------------------------------------------------------------------------

NJ_SITE = "https://www.perc.state.nj.us"
NJ_VIEW = f"{NJ_SITE}/percdecisions.nsf/IssuedDecisions?ReadViewEntries"
NJ_ENTRY = "viewentry:array<struct<_position:string,_unid:string,entrydata:array<struct<_name:string,_columnnumber:string,text:string,datetime:string>>>>"


@dataset(
    slug="nj-perc-issued-decisions", agency="NJ_PERC", constants={"canonical_case_type": "ULP", "native_case_type": "ISSUED_DECISION", "jurisdiction_state": "NJ", "source_page_url": NJ_VIEW, "union_name": ""},
    order=["-decision_year", "-case_number", "-row_key"], inputs={"pages": "page int, payload string"}, first_wins=(["unid"], ["page", "pos"]),
    columns=("row_key", "source_agency_code", "case_number", "canonical_case_type", "native_case_type", "decision_year", "issued_date", "employer_name", "union_name", "document_title", "pdf_url", *PLACE, *ENDS),
)
def new_jersey(frames, as_of) -> DataFrame:
    """New Jersey PERC issued decisions from a view's XML."""
    from ..operators.carry import carry_forward

    parsed = F.from_xml("payload", f"struct<{NJ_ENTRY}>", {"attributePrefix": "_"})
    e = frames["pages"].select("page", F.posexplode(parsed["viewentry"]).alias("pos", "e"))
    of = lambda test: F.array_join(F.filter(F.transform(F.filter(F.coalesce(F.col("e.entrydata"), F.array().cast("array<struct<_name:string,_columnnumber:string,text:string,datetime:string>>")), test), lambda d: F.trim(F.coalesce(d["text"], d["datetime"]))), lambda x: x != ""), " ")
    name, column = lambda n: of(lambda d: d["_name"] == n), lambda n: of(lambda d: d["_columnnumber"] == n)
    year = F.regexp_extract(column("0"), r"(?:^| )(\d{4})(?: |$)", 1)
    e = e.select("page", "pos", F.col("e._unid").alias("unid"), F.when(F.col("e._unid").isNull(), F.nullif(year, F.lit(""))).alias("year"), or_else(name("$17"), column("2")).alias("link"), squash(or_else(name("$21"), column("5"))).alias("employer_name"), name("IssuedDate").alias("issued"))
    e = carry_forward(e, {"year": F.col("year")}, ["page"]).filter("unid is not null")
    link = r'(?i)href="([^"]+\.pdf\?OpenElement)"'
    e = e.filter(F.col("link").rlike(link)).withColumn("label", or_else(strip_html(F.regexp_extract("link", r'(?i)href="[^"]+\.pdf\?OpenElement"[^>]*>\s*([^<]*?)\s*<', 1)), strip_html(F.regexp_extract("link", r"(?i)>\s*(PERC[^<]+?)\s*<", 1)), F.concat(F.lit("UNID-"), F.substring("unid", 1, 12))))
    docket = r"(?i)PERC\s+(\d{4})-(\d+)"
    number = F.regexp_extract("label", docket, 2)
    e = e.withColumns({
        "case_number": F.when(number != "", F.format_string("PERC %s-%03d", F.regexp_extract("label", docket, 1), number.try_cast("int"))).otherwise(F.col("label")),
        "decision_year": or_else(F.regexp_extract("label", docket, 1), "year"), "issued_date": F.when(F.col("issued").rlike(r"^\d{8}"), F.concat_ws("-", F.substring("issued", 1, 4), F.substring("issued", 5, 2), F.substring("issued", 7, 2))).otherwise(F.lit("")),
        "pdf_url": F.concat(F.lit(f"{NJ_SITE}/"), F.regexp_replace(F.regexp_extract("link", link, 1), "^/+", "")), "row_key": key("NJ_PERC", "unid"),
    })
    city = F.regexp_replace(without_place_word(F.regexp_replace("employer_name", r"(?i)\s+B/E\s*$|\s+Board of Education\s*$", ""), "City|Town|Township|Borough|County"), r"(?i)\s+Cty\b.*$", "")
    return e.withColumns({"document_title": F.col("case_number"), "source_url": F.col("pdf_url"), "jurisdiction_city": first_clause(city)})


# --- Minnesota and New Hampshire: harvest files ---------------------------------------------------------------------------

MN_PAGE = "https://mn.gov/bms/search/"
NH_PAGE = "https://www.pelrb.nh.gov/bargaining-units"


def minnesota_city(employer: Column) -> Column:
    """The place in an employer's name: "City of X", "X County", a school district's place, else the first word."""
    name = squash(blank(employer))
    city, county = F.regexp_extract(name, r"(?i)^(?:City|Town|Township|Village)\s+of\s+(.+)$", 1), F.regexp_extract(name, r"(?i)^(.+?)\s+County\b", 1)
    district, tail = F.regexp_extract(name, r"(?i)^ISD\s+\d[\dA-Za-z\-]*\s*[,\-–]\s*(.+)$", 1), F.regexp_extract(name, r",\s*([^,]+)$", 1)
    return F.substring(
        F.when(name == "", "").when(city != "", first_clause(city)).when((county != "") & ~F.lower(name).startswith("state of"), F.trim(county)).when(district != "", first_clause(district))
        .when((tail != "") & name.rlike("(?i)school|district|education"), F.trim(tail)).otherwise(F.substring_index(F.trim(F.substring_index(name, ",", 1)), " ", 1)), 1, 80)


@dataset(
    slug="mn-bms-certifications", agency="MN_BMS", constants={"canonical_case_type": "CERTIFICATION", "jurisdiction_state": "MN", "source_page_url": MN_PAGE}, order=["_number", "document_id"],
    inputs={"harvest": "document_id string, employer_name string, union_name string, case_number string, doc_class string, title string, document_title string, date string, date_raw string, decision_date string, pdf_url string, caseload_pdf_url string, line long"},
    columns=("row_key", "source_agency_code", "document_id", "case_number", "canonical_case_type", "native_case_type", "employer_name", "union_name", "document_title", "decision_date", *PLACE, "certification_pdf_url", "pdf_file_name", *ENDS),
)
def minnesota(frames, as_of) -> DataFrame:
    """Minnesota BMS certifications from a JSON-lines harvest."""
    text = lambda c: F.trim(blank(F.col(c)))
    day = F.trim(or_else("date", "date_raw", "decision_date"))
    pdf = F.when(F.contains(text("pdf_url"), F.lit("documents2")), text("pdf_url")).otherwise(or_else(text("pdf_url"), text("caseload_pdf_url")))
    r = frames["harvest"].select(
        "line", text("document_id").alias("document_id"), text("case_number").alias("case_number"), F.trim(or_else("doc_class", F.lit("Order-Certification of Excl Rep"))).alias("native_case_type"),
        text("employer_name").alias("employer_name"), text("union_name").alias("union_name"), F.trim(or_else("title", "document_title")).alias("document_title"),
        F.when(F.contains(day, F.lit("T")), F.substring(F.substring_index(day, "T", 1), 1, 10)).when(day.rlike(r"^\d{4}-\d{2}-\d{2}"), F.substring(day, 1, 10)).otherwise(day).alias("decision_date"), pdf.alias("certification_pdf_url"),
    ).filter("document_id <> ''")
    better = r.withColumn("_second", F.when(F.contains("certification_pdf_url", F.lit("documents2")), F.lit("x")).otherwise(F.lit("")))
    kept = keys.prefer_filled(better, "document_id", "line", "employer_name", "_second")
    return kept.withColumns({"row_key": key("MN_BMS", "document_id"), "jurisdiction_city": minnesota_city(F.col("employer_name")), "pdf_file_name": blank(file_name("certification_pdf_url")), "source_url": or_else("certification_pdf_url", F.lit(MN_PAGE)), "_number": F.coalesce(F.col("document_id").try_cast("bigint"), F.lit(0))})


#: Affiliates that may end a New Hampshire listing title. Fixed values.
NH_AFFILIATES = r"(?i)\s+(?:NEA-NH|NHEA/?NEA|NHEA-NEA|NEA|AFSCME|SEA|Teamsters|NEPBA|IAFF|AFT|UAW|NCEU|IBEW|IUPE|ICWU|AAUP|NHTA)\s*$"


@dataset(
    slug="nh-pelrb-certifications", agency="NH_PELRB", constants={"canonical_case_type": "CERTIFICATION", "native_case_type": "CERTIFICATION", "jurisdiction_state": "NH", "source_page_url": NH_PAGE}, order=["_number"],
    inputs={"harvest": "id string, title string, date_posted string, union string, pdf_url string, pdf_filename string"},
    columns=("row_key", "source_agency_code", "document_id", "canonical_case_type", "native_case_type", "employer_name", "union_name", "listing_title", "certification_date", *PLACE, "certification_pdf_url", "pdf_file_name", *ENDS),
)
def new_hampshire(frames, as_of) -> DataFrame:
    """New Hampshire PELRB certifications from a TSV harvest."""
    text = lambda c: F.trim(blank(F.col(c)))
    r = frames["harvest"].select(text("id").alias("document_id"), text("title").alias("listing_title"), text("union").alias("union_name"), text("date_posted").alias("certification_date"), text("pdf_url").alias("certification_pdf_url"), text("pdf_filename").alias("pdf_file_name")).filter("document_id <> '' and listing_title <> ''")
    name, union = squash("listing_title"), squash("union_name")
    cut = F.when((union != "") & F.upper(name).endswith(F.upper(union)), F.regexp_replace(F.left(name, F.length(name) - F.length(union)), r"[ ,/\t-]+$", "")).otherwise(name)
    employer = F.regexp_replace(F.regexp_replace(cut, NH_AFFILIATES, ""), r"[ ,/\t-]+$", "")
    r = r.withColumn("employer_name", employer)
    return r.withColumns({"row_key": key("NH_PELRB", "document_id"), "jurisdiction_city": F.substring(F.substring_index("employer_name", " ", 1), 1, 80), "source_url": or_else("certification_pdf_url", F.lit(NH_PAGE)), "_number": F.col("document_id").try_cast("bigint")})
