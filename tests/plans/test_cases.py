"""Case pages, determinations, weekly reports and rosters on made inputs."""

import re
from datetime import date

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docketloom.plans import cases, weekly  # noqa: F401
from docketloom.sources import events

from .helpers import check, run


def test_nebraska(spark):
    html = "<html><head><title>x</title></head><!--[if gte mso 9]><xml><w>99 28</w></xml><![endif]--><p>NEBRASKA COMMISSION OF INDUSTRIAL RELATIONS</p><p>IBEW LOCAL 1536,<br>Petitioner,</p><p>v.</p><p>CITY OF LINCOLN,<br>Respondent.</p><p>Case\nNo. 1427</p><p>Filed March 6, 2017</p><p>The Petitioner filed on May 1, 2015</p></html>"
    links = [("https://n/i", "19_CIR_xx", "/ncir/data/reporter/19_CIR_191_(2017)_IBEW_1536_v_LES.htm"), ("https://n/i", "1_CIR_xx", "/ncir/data/reporter/1_CIR_1_(1948).html"), ("https://n/i", "2_CIR_xx", "/ncir/data/reporter/odd_name.html")]
    rows = run(spark, "ne-cir-reporter", links=links, documents=[("https://www.nebraska.gov/ncir/data/reporter/19_CIR_191_(2017)_IBEW_1536_v_LES.htm", html)])
    check(
        rows,
        {"row_key": "NE_CIR:1_CIR_1_1948", "employer_name": "CIR Volume 1 p.1", "party_source": "filename"},
        {"case_number": "odd name", "canonical_case_type": "ARBITRATION"},
        {"case_number": "19 CIR 191 (2017)", "employer_name": "CITY OF LINCOLN", "union_name": "IBEW LOCAL 1536", "petitioner": "IBEW LOCAL 1536", "cir_case_number": "1427", "decision_date": "2017-03-06", "party_source": "caption"},
    )


def test_maine(spark):
    page = "<title>{t}</title><pre>STATE OF MAINE\nCase No. 02-UC-01\nIssued: August 20, 2013\n_________________ )\nMSAD NO. 6 TEACHERS (MSEA), )\nPetitioner, ) UNIT CLARIFICATION\nand )\nMSAD NO. 6, )\nPublic Employer. )\n__________________ )\nThe body.</pre>"
    rows = run(spark, "me-mlrb-unit-rep-cases", pages=[("https://m/02-uc-01.htm", page.format(t="A and B, 02-UC-01")), ("https://m/93-e-01.htm", "<title>In Re: Petition for Certification, Town of Bar (Teamsters), May 1, 1993</title>"), ("https://m/CV-84-235.htm", "<title>A v. B, 354 A.2d 154</title>")])
    check(
        rows,
        {"case_number": "02-UC-01", "employer_name": "MSAD NO. 6", "union_name": "MSAD NO. 6 TEACHERS (MSEA)", "decision_date": "August 20, 2013", "canonical_case_type": "UNIT_CLARIFICATION", "jurisdiction_city": ""},
        {"employer_name": "Town of Bar", "union_name": "Teamsters", "decision_date": "May 1, 1993", "canonical_case_type": "CERTIFICATION", "jurisdiction_city": "Bar"},
        {"native_case_type": "CV", "employer_name": "", "union_name": ""},
    )


def test_determinations(spark):
    html = "<table><tr><th>Page Cite</th><th>Date</th><th>Case</th><th>Carrier</th><th>Union</th><th>Craft/Class</th><th>Disposition</th><th>31 NMB Number</th></tr><tr><td>289</td><td>5/1/04</td><td>R-6952 (CR-6800)</td><td>American</td><td>PAFCA</td><td>Dispatchers</td><td>Certification</td><td><a href='/a.pdf'>15</a></td></tr><tr><td>290</td><td>6/1/04</td><td>R-7000</td><td>X</td><td>Y</td><td>Z</td><td>Certification Revoked</td><td></td></tr></table>"
    text = "the Board certifies that the Transport Workers Union of America has been duly designated and authorized to represent for the purposes"
    rows = run(spark, "nmb-representation-determinations", pages=[("https://n/fy2004-determinations/", html)], documents=[("https://n/a.pdf", text, "text_layer")])
    check(
        rows,
        {"row_key": "NMB:R-6952:DISPATCHERS:289:5-1-04", "case_cross_references": "CR-6800", "certified_representative": "Transport Workers Union of America", "applicant_union": "PAFCA", "representation_asserted": "true", "fiscal_year": "2004", "nmb_volume_number": "15"},
        {"representation_asserted": "false", "canonical_case_type": "", "certified_representative": ""},
    )


_MONTH_DAY = re.compile(r"\b(" + "|".join(sorted(weekly.MONTH_NAMES, key=len, reverse=True)) + r")\.?\s+(\d{1,2})(?:st|nd|rd|th)?(?:\s*,?\s*((?:19|20)\d{2}))?", re.I)


def plain_week(*texts):
    """The rule in plain Python, text by text."""
    for raw in texts:
        text = re.sub(r"[-_/]+", " ", raw) if "://" in raw or re.fullmatch(r"[\w\-/.:]+", raw) else raw
        days = [(weekly.MONTH_NAMES[m[1].lower()], int(m[2]), int(m[3]) if m[3] else None) for m in _MONTH_DAY.finditer(text)]
        if len(days) == 1 and days[0][2] is None:
            behind = re.match(r"\s*(?:-|–|—|through|thru|to)?\s*(\d{1,2})\s*,?\s*((?:19|20)\d{2})\b", text[_MONTH_DAY.search(text).end() :], re.I)
            days = [(days[0][0], d, int(behind[2])) for d in (days[0][1], int(behind[1]))] if behind else days
        known = []
        for k, (month, day, year) in enumerate(days[:2]):
            later = [d[2] for d in days[k + 1 :] if d[2]]
            year = later[0] - (days[k + 1][0] < month) if year is None and later else year
            try:
                known += [date(year, month, day).isoformat()] if year else []
            except ValueError:
                pass
        if known:
            return ("", known[0]) if len(known) == 1 or re.search(r"week\s+ending", text, re.I) else (known[0], known[-1])
    return "", ""


def weeks(spark, rows):
    made = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "k int, a string, b string, c string")
    return [tuple(r.w) for r in made.select("k", weekly.report_week(F.col("a"), F.col("b"), F.col("c")).alias("w")).orderBy("k").collect()]


def test_week_forms(spark):
    cases = [
        (("November 15 — November 19, 2010",), ("2010-11-15", "2010-11-19")),
        (("Week Ending July 9, 1999",), ("", "1999-07-09")),
        (("December 29 – January 2, 2026",), ("2025-12-29", "2026-01-02")),
        (("", "https://n/weekly-activity-report-july-5-9-2004/"), ("2004-07-05", "2004-07-09")),
        (("September 4-8, 2006",), ("2006-09-04", "2006-09-08")),
        (("nothing",), ("", "")),
        (("Week ending March 1 - March 5, 2004",), ("", "2004-03-01")),
        (("February 30, 2004", "May 3, 2004"), ("", "2004-05-03")),
    ]
    rows = [(*texts, *[""] * (3 - len(texts))) for texts, _ in cases]
    assert weeks(spark, rows) == [want for _, want in cases] == [plain_week(*r) for r in rows]


def test_a_week_binds_its_text(spark):
    made = spark.range(1).select(weekly.report_week(F.concat(F.lit("bound once"), F.col("id").cast("string"))).alias("w"))
    assert made._jdf.queryExecution().optimizedPlan().toString().count("bound once") == 1


PIECE = st.sampled_from(["January ", "Febuary ", "dec. ", "May ", "Sept ", "7", "28", "30", "31st", "1", ", ", " - ", "-", " through ", " to ", "2004", "1999", " 2010", "week ending ", "https://x/", "_", "Marching ", "é", "\n"])


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(*[st.lists(PIECE, max_size=8).map("".join)] * 3), min_size=40, max_size=80))
def test_weeks_against_the_plain_rule(spark, rows):
    assert weeks(spark, rows) == [plain_week(*r) for r in rows]


def test_weekly_reports(spark):
    body = (
        '<title>Weekly</title><div class="entry-content"><p>November 15 – November 19, 2010</p><p>New Dockets:</p><table><tr><td>Case No.</td><td>Carrier</td><td>Org.</td><td>Class/Craft</td><td>Mediator</td></tr>'
        "<tr><td>A-13000-02</td><td>Delta</td><td>ALPA</td><td>Pilots</td><td>Smith</td></tr><tr><td></td><td></td><td>IAM</td><td>Mechanics</td><td></td></tr></table>"
        "<p>Arbitration:</p><table><tr><td>A-1111</td><td>x</td><td>y</td><td>z</td></tr></table><p>Ratifications: None</p><p>Elections Underway:</p>"
        "<table><tr><td>R-7626 10/02/24</td><td>Air Co</td><td>AFA</td><td>335-Flight Attendants</td><td>12/1/10</td></tr></table><p>Odd Heading:</p><table><tr><td>R-1234</td><td>a</td><td>b</td><td>c</td></tr></table></div><footer>"
    )
    pages = [("https://n/1", "https://n/i", body), ("https://n/2", "https://n/i", body), ("https://n/3", "https://n/i", "<title>Page not found</title>")]
    rows = run(spark, "nmb-weekly-activity-reports", pages=pages)
    assert len(rows) == 5 and len({r["row_key"] for r in rows}) == 5 and {r["source_url"] for r in rows} == {"https://n/1"}
    by = {(r["case_number"], r["union_name"]): r for r in rows}
    assert set(by) == {("A-13000", "ALPA"), ("A-13001", "ALPA"), ("A-13002", "ALPA"), ("A-13002", "IAM"), ("R-7626", "AFA")}
    assert by["A-13002", "IAM"]["employer_name"] == "Delta" and by["A-13002", "IAM"]["craft_class"] == "Mechanics"
    r = by["R-7626", "AFA"]
    assert (r["section"], r["approx_employees"], r["craft_class"], r["docket_date"], r["count_date"], r["report_week_end"], r["canonical_case_type"]) == ("election_underway", "335", "Flight Attendants", "2024-10-02", "2010-12-01", "2010-11-19", "CERTIFICATION")
    assert by["A-13000", "ALPA"]["row_key"] == "NMB-WAR:2010-11-19:MEDIATION-NEW-DOCKET:A-13000:ALPA:PILOTS"


def test_reports_are_read_once_and_sorted_once(spark):
    pages = spark.createDataFrame([("https://n/1", "i", "<p>New Dockets:</p>")], "source_url string, source_page_url string, html string")
    plan = weekly.parse_reports(pages)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython [") == 1 and plan.count("Sort [") == 1


MARKUP = st.sampled_from(["<p>", "</p>", "<br/>", "<table border=1>", "</table>", "<tr>", "</TR >", "<tr/>", "<td class='a b'>", "</td>", "<th>", "<title>", "</title>", "<script>", "</script>", "<!-- x -->", "< p", "a &amp; b", "&copy", "<p x=<b>>", "A-1", "Case No.", " \n", "</p x>", "<a href=x/>", "é<"])


@settings(max_examples=300, deadline=None)
@given(st.lists(MARKUP, max_size=25).map("".join))
def test_plain_markup_reads_as_the_parser_reads_it(html):
    reader = events._Reader()
    reader.feed(html)
    reader.close()
    reader.end_run()
    assert events.read_page(html) == ("".join(reader.title), reader.out)


@given(st.lists(st.sampled_from(["Case No.", "C.a-se", "DOCKET", "Docket No", "Carrier", "carriers", "Carrier/Craft", "Employer", "Org.", "", "x", "Approx. Case", "dock", "(case)"]), max_size=5))
def test_headings_against_all_patterns(cells):
    under = [next((c for test, c in weekly.HEADINGS if re.fullmatch(test, re.sub(r"[^a-z0-9]+", "", cell.lower()))), ()) for cell in cells]
    places = {c: k for k, columns in reversed([*enumerate(under)]) for c in columns}
    assert weekly.heading_of(cells) == (places if {"case", "carrier"} <= places.keys() else None)


def test_vertical_tables():
    cells = ["Case No.", "Carrier", "Org.", "Class/Craft", "A-1", "C", "O", "K"]
    made = weekly.regrouped([{"kind": "row", "text": "", "cells": [c]} for c in cells] + [{"kind": "text", "text": "x", "cells": []}])
    assert [e["cells"] for e in made] == [cells[:4], cells[4:], []]


def test_wisconsin(spark):
    text = "VOTES CAST AS OF April 8, 2026 IN ANNUAL\nCONDUCTED 3/18/2026 THROUGH 4/7/2026\nCode   Employer   Union   Unit                     Pop Cast Yes No   Challenged   Challenged\n001.0002   City of Ripon   AFSCME Local 1   Clerks   100  60  51  9\n002.0003   Beloit   WEAC   Teachers  and Aides   0  0  0  0               2"
    rows = run(spark, "werc-election-results", documents=[("https://w/2026-spring-results.pdf", text)])
    check(
        rows,
        {"unit_code": "001.0002", "employer_name": "City of Ripon", "union_name": "AFSCME Local 1", "meets_51pct_threshold": "true", "votes_yes": "51", "jurisdiction_city": "Ripon", "election_open_date": "2026-03-18", "tally_as_of": "April 8, 2026", "challenged_votes": ""},
        {"meets_51pct_threshold": "", "challenged_unit_population": "2", "challenged_votes": "", "bargaining_unit_name": "Teachers and Aides"},
    )


def test_new_mexico(spark):
    text = "NEW MEXICO PUBLIC BARGAINING\nUpdated Feb. 2026\nUNITS SUBJECT TO LOCAL BOARDS:\n 1. Albuquerque, City of\n   a. AFSCME Local 624 (Blue collar\n      workers) (approx.. 1,200 employees).\n   b. Anthony Police Dept (Full-time officers)\n1 | P a g e\nUNIONS REPRESENTING STATE EMPLOYEES\n 1. AFSCME Council 18\n   a. Department of Health (Nurses)\n      i. something\n 2. School for the Deaf\n   a. Teachers Association (All teachers)\n"
    rows = run(spark, "nm-pelrb-bargaining-units", documents=[("https://n/x.pdf", text)])
    check(
        rows,
        {"employer_name": "Albuquerque, City of", "union_name": "AFSCME Local 624", "bargaining_unit_name": "Blue collar workers", "approx_employees": "1200", "jurisdiction_city": "Albuquerque", "roster_as_of_date": "2026-02-01", "unit_letter": "a"},
        {"union_name": "", "bargaining_unit_name": "Anthony Police Dept (Full-time officers)"},
        {"employer_name": "Department of Health", "union_name": "AFSCME Council 18", "jurisdiction_section": "state_employees"},
        {"employer_name": "School for the Deaf", "union_name": "Teachers Association", "bargaining_unit_name": "All teachers"},
    )


def test_kansas(spark):
    prose = "<strong>Cities</strong>: Abilene - Police; Fire*, USD 500 (Kansas City, KS) - Clerical, Hays*<br><strong>Counties</strong>: Ellis, Johnson County - Deputies<br/>"
    legacy = "<strong>City of Hays</strong><br>Bargaining Unit<br>Police<br>Fire*<br>"
    rows = run(spark, "ks-peera-unit-rosters", pages=[("https://k/a", 1, "Access Denied akamai"), ("https://k/b", 2, prose), ("https://k/c", 3, legacy)])
    assert [(r["employer_name"], r["bargaining_unit_name"], r["representation_status"], r["jurisdiction_city"]) for r in rows] == [("Abilene", "Fire", "DECERTIFIED", "Abilene"), ("Abilene", "Police", "CERTIFIED", "Abilene"), ("Ellis County", "", "CERTIFIED", "Ellis"), ("Hays", "", "DECERTIFIED", "Hays"), ("Johnson County", "Deputies", "CERTIFIED", "Johnson"), ("USD 500 (Kansas City, KS)", "Clerical", "CERTIFIED", "Kansas City")]
    rows = run(spark, "ks-peera-unit-rosters", pages=[("https://k/c", 3, legacy)])
    assert [(r["bargaining_unit_name"], r["representation_status"]) for r in rows] == [("Fire", "DECERTIFIED"), ("Police", "CERTIFIED")]
