"""Datasets over payloads and listing pages, on made inputs."""

import io
import json
import zipfile

from .helpers import check, run


def test_oregon(spark):
    records = [
        {"pointer": "101", "title": "UP-12-17 Order", "subjec": "SEIU Local 503 v. State of Oregon", "type": "Unfair Labor Practice", "date": "2017-05-01"},
        {"pointer": "104", "title": "Ruling", "subjec": "Marion County v. Multnomah County", "type": "", "date": "2017-02-20"},
        {"pointer": "", "title": "x"},
    ]
    again = [{"pointer": "101", "title": "again", "subjec": "", "type": "", "date": ""}]
    rows = run(spark, "or-erb-contentdm-orders", pages=[(0, json.dumps({"records": records})), (200, json.dumps({"records": again})), (400, "broken")])
    check(rows, {"contentdm_pointer": "104", "employer_name": "", "union_name": "", "native_case_type": "ORDER", "canonical_case_type": "ULP"}, {"row_key": "OR_ERB:101:UP-12-17", "employer_name": "State of Oregon", "union_name": "SEIU Local 503", "canonical_case_type": "ULP"})


def test_california(spark):
    content = "<p><strong>Description:</strong> Charging Party Teamsters Local 2010 alleged that Respondent Regents of the University of California violated the Act &amp; more.</p><p><strong>Disposition:</strong> Dismissed.</p>"
    posts = [{"id": 7, "slug": "2900h", "date": "2026-01-02T10:00:00", "link": "https://perb.ca.gov/decision/2900h/", "title": {"rendered": "Decision 2900H"}, "content": {"rendered": content}}, {"id": 8, "slug": "a512e", "date": "2025-01-01", "link": "", "title": {"rendered": ""}, "content": {"rendered": ""}}]
    rows = run(spark, "ca-perb-decisions", pages=[(1, json.dumps(posts))])
    check(
        rows,
        {"row_key": "CA_PERB:2900H:7", "jurisdiction_statute": "HEERA", "native_case_type": "BOARD_DECISION", "employer_name": "Regents of the University of California", "union_name": "Teamsters Local 2010", "disposition": "Dismissed.", "decision_date": "2026-01-02", "document_title": "Decision 2900H – Regents of the University of California", "jurisdiction_city": "University of California"},
        {"decision_number": "A512E", "native_case_type": "ALJ_APPEAL", "jurisdiction_statute": "EERA", "source_url": "https://perb.ca.gov/decision/a512e/", "employer_name": ""},
    )


def test_new_jersey(spark):
    entry = '<viewentry position="{p}" unid="{u}"><entrydata columnnumber="2" name="$17"><text>[&lt;a href="/x/{u}.pdf?OpenElement"&gt;{c}&lt;/a&gt;]</text></entrydata><entrydata columnnumber="5" name="$21"><text>{e}</text></entrydata><entrydata name="IssuedDate"><datetime>20260625T000000,00-04</datetime></entrydata></viewentry>'
    xml = "<viewentries><viewentry position='1'><entrydata columnnumber='0'><text>2026</text></entrydata></viewentry>" + entry.format(p="1.1", u="AA", c="PERC 2026-7", e="Camden Cty Prosecutor") + entry.format(p="1.2", u="BB", c="", e="Newark B/E") + "</viewentries>"
    rows = run(spark, "nj-perc-issued-decisions", pages=[(1, xml), (2, xml)])
    check(rows, {"row_key": "NJ_PERC:BB", "case_number": "UNID-BB", "decision_year": "2026", "jurisdiction_city": "Newark"}, {"case_number": "PERC 2026-007", "issued_date": "2026-06-25", "jurisdiction_city": "Camden", "employer_name": "Camden Cty Prosecutor"})


def test_harvests(spark):
    blank = (None,) * 4
    rows = run(spark, "mn-bms-certifications", harvest=[("9", "", "U1", "c", None, "T", None, "2020-01-02T05", None, None, "https://x/a%20b.pdf", None, 1), ("9", "City of Duluth, MN", "U2", "c", None, "T", None, *blank[:3], "https://x/c.pdf", None, 2), ("10", "ISD 709, Duluth", *blank, None, "20 May", None, None, None, "https://y/z.pdf", 3), ("", *blank, *blank, *blank[:3], 4)])
    check(rows, {"document_id": "9", "union_name": "U2", "jurisdiction_city": "Duluth", "pdf_file_name": "c.pdf"}, {"document_id": "10", "jurisdiction_city": "Duluth", "decision_date": "20 May", "source_url": "https://y/z.pdf"})
    rows = run(spark, "nh-pelrb-certifications", harvest=[("12", "Dover Police AFSCME", "2020", "AFSCME", "", "f.pdf"), ("2", "Keene Teachers - NEA", "2019", "", "https://p", ""), ("", "x", "", "", "", "")])
    check(rows, {"document_id": "2", "employer_name": "Keene Teachers", "jurisdiction_city": "Keene"}, {"employer_name": "Dover Police", "union_name": "AFSCME"})


def test_alaska_washington_new_york_iowa(spark):
    html = '<a href="/laborr/1.pdf">17-1708-ULP</a><a href="/laborr/1.PDF">again</a><a href="/x/UCF.pdf">UCF 90-3</a><a href="a.html">no</a><a href="/x/12.pdf"> </a>'
    rows = run(spark, "ak-alra-board-decisions", pages=[("https://labor.alaska.gov/i.html", html)])
    assert [(r["case_number"], r["canonical_case_type"]) for r in rows] == [("17-1708-ULP", "ULP"), ("DO-12", "ULP"), ("UCF 90-3", "UNIT_CLARIFICATION")]
    table = "<table><tr><th>Date</th><th>Employer</th><th>Case Number</th><th>Status</th></tr><tr><td>1/2/26</td><td><a href='/d.pdf'>x</a><a href=\"/d.pdf\">City &amp; Co</a></td><td>900-U</td><td>Open</td></tr><tr><td>a</td><td></td><td>1</td><td></td></tr></table>"
    check(run(spark, "wa-perc-certifications", pages=[("u", table)]), {"row_key": "WA_PERC:900-U", "date_filed": "1/2/26", "pdf_url": "https://perc.wa.gov/d.pdf", "document_title": "x City & Co (900-U)"})
    table = '<tr><td>Certification No.</td><td>a</td><td>b</td><td>c</td></tr><tr><td>3-70 </td><td><a href="t.pdf">Clerks</a></td><td>DC 37</td><td>12</td></tr>'
    check(run(spark, "nyc_ocb_bargaining_units", pages=[("u", table)]), {"row_key": "NYC_OCB:3-70", "bargaining_unit_name": "Clerks", "titles_pdf_url": "https://www.ocb-nyc.org/t.pdf"})
    page = '<a href="/media/12/download?inline"><h2> City of Adel and Teamsters Local 238 (Police).pdf </h2></a><a href="/media/13/download"><h2>Polk County Jail</h2></a>'
    rows = run(spark, "ia-eab-unit-certifications", pages=[("https://eab.iowa.gov/cities", "cities", page), ("https://eab.iowa.gov/cities?page=1", "cities", page)])
    check(rows, {"media_id": "12", "employer_name": "City of Adel", "union_name": "Teamsters Local 238", "bargaining_unit_name": "Police", "jurisdiction_city": "Adel"}, {"media_id": "13", "union_name": "", "jurisdiction_city": "Polk County"})


def test_maryland(spark):
    card = '<article class="maryland-listing-item__container x"><div class="maryland-listing-item__eyebrow">State</div><a class="maryland-listing-item__title" href="/media/{m}"><span class="maryland-link__document-title">{t}</span></a><div class="maryland-listing-item__date">May 1, 2026</div></article>'
    html = card.format(m=1, t="PERB EL 2026-01, AFSCME, State") + card.format(m=2, t="AFT - College") + card.format(m=412, t="dup") + card.format(m=278, t="x")
    rows = run(spark, "md-perb-election-certs", pages=[("https://www.maryland.gov/l", html)], overrides=[("2", "Howard College", "AFT-Maryland")])
    check(rows, {"row_key": "MD_PERB:1", "case_number": "PERB EL 2026-01", "employer_name": "AFSCME", "union_name": "State", "event_date": "May 1, 2026"}, {"employer_name": "Howard College", "union_name": "AFT-Maryland", "employer_type": "State"}, {"row_key": "MD_PERB:278", "union_name": "Fraternal Order of Police, Lodge 34"})


def test_rhode_island(spark):
    html = '<table class="sortable"><tr><td><a href="a.pdf">Bristol (Clerks, Aides)</a></td><td>EE-1445</td><td>AFSCME</td><td>1/2/90 (3/4/95)</td><td><a href="d.pdf">x</a></td></tr><tr><td>Warren (Town)</td><td>ee-2</td><td>IBPO</td><td>5/6/91</td><td></td></tr></table>'
    text = "In the Matter of\nTown of Bristol, School Committee Emp1oyer -and- AFSCME Council 94, AFL-CIO Pet1tioner. by secret ballot of all clerks. "
    rows = run(spark, "rislrb-certifications", pages=[("http://r/p.htm", "Muni", html)], documents=[("http://r/a.pdf", text, "ocr")])
    check(rows, {"case_number": "EE-1445", "employer_name": "Town of Bristol, School Committee", "union_name": "AFSCME Council 94, AFL-CIO", "unit_description": "Clerks, Aides", "date_certified": "1/2/90", "date_amended": "3/4/95", "canonical_case_type": "UNIT_CLARIFICATION", "jurisdiction_city": "Bristol"}, {"case_number": "EE-2", "employer_name": "Warren (Town)", "canonical_case_type": "CERTIFICATION"})


def test_vermont(spark):
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        for n in ("v/34-207 Rutland EA v. Rutland Sch. Bd.pdf", "34-210 Gr. of Smith.pdf", "34-211 Gr. of VSEA.pdf", "x.txt"):
            z.writestr(n, "")
    rows = run(spark, "vt-vlrb-volume-decisions", archives=[("https://v/V34.zip", "34", "Volume 34", data.getvalue())])
    check(rows, {"case_number": "34-207", "employer_name": "Rutland Sch. Bd", "union_name": "Rutland EA"}, {"employer_name": "State of Vermont", "union_name": "", "canonical_case_type": "ARBITRATION"}, {"union_name": "Gr. of VSEA"})


def test_district_of_columbia(spark):
    row = '<tr><td>{c}</td><td>1/1/12</td><td>165</td><td>RC - Recognition</td><td>{a}</td><td>{b}</td><td>59 DCR</td><td>Cert</td><td><a href="/f?fileid={{12345678-1234-1234-1234-123456789abc}}{c}">x</a></td></tr>'
    html = row.format(c="12-RC-02", a="FOP Lodge 1,", b="District of Columbia Department of Corrections") + row.format(c="13-RC-01", a="AFGE Local 2", b="Department of Health") + row.format(c="14-RC-09", a="A", b="B")
    text = "In the Matter of:\nFOP Lodge 1,\nPetitioner,\nand\nDepartment of Corrections,\nAgency,\nand\nTeamsters Local 9,\nIntervenor.\nCERTIFICATION OF REPRESENTATIVE\nIT IS HEREBY CERTIFIED THAT Teamsters Local 9 has been designated. BY ORDER OF THE PUBLIC EMPLOYEE RELATIONS BOARD Washington December 5, 2018"
    url = "https://casesearch.perb.dc.gov/f?fileid={12345678-1234-1234-1234-123456789abc}"
    rows = run(spark, "dc-perb-certifications", pages=[("https://casesearch.perb.dc.gov/", html)], documents=[(url + "12-RC-02", text, "ocr"), (url + "13-RC-01", "IT IS HEREBY CERTIFIED THAT no representative has been selected", "text_layer")])
    check(
        rows,
        {"case_number": "12-RC-02", "employer_name": "Department of Corrections", "union_name": "Teamsters Local 9", "union_name_source": "certification", "petitioner": "FOP Lodge 1", "intervenor": "Teamsters Local 9", "order_date": "2018-12-05", "order_date_source": "order_block", "canonical_case_type": "RECOGNITION", "row_key": "DC_PERB:12-RC-02:165:12345678-1234-1234-1234-123456789ABC"},
        {"union_name": "", "union_name_source": "no_representative", "employer_name": "Department of Health", "certification_result": "no_representative"},
        {"document_text_method": "fetch_failed", "union_name": "", "certification_result": ""},
    )


def test_florida(spark):
    row = "<tr><td>{n}</td><td>{u}</td><td>{e}</td><td><a href=\"/f.aspx?File={n}.pdf&amp;x=1\">d</a></td></tr>"
    grid = '<table id="gridCases"><tr><th>No</th></tr>' + row.format(n=999, u="PBA", e="") + row.format(n=12, u="-0-", e="x") + "</table>"
    more = '<table id="gridCases">' + row.format(n=999, u="PBA", e="City of West Melbourne, Florida") + "</table>"
    dossier = "ORDER AND CERTIFICATION\nserved June 1, 1992\nORDER REVOKING CERTIFICATION\nMay 2, 1994"
    u = "https://perc.myflorida.com/f.aspx?File={}.pdf&x=1"
    rows = run(spark, "fl-perc-certifications", pages=[("https://perc.myflorida.com/r", 1, grid), ("https://perc.myflorida.com/r", 2, more)], dossiers=[(u.format(999), dossier, "ocr", True, "", True, 50)])
    check(
        rows,
        {"certification_number": "12", "union_name": "", "jurisdiction_state": "", "pdf_fetch_status": "fetch_failed", "certification_status": ""},
        {"certification_number": "999", "employer_name": "City of West Melbourne, Florida", "jurisdiction_city": "City of West Melbourne", "certification_status": "revoked", "certification_order_date": "1992-06-01", "pdf_fetch_status": "ok", "is_image_only": "true", "pdf_file_name": "999.pdf", "latest_order_date": "1994-05-02"},
    )


def test_delaware(spark):
    html = '<a href="/1546-OOD-LiUNA-Local-1029-v-City-of-Dover-1-29-26.pdf">View decision 2026 ULP 1546 LiUNA v Dover</a><a href="/2026-REP-9-Capital-Educators-Assn.pdf">View decision Order of Dismissal</a>'
    text = "PUBLIC EMPLOYMENT RELATIONS BOARD\nDEPARTMENT OF SERVICES,\nCharging Party,\nV.\nEMPLOYEES LOCAL 1029,\nRespondent.\nULP No. 1\nIT IS SO ORDERED.\nDATE: June 29, 2026"
    rows = run(spark, "de-perb-decisions", pages=[("https://d/2026", "2026", html)], documents=[("https://d/2026/1546-OOD-LiUNA-Local-1029-v-City-of-Dover-1-29-26.pdf", "x", "unreadable"), ("https://d/1546-OOD-LiUNA-Local-1029-v-City-of-Dover-1-29-26.pdf", text, "text_layer")])
    check(
        rows,
        {"case_number": "1546", "employer_name": "DEPARTMENT OF SERVICES", "union_name": "EMPLOYEES LOCAL 1029", "party_source": "caption", "order_date": "2026-06-29", "order_date_source": "date_line", "native_case_type": "ULP"},
        {"case_number": "2026", "union_name": "Capital Educators Assn", "employer_name": "", "party_source": "filename", "document_text_method": "fetch_failed"},
    )


def test_pennsylvania(spark):
    html = '<p><a href="/documents/final-orders/pf-r-25-56-w.pdf">Teamsters Local 205</a> PF-R-25-56-W</p><a href="/form/x.pdf">form</a><a href="/documents/pera-c-24-1-e.pdf">AFSCME Local 1 v. Borough of Ambler</a>'
    text = "IN THE MATTER OF THE EMPLOYES OF PENN TOWNSHIP\n\nCase No. PF-R-25-56-W. It was filed with the Pennsylvania Labor Relations Board (Board) on May 1, 2025, by Teamsters Local No. 205, affiliated. HEREBY ORDERS AND DIRECTS that it is dismissed. SEALED, DATED and MAILED this seventeenth day of March, 2026"
    rows = run(spark, "pa-plrb-final-orders", pages=[("https://www.pa.gov/y", "2026", html)], documents=[("https://www.pa.gov/documents/final-orders/pf-r-25-56-w.pdf", text, "text_layer")])
    check(
        rows,
        {"case_number": "PF-R-25-56-W", "canonical_case_type": "CERTIFICATION", "employer_name": "Penn Township", "union_name": "Teamsters Local No. 205", "party_source": "document", "order_disposition": "dismissed", "order_date": "2026-03-17"},
        {"case_number": "PERA-C-24-1-E", "employer_name": "Borough of Ambler", "union_name": "AFSCME Local 1", "party_source": "title", "canonical_case_type": "ULP"},
    )


def test_stated_totals_guard_a_run(spark):
    import pytest

    from docketloom.operators.quality import GuardError
    from docketloom.plans import dataset

    from .helpers import AS_OF, SCRAPED

    def table(slug, rows):
        spec = dataset.get(slug)
        return spec.table({name: spark.createDataFrame(rows, schema) for name, schema in spec.inputs.items()}, SCRAPED, AS_OF)

    records = [{"pointer": str(k), "title": "UP-1-17", "subjec": "", "type": "", "date": ""} for k in range(19)]
    for total, good in ((19, True), (20, True), (21, False), ("x", True)):
        pages = [(0, json.dumps({"pager": {"total": total}, "records": records})), (200, "broken")]
        if good:
            assert table("or-erb-contentdm-orders", pages).count() == 19
        else:
            with pytest.raises(GuardError, match="21"):
                table("or-erb-contentdm-orders", pages)
    items = "".join(f'<a href="/media/{k}/download"><h2>Town {k}</h2></a>' for k in range(5))
    for total, good in ((5, True), (7, True), (8, False)):
        pages = [("https://i/a", "cities", items + f"Displaying 1 - 5 of {total} results"), ("https://i/b", "counties", "no total")]
        if good:
            assert table("ia-eab-unit-certifications", pages).count() == 5
        else:
            with pytest.raises(GuardError, match="cities"):
                table("ia-eab-unit-certifications", pages)
