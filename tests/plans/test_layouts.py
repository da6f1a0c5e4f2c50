"""Fixed-width documents: drifting columns, two columns, continuation lines."""

from docketloom.plans import layouts  # noqa: F401

from .helpers import check, run

IL = """\
                                  CERTIFICATIONS OF REPRESENTATIVE
                                   July 1, 2013 – June 30, 2014
  Case Name
                                                          Date       Prevailing    No. of             U
Case Number         Employer          Labor Organization  Certified     Party      Employees     Unit Certified
S-RC-13-058         City of Red Bud   Illinois FOP Labor  7/10/13       FOP          6          Full-time sworn police
Majority Interest                     Council                                                   officers

S-UC-13-068         Cook County       AFSCME              7/11/2013     AFSCME       12         Clerks
and
S-UC-13-069

                                  GUBERNATORIAL DESIGNATIONS
Case Number         Employer          State Agency        Date         Positions
                                                          Certified
S-DE-14-001         State of Illinois  Dept. of Revenue   5/2/2014     3
"""


def test_illinois(spark):
    rows = run(spark, "il-ilrb-bargaining-certs", documents=[("https://i/FY14.pdf", "FY14", IL)])
    by = {r["case_number"]: r for r in rows}
    assert set(by) == {"S-RC-13-058", "S-UC-13-068+S-UC-13-069", "S-DE-14-001"}
    r = by["S-RC-13-058"]
    assert (r["employer_name"], r["union_name"], r["certified_date"], r["employees"], r["native_case_type"], r["jurisdiction_city"]) == ("City of Red Bud", "Illinois FOP Labor Council", "7/10/2013", "6", "MAJORITY_INTEREST", "Red Bud")
    assert r["bargaining_unit_name"].startswith("Full-time sworn police officers") and r["table_heading"] == "CERTIFICATIONS OF REPRESENTATIVE"
    r = by["S-UC-13-068+S-UC-13-069"]
    assert (r["employer_name"], r["union_name"], r["canonical_case_type"], r["jurisdiction_city"]) == ("Cook County", "AFSCME", "UNIT_CLARIFICATION", "Cook County")
    r = by["S-DE-14-001"]
    assert (r["agency"], r["union_name"], r["canonical_case_type"]) == ("Dept. of Revenue", "", "DESIGNATION_EXCLUDED")


#: Cells above their case's line, rows without a blank line between them, a case number one space from its employer.
ABOVE = """\
                                                                   Date         Prevailing        # of
  Case No.           Employer         Labor Organization          Certified       Party         Employees                   Unit Description

                                               CERTIFICATIONS OF REPRESENTATION

                                                                              Brotherhood
                                    Brotherhood of Clerks                     of Clerks                     Included: All clerks of the
 S-RC-26-001 Alder, City of         and Stewards, Local 9          7/9/2026   Local 9              14       city hall.
                                                                              Allied
                                    Allied Workers                            Workers Union,
 L-RC-26-002 Birch, County of       Union, Local 73               7/10/2026   Local 73             1        Include: Drivers


              Cedar County Circuit  International Association                 Association of                Included: All full-time
 S-RC-26-003 Clerk                  of Machine Workers            7/13/2026   Machine Workers      5        deputies

 S-RC-26-004 Dogwood, Village of    Allied Workers Council 31      8/3/2026   Council 31           4        Included: Plumbers
"""


def test_illinois_with_cells_above_their_case(spark):
    by = {r["case_number"]: r for r in run(spark, "il-ilrb-bargaining-certs", documents=[("https://i/FY27.pdf", "FY27", ABOVE)])}
    want = {
        "S-RC-26-001": ("Alder, City of", "Brotherhood of Clerks and Stewards, Local 9", "7/9/2026", "14", "Included: All clerks of the city hall."),
        "L-RC-26-002": ("Birch, County of", "Allied Workers Union, Local 73", "7/10/2026", "1", "Include: Drivers"),
        "S-RC-26-003": ("Cedar County Circuit Clerk", "International Association of Machine Workers", "7/13/2026", "5", "Included: All full-time deputies"),
        "S-RC-26-004": ("Dogwood, Village of", "Allied Workers Council 31", "8/3/2026", "4", "Included: Plumbers"),
    }
    assert {k: tuple(r[c] for c in ("employer_name", "union_name", "certified_date", "employees", "bargaining_unit_name")) for k, r in by.items()} == want


def test_illinois_names_glued_and_companions():
    assert layouts._without_overlap("City of Kent Town of Green Hills", "Town of Green Hills Park") == "City of Kent"
    assert layouts._without_overlap("Town of Green Hills", "Town of Green Hills") == "Town of Green Hills" and layouts._without_overlap("a b", "") == "a b"
    table = layouts._Table("H", ["case", "employer", "certified"], [0, 14, 40], ["S-DE-14-001   State of Ill      5/2/2014", "S-DE-14-002", "", "and", "S-DE-14-003   State of Ill      5/2/2014", "", "S-DE-14-004   State of Ill      6/2/2014"])
    assert [(r["case_number"], r["certified_date"]) for r in table.read()] == [("S-DE-14-001+S-DE-14-002+S-DE-14-003", "5/2/2014"), ("S-DE-14-004", "6/2/2014")]


def test_hawaii(spark):
    text = "HRS CHAPTER 89\nHAWAII FIRE FIGHTERS                Unit 11 (Firefighters) 2/4/72*\nASSOCIATION, LOCAL 1463 (HFFA)\nBobby Lee\nPresident\n2305 S. Beretania Street, Honolulu, Hawaii 96826\nTel. 949-1566\nwww.hawaiifirefighters.org/\n\nUNITED PUBLIC WORKERS               Unit 1 (Blue collar 10/20/71\n                                    workers)\n"
    rows = run(spark, "hi-hlrb-employee-orgs", documents=[("https://h/x.pdf", text)])
    check(
        rows,
        {"unit_number": "1", "bargaining_unit_name": "Unit 1 (Blue collar workers)", "union_name": "UNITED PUBLIC WORKERS", "recertified": "N", "jurisdiction_city": "Honolulu"},
        {"unit_number": "11", "union_name": "HAWAII FIRE FIGHTERS ASSOCIATION, LOCAL 1463 (HFFA)", "contact_name": "Bobby Lee", "contact_title": "President", "employer_street": "2305 S. Beretania Street", "employer_zip": "96826", "union_phone": "949-1566", "union_website": "www.hawaiifirefighters.org", "recertified": "Y", "certification_date": "2/4/72"},
    )


def test_nevada(spark):
    text = "LOCAL GOVERNMENT\nBoulder City    Ann   Lee   401 California Ave   Boulder City NV 89005 (702) 293-9000   ann@b.gov   Teamsters Local 14   All staff   www.bc.gov\n                 IAFF Local 3645   Fire\n                 (BFFA)\n                 Ann\nElko County    Bob   Roe   1 Main St.   Elko NV 89801   775-738-5398   b@e.gov   None\nPage 1 of 2\n"
    rows = run(spark, "nv-emrb-employer-directory", documents=[("https://n/x.pdf", text)])
    check(
        rows,
        {"employer_name": "Boulder City", "union_name": "IAFF Local 3645", "bargaining_unit_name": "Fire"},
        {"union_name": "Teamsters Local 14", "bargaining_unit_name": "All staff", "contact_name": "Ann Lee", "contact_email": "ann@b.gov", "contact_phone": "(702) 293-9000", "website": "www.bc.gov", "employer_zip": "89005"},
        {"employer_name": "Elko County", "union_name": "", "row_key": "NV_EMRB:ELKO_COUNTY:NO_UNION:NO_UNIT", "employer_street": "1 Main St."},
    )


def test_all_datasets_are_registered():
    from docketloom.plans import cases, dataset

    assert cases and len(dataset.REGISTRY) == 26
    assert all(len(set(d.columns)) == len(d.columns) and "row_key" in d.columns for d in dataset.REGISTRY.values())
