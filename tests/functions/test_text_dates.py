"""Text and date functions, each on small tables."""

from datetime import date
from html import unescape

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docketloom.functions import dates, text

AS_OF = date(2026, 9, 30)


def each(spark, make, values):
    df = spark.createDataFrame([(k, v) for k, v in enumerate(values)], "k int, v string")
    return [r.r for r in df.withColumn("r", make(F.col("v"))).orderBy("k").collect()]


def test_text(spark):
    nbsp = " "
    assert each(spark, text.squash, [f" a {nbsp} b\n", None, ""]) == ["a b", None, ""]
    assert each(spark, text.strip_html, ["<p>A&amp;B<br/>c</p>  d", "x &eacute;"]) == ["A&B\nc d", "x é"]
    assert each(spark, text.slug, ["City of St. Paul", "--", None]) == ["CITY_OF_ST_PAUL", "UNKNOWN", "UNKNOWN"]
    assert each(spark, text.key_part, ["A b/c"]) == ["A-B-C"] and each(spark, text.header_key, ["Case No."]) == ["caseno"]
    for s in ("o'brien-smith", "AFSCME LOCAL 88", "x1y", ""):
        assert each(spark, text.title_case, [s]) == [s.title()]
    assert each(spark, text.strip_unbalanced, ["AFL-CIO (IBPO)", "Respondent. ) )", "a)b(c)"]) == ["AFL-CIO (IBPO)", "Respondent.    ", "a b(c)"]
    assert each(spark, text.before_unbalanced, ["Town (x) ) Case", "a"]) == ["Town (x)", "a"]
    assert each(spark, text.clean_party, ["The City of X,&amp;nbsp; Petitioner, v.", "Town of Y ) Case No. 12", "AFSCME, Respondent."]) == ["City of X", "Town of Y", "AFSCME"]
    assert [tuple(r) for r in each(spark, text.trailing_parenthesis, ["Union (all staff)", "Union"])] == [("Union", "all staff"), ("Union", "")]
    assert [tuple(r) for r in each(spark, text.count_prefix, ["335-Mechanics", "Pilots", "1,200 - Crew"])] == [("335", "Mechanics"), ("", "Pilots"), ("1200", "Crew")]
    assert [tuple(r) for r in each(spark, text.approximate_count, ["AFSCME (approx. 1,200 employees).", "IAFF"])] == [("1200", "AFSCME"), ("", "IAFF")]
    assert each(spark, text.roster_entries, ["A - u1, B (X, KS), C, KS, D"]) == [["A - u1", "B (X, KS)", "C, KS", "D"]]
    assert each(spark, lambda c: text.capped_at_word(c, 9), ["one two three", "short"]) == ["one two", "short"]
    assert each(spark, text.file_stem, ["https://x/a/Case%20No.1.pdf?x=1"]) == ["Case No.1"]
    assert each(spark, lambda c: text.query_value(c, "id"), ["http://x?a=1&id=b%20c", "http://x"]) == ["b c", ""]
    assert [tuple(r) for r in each(spark, lambda c: text.split_first(c, (" / ", " - ")), ["a - b / c", "a - b", "a"])] == [("a - b", "c"), ("a", "b"), ("a", "")]


def test_urls_join_as_the_library_does(spark):
    from urllib.parse import urljoin

    pairs = [(b, h) for b in ("https://h.org/a/b.html?q=1", "https://h.org", "http://h.org/x/") for h in ("c.pdf", "/d/e.pdf", "//o.org/f", "https://z/y", "../up.pdf", "a b.pdf", "?n=2", "#top", "./g", "k/../m")]
    df = spark.createDataFrame(pairs, "b string, h string").withColumn("r", text.absolute_url("b", "h"))
    for r in df.collect():
        assert r.r == urljoin(r.b, r.h), (r.b, r.h)


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="ab1 ;&lt", max_size=20), min_size=1, max_size=5))
def test_spans_are_python_finditer(spark, values):
    import re

    got = each(spark, lambda c: text.spans(c, "[ab]+1?"), values)
    assert [[(s.start, s.raw) for s in r] for r in got] == [[(m.start(), m[0]) for m in re.finditer("[ab]+1?", v)] for v in values]
    assert each(spark, text.unescape_html, values) == [unescape(v) for v in values]


def hits(rows):
    return [[(h.iso, h.raw) for h in r] for r in rows]


def test_find_dates(spark):
    values = ["DATE: June 29, 2026", "this seventeenth day of March, 2026", "29th day of June, A.D. 2026 and 6/30/2026", "the twenty-first day of May 2020", "February 30, 2020", "June 1, 3036", "June 1, 1934", "may 5th, 2027 then 1/2/1999", None, ""]
    assert hits(each(spark, lambda c: dates.find_dates(c, AS_OF), values)) == [
        [("2026-06-29", "June 29, 2026")],
        [("2026-03-17", "seventeenth day of March, 2026")],
        [("2026-06-29", "29th day of June, A.D. 2026"), ("2026-06-30", "6/30/2026")],
        [("2020-05-21", "twenty-first day of May 2020")],
        [], [], [],
        [("2027-05-05", "may 5th, 2027"), ("1999-01-02", "1/2/1999")],
        [], [],
    ]


def test_date_after(spark):
    values = ["ORDERED on May 1, 2020. Later IT IS SO ORDERED. Dated June 2, 2021, then July 3, 2022", "no anchor May 1, 2020", "IT IS SO ORDERED " + "x" * 500 + " May 1, 2020", None]
    got = each(spark, lambda c: dates.date_after(c, (r"IT IS SO ORDERED", r"BY ORDER"), AS_OF), values)
    assert [g and g.iso for g in got] == ["2021-06-02", None, None, None]
    assert got[0].start == values[0].index("June 2")


def test_small_dates(spark):
    assert [g and (g.iso, g.precision) for g in each(spark, lambda c: dates.year_only(c, AS_OF), [" 2010 ", "3036", "May 2010"])] == [("2010", "year"), None, None]
    assert each(spark, lambda c: dates.iso(dates.month_stamp(c)), ["Jul 25 2025", "Foo 1 2020"]) == ["2025-07-25", ""]
    assert each(spark, lambda c: dates.iso(dates.slash_date(c, 80)), ["9/19/13", "9/19/85", "13/1/2000", "1/2/2003"]) == ["2013-09-19", "1985-09-19", "", "2003-01-02"]
    assert each(spark, dates.compact_date, ["20240131T0", "2024-01-31", "x"]) == ["2024-01-31", "2024-01-31", ""]
    assert each(spark, dates.month_as_of, ["as of March 2024", "as of July 1, 2023", ""]) == ["2024-03-01", "2023-07-01", ""]
    assert each(spark, dates.fiscal_year, ["x-FY2014.pdf", "fy27", "none"]) == ["FY14", "FY27", ""]
