"""HTML rendering: layout rules by example, and all visible words against the standard library's parser."""

import re
import time
import tracemalloc
from html.parser import HTMLParser

import pytest

from docketloom.llm.htmltext import digest, extract, render

#: What browsers don't show of the pages read here.
UNSEEN = {"head", "script", "style", "template", "title", "noscript", "iframe", "object", "audio", "video", "canvas", "datalist"}


@pytest.mark.parametrize(
    ("html", "text"),
    [
        (None, ""),
        ("", ""),
        ("plain  text &amp; more", "plain text & more"),
        ("<p>one<p>two <b>bold<p>three", "one\n\ntwo bold\n\nthree"),
        ("<h1>T</h1><div>a</div><div>b<br>c</div>", "T\n\na\nb\nc"),
        ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>after", "- a\n- b\n  - c\n- d\n\nafter"),
        ("<ol start=3><li>x<li value=9>y<li>z</ol>", "3. x\n9. y\n10. z"),
        ("<ol reversed><li>x<li>y</ol>", "2. x\n1. y"),
        ("<table><tr><th>Name<th>N<tr><td>apple<td>10<tr><td>fig<td>2</table>", "Name  | N\napple | 10\nfig   | 2"),
        ("<table><tr><td colspan=2>wide cell here<td>z<tr><td>a<td>b<td>c</table>", "wide cell here | z\na | b          | c"),
        ("<table><tr><td rowspan=2>r<td>1<tr><td>2</table>", "r | 1\n  | 2"),
        ("<table><tr><td>a<br>b<td>c</table>", "a | c\nb |"),
        ("<pre>\n a  b\n  c</pre>", " a  b\n  c"),
        ("<head><title>T</title></head><script>var t='</p>';</script><style>x</style>see", "see"),
        ("a<!-- <p>no</p> -->b<span hidden>c</span><p style='color:red; display : none'>d</p>e", "abe"),
        ("<details><summary>s</summary>body</details><details open><summary>t</summary>u</details>", "s\nt\nu"),
        ("a<!-- open", "a"),
        ("a<b", "a"),
        ("a < b and <3", "a < b and <3"),
        ("<a title='x > y'>link</a>", "link"),
        ("<dl><dt>t<dd>d<dt>u<dd>e</dl>", "t\n  d\nu\n  e"),
        ("<p>a</p></div></p>b", "a\n\nb"),
        ("<select><option>x<option>y</select>", "x\ny"),
        ("a <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>tex</annotation></math> b <svg><title>t</title><path/><text>chart</text><g><text>la<tspan>bel</tspan></text></g></svg>c", "a x=2 b chart label c"),
        ("<svg><title>no</title></svg><table><tbody><form><tr><td>x</td></tr></form></tbody></table>", "x"),
        ("<table><tbody>loose<div>in a section</div><tr><td>x</td></tr><caption>cap</caption></table>", "loose\nin a section\ncap\nx"),
        ("<table><div><tbody><tr><td>a<td>b</tr></tbody></div><tr><td>c<td>d</table>", "a | b\nc | d"),
        ("word<wbr>s <i>in</i><b>line</b> <u>x</u>", "words inline x"),
    ],
)
def test_layout(html, text):
    assert render(html)[1] == text


def test_deep_and_long_pages():
    assert render("<div>" * 5000 + "x")[1] == "x"
    assert render("<p>word " * 5000)[1].count("word") == 5000
    assert render("<table><tr><td>" * 300 + "deep")[1].endswith("deep")
    assert render("<!DOCTYPE html><html><head><title> A \n B </title><body>x")[0] == "A B"


def test_wide_tables_lose_no_text_and_stay_small():
    page = "<table><tr><td>" + "w" * 200_000 + "<td>v</tr>" + "<tr><td>a<td>b</tr>" * 500 + "</table>"
    text = render(page)[1]
    assert len(text) < 4 * len(page) and text.count("a | b") == 500 and "w" * 200_000 + " | v" in text
    nested = page
    for _ in range(4):
        nested = "<table><tr><td>" + nested + "<td>z</tr>" + "<tr><td>c<td>d</tr>" * 300 + "</table>"
    text = render(nested)[1]
    assert len(text) < 4 * len(nested) and text.count("w") == 200_000 and text.count("z") == 4
    drawn = render("<table><tr><td>one<br>two<td>x" + "y" * 9000 + "<td>z</tr>" + "<tr><td>a<td>b<td>c</tr>" * 2000 + "</table>")[1]
    assert drawn.startswith("one\ntwo\nxyyy") and drawn.endswith("a | b | c")


class Plain(HTMLParser):
    def __init__(self):
        super().__init__()
        self.words, self.hidden = [], 0

    def handle_starttag(self, tag, attrs):
        self.hidden += tag in UNSEEN

    def handle_endtag(self, tag):
        self.hidden -= tag in UNSEEN

    def handle_data(self, data):
        if not self.hidden:
            self.words.append(data)


def test_all_visible_words(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    got = {r.page_id: r.text for r in digest(pages).collect()}
    assert len(got) == pages.count()
    for r in pages.collect():
        parser = Plain()
        parser.feed(r.html)
        parser.close()
        letters = lambda s: "".join(re.findall(r"\w", s))
        without_marks = re.sub(r"(?m)^\s*(- |\d+\. )", "", got[r.page_id])
        assert letters(without_marks) == letters("".join(parser.words))


def test_frame(spark):
    rows = [(1, "u", "<p>a", "x"), (1, "u", "<p>a", "x"), (None, None, None, "x"), (2, "v", "", None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    assert sorted((r.page_id or 0, r.text, r.title) for r in extract(df).collect()) == [(0, "", ""), (1, "a", ""), (1, "a", ""), (2, "", "")]
    assert digest(df.limit(0)).count() == 0
    assert [r._page for r in extract(df.withColumnRenamed("url", "_page").filter("page_id = 2")).collect()] == ["v"]


def test_huge_spans_and_deep_indents_cost_little():
    cell = '<td colspan=999 rowspan=999>x</td>'
    for html in (f"<table><tr>{cell * 8_000}</tr></table>", f"<table>{f'<tr>{cell * 100}</tr>' * 80}</table>", "<table>" + f"<tr>{cell}<td>y</td></tr>" * 3_000 + "</table>"):
        tracemalloc.start()
        begun = time.perf_counter()
        _, text, _, rows = render(html)
        took, most = time.perf_counter() - begun, tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert took < 60 and most < 200e6 + 100 * len(html) and len(text) <= 3 * len(html) + 4096
        assert text.count("x") == html.count(cell) and rows == html.count("<tr>")
    for html in ("<blockquote>" * 150 + "<br>".join(f"line{k}" for k in range(20_000)), "<ul><li>" * 100 + "<p>".join(f"line{k}" for k in range(20_000))):
        text = render(html)[1]
        assert len(text) <= 3 * len(html) + 4096 and [x.split()[-1] for x in text.split("\n") if "line" in x] == [f"line{k}" for k in range(20_000)]


def test_spans_take_the_columns_that_cells_start_in():
    html = "<table><tr><td colspan=3>all of it</td><td>r</td></tr><tr><td>a</td><td>b</td><td>c</td><td>s</td></tr><tr><td colspan=900>wide one</td></tr></table>"
    assert render(html)[1].split("\n") == ["all of it | r", "a | b | c | s", "wide one"]
    down = "<table><tr><td rowspan=2>d</td><td>x</td></tr><tr><td>y</td></tr><tr><td colspan=2>bottom row</td></tr></table>"
    assert render(down)[1].split("\n") == ["d | x", "  | y", "bottom row"]
