"""String, HTML and URL functions as native column expressions.

Patterns are literals, so each is compiled once an expression. ``(?U)`` makes ``\\s`` take NBSP, as the inputs need.
"""

from __future__ import annotations

from html import unescape as _unescape
from urllib.parse import urljoin as _urljoin

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..udf import arrow_udf

#: Entities that :func:`unescape_common` decodes; ampersand last, so that nothing is decoded twice.
COMMON_ENTITIES = (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&copy;", "©"), ("&middot;", "·"), ("&ndash;", "–"), ("&mdash;", "—"), ("&rsquo;", "’"), ("&amp;", "&"))


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank(c: Column) -> Column:
    """Null as the empty string."""
    return F.coalesce(c, F.lit(""))


def let(value: Column, use) -> Column:
    """use(value) with ``value`` worked out once for a row, however often ``use`` names it: inside lambdas Spark would repeat it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def strip(c: Column | str) -> Column:
    """Without white space of any kind at either end."""
    return F.regexp_replace(col(c), r"(?U)^\s+|\s+$", "")


def strip_chars(c: Column | str, chars: str) -> Column:
    """Without the characters of the class ``chars`` (as in a regular expression) at either end."""
    return F.regexp_replace(col(c), f"^[{chars}]+|[{chars}]+$", "")


def squash(c: Column | str) -> Column:
    """Runs of white space (NBSP too) as one space, none at the ends."""
    return F.trim(F.regexp_replace(col(c), r"(?U)\s+", " "))


@arrow_udf("string")
def unescape_html(texts: pd.Series) -> pd.Series:
    """All HTML entities decoded; Spark has no function for that."""
    return texts.map(lambda t: t if t is None or "&" not in t else _unescape(t))


def unescape_common(c: Column | str) -> Column:
    """The entities of COMMON_ENTITIES decoded, without leaving the JVM."""
    out = col(c)
    for entity, char in COMMON_ENTITIES:
        out = F.replace(out, F.lit(entity), F.lit(char))
    return out


def _without_tags(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(c, r"(?i)<br\s*/?>", "\n"), r"<[^>]+>", " ")


def _settled(c: Column) -> Column:
    return strip(F.regexp_replace(F.regexp_replace(c, r"[ \t]+", " "), r"(?U)\n\s+", "\n"))


def strip_html(c: Column | str, decode=unescape_html) -> Column:
    """Visible text of a fragment: ``<br>`` as line feed, tags as space, entities decoded, spaces collapsed, blank starts of
    lines gone. The content of scripts and styles stays (drop it with :func:`without_scripts` first where that matters)."""
    return _settled(decode(_without_tags(col(c))))


@arrow_udf("array<string>")
def _unescape_each(cells: pd.Series) -> pd.Series:
    return cells.map(lambda row: None if row is None else [t if t is None or "&" not in t else _unescape(t) for t in row])


def strip_html_each(cells: Column | str) -> Column:
    """:func:`strip_html` of every element of an array."""
    return F.transform(_unescape_each(F.transform(col(cells), _without_tags)), _settled)


def without_scripts(c: Column | str) -> Column:
    return F.regexp_replace(col(c), r"(?is)<(script|style|xml)\b.*?</\1\s*>", " ")


def html_lines(c: Column | str, decode=unescape_html) -> Column:
    """Non-empty lines of a page: scripts, styles, comments and Word's metadata dropped, source line feeds as spaces, block ends
    and ``<br>`` as line ends."""
    out = F.regexp_replace(without_scripts(c), r"(?s)<!--.*?-->|<!\[if.*?<!\[endif\]>", " ")
    out = F.regexp_replace(F.regexp_replace(out, r"[\r\n]+", " "), r"(?i)<br\s*/?>|</(p|div|tr|li|h[1-6]|table|center|title)\s*>", "\n")
    out = decode(F.regexp_replace(out, r"<[^>]+>", " "))
    return F.filter(F.transform(F.split(out, "\n"), squash), lambda x: x != "")


def plain_punctuation(c: Column | str) -> Column:
    """Dashes, quotes, the ʻokina and NBSP as their ASCII forms; white space collapsed."""
    return squash(F.translate(col(c), "–—‑−‘’ʻʼ“” ", "----''''\"\" "))


def slug(c: Column | str, most: int = 80, empty: str = "UNKNOWN") -> Column:
    """Upper-case letters and digits with single underscores, at most ``most`` long."""
    out = F.substring(F.regexp_replace(F.regexp_replace(F.upper(col(c)), r"[^A-Z0-9]+", "_"), r"^_+|_+$", ""), 1, most)
    return F.when(blank(out) == "", F.lit(empty)).otherwise(out)


def key_part(c: Column | str) -> Column:
    """Upper-case letters and digits with single hyphens."""
    return F.regexp_replace(F.regexp_replace(F.upper(col(c)), r"[^A-Z0-9]+", "-"), r"^-+|-+$", "")


def header_key(c: Column | str) -> Column:
    """Lower-case letters and digits alone."""
    return F.regexp_replace(F.lower(col(c)), r"[^a-z0-9]+", "")


def title_case(c: Column | str) -> Column:
    """The first letter behind anything that is no letter in upper case, all others in lower case (unlike initcap)."""
    words = F.split(F.lower(col(c)), r"(?<=\P{L})(?=\p{L})")
    return F.array_join(F.transform(words, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substring(w, 2, 1_000_000))), "")


def strip_unbalanced(c: Column | str) -> Column:
    """A closing parenthesis that nothing opened becomes a space."""
    start = F.struct(F.lit(0).alias("open"), F.lit("").alias("out"))

    def step(state: Column, char: Column) -> Column:
        stray = (char == ")") & (state["open"] == 0)
        opened = state["open"] + F.when(char == "(", 1).when((char == ")") & ~stray, -1).otherwise(0)
        return F.struct(opened.alias("open"), F.concat(state["out"], F.when(stray, F.lit(" ")).otherwise(char)).alias("out"))

    text = col(c)
    return F.when(~F.contains(text, F.lit(")")), text).otherwise(F.aggregate(F.split(text, ""), start, step, lambda s: s["out"]))


def before_unbalanced(c: Column | str) -> Column:
    """The text before the first closing parenthesis that nothing opened."""
    depth = F.aggregate(
        F.split(col(c), ""),
        F.struct(F.lit(0).alias("open"), F.lit("").alias("out"), F.lit(False).alias("done")),
        lambda s, x: F.struct(
            (s["open"] + F.when(x == "(", 1).when(x == ")", -1).otherwise(0)).alias("open"),
            F.when(s["done"] | ((x == ")") & (s["open"] <= 0)), s["out"]).otherwise(F.concat(s["out"], x)).alias("out"),
            (s["done"] | ((x == ")") & (s["open"] <= 0))).alias("done"),
        ),
        lambda s: s["out"],
    )
    return F.rtrim(depth)


#: Procedural words that may trail a party's name. Fixed values.
_ROLE_TAIL = r"(?i)[\s,;.]*\b(?:charging\s+part(?:y|ies)|petitioners?|respondents?|intervenors?|complainants?|appellants?|appellees?|plaintiffs?|defendants?|agency|employer|labor\s+organization|incumbent)\s*[,.;:]?\s*$"
_VERSUS_TAIL = r"(?i)[\s,]+(?:v|vs)\.?\s*$"
_CASE_TAIL = r"(?i)\s*\bcase\s+no\.?\s*[:#]?\s*\S*\s*$"


def clean_party(c: Column | str, decode=unescape_html) -> Column:
    """A party's name without what a caption wraps around it: entities (even double-escaped), the ``)`` column, a trailing
    case number, versus or procedural word (three rounds), and a leading article."""
    out = F.translate(decode(decode(blank(col(c)))), " ", " ")
    out = squash(strip_unbalanced(F.regexp_replace(out, "(?i)&nbsp;?", " ")))
    for _ in range(3):
        for pattern in (_CASE_TAIL, _VERSUS_TAIL, _ROLE_TAIL):
            out = F.regexp_replace(out, pattern, "")
        out = strip_chars(out, r" ,;:\-–—")
    return F.trim(F.regexp_replace(out, r"^(?i:the)\s+(?=[A-Za-z])", ""))


def cells(c: Column | str) -> Column:
    """Cells of a fixed-width line: what stands between runs of two or more spaces."""
    return F.split(F.trim(col(c)), r"\s{2,}")


def trailing_parenthesis(c: Column | str) -> Column:
    """struct(head, inner): "Union (unit)" as its two parts; no parenthesis at the end gives an empty inner."""
    text = F.trim(col(c))
    found = text.rlike(r"\([^()]*\)\s*$")
    head = F.when(found, F.trim(F.regexp_replace(text, r"\s*\([^()]*\)\s*$", ""))).otherwise(text)
    return F.struct(head.alias("head"), F.when(found, F.trim(F.regexp_extract(text, r"\(([^()]*)\)\s*$", 1))).otherwise(F.lit("")).alias("inner"))


def split_first(c: Column | str, separators: tuple[str, ...]) -> Column:
    """struct(head, tail) at the first of ``separators``, tried in order, that occurs; an empty tail if none does."""
    text = blank(col(c))
    head, tail = text, F.lit("")
    for s in reversed(separators):
        held = F.contains(text, F.lit(s))
        head = F.when(held, F.trim(F.substring_index(text, s, 1))).otherwise(head)
        tail = F.when(held, F.trim(F.expr("''") if not s else F.array_join(F.slice(F.split(text, "\\Q" + s + "\\E"), 2, 1_000), s))).otherwise(tail)
    return F.struct(F.trim(head).alias("head"), tail.alias("tail"))


def count_prefix(c: Column | str) -> Column:
    """struct(count, rest) of "335-Mechanics"; an empty count where there is none."""
    text = blank(col(c))
    pattern = r"^\s*(\d[\d,]*)\s*[-–—]\s*(.*)$"
    found = text.rlike(pattern)
    return F.struct(
        F.when(found, F.replace(F.regexp_extract(text, pattern, 1), F.lit(","))).otherwise(F.lit("")).alias("count"),
        F.when(found, F.trim(F.regexp_extract(text, pattern, 2))).otherwise(F.trim(text)).alias("rest"),
    )


def approximate_count(c: Column | str) -> Column:
    """struct(count, rest): "(approx. 1,200 employees)" taken out of the text."""
    text = blank(col(c))
    pattern = r"(?i)\(?\s*(?:approx(?:imately|\.)?\s*)([\d,]+)\s*(?:employees|members)?\s*\)?\.?"
    found = text.rlike(pattern)
    return F.struct(
        F.when(found, F.replace(F.regexp_extract(text, pattern, 1), F.lit(","))).otherwise(F.lit("")).alias("count"),
        squash(F.when(found, F.regexp_replace(text, pattern, " ")).otherwise(text)).alias("rest"),
    )


def file_name(c: Column | str) -> Column:
    """Last part of a path or URL, without query and fragment, percent-decoded."""
    return F.try_url_decode(F.replace(F.substring_index(F.regexp_replace(col(c), r"[?#].*$", ""), "/", -1), F.lit("+"), F.lit("%2B")))


def file_stem(c: Column | str) -> Column:
    return F.regexp_replace(file_name(c), r"\.[^.]+$", "")


@arrow_udf("string")
def _joined(base: pd.Series, href: pd.Series) -> pd.Series:
    return pd.Series([None if h is None else _urljoin(b or "", h) for b, h in zip(base, href, strict=True)], dtype="object")


def absolute_url(base: Column | str, href: Column | str) -> Column:
    """``href`` against ``base``: absolute, scheme-relative, rooted and plain relative forms are native; only a reference with
    dot segments takes the general way."""
    b, h = col(base), F.trim(col(href))
    site = F.regexp_extract(b, r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)", 1)
    folder = F.regexp_replace(F.regexp_replace(b, r"[?#].*$", ""), r"(?<=[^/:]/)[^/]*$|(?<![:/])$(?<=//[^/]{1,300})", "")
    folder = F.when(folder == site, F.concat(site, F.lit("/"))).otherwise(F.regexp_replace(folder, r"(?<!:/)(?<=/)[^/]+$", ""))
    return (
        F.when(h.rlike(r"^[a-zA-Z][a-zA-Z0-9+.-]*:"), h)
        .when(h.startswith("//"), F.concat(F.regexp_extract(b, r"^([a-zA-Z][a-zA-Z0-9+.-]*:)", 1), h))
        .when(h.startswith("/") & ~h.rlike(r"/\.\.?(/|$)"), F.concat(site, h))
        .when(h.rlike(r"^[^./?#][^?#]*$") & ~h.rlike(r"/\.\.?(/|$)") & ~h.startswith("."), F.concat(folder, h))
        .otherwise(_joined(b, h))
    )


def query_value(c: Column | str, name: str) -> Column:
    """A parameter of a URL's query, decoded; empty if there is none."""
    return blank(F.try_url_decode(F.regexp_extract(col(c), rf"(?i)[?&]{name}=([^&#]*)", 1)))


def labelled_paragraph(c: Column | str, label: str, decode=unescape_html) -> Column:
    """What follows ``<strong>label:</strong>`` up to the paragraph's end, as text."""
    return squash(strip_html(F.regexp_extract(col(c), rf"(?is)<strong>\s*{label}\s*:?\s*</strong>\s*:?(.*?)</p>", 1), decode))


def capped(c: Column | str, most: int) -> Column:
    return F.substring(col(c), 1, most)


def capped_at_word(c: Column | str, most: int) -> Column:
    """At most ``most`` characters, ending with a whole word if something was cut."""
    text = col(c)
    short = F.substring(text, 1, most)
    return F.when(F.length(text) <= most, text).otherwise(F.when(F.contains(short, F.lit(" ")), F.regexp_replace(short, r"\s+\S*$", "")).otherwise(short))


def roster_entries(c: Column | str) -> Column:
    """A comma-separated roster; commas inside parentheses and before a state's two letters don't separate."""
    return F.filter(F.transform(F.split(col(c), r",(?![^()]*\))(?!\s*[A-Z]{2}\b)"), lambda x: F.trim(x)), lambda x: x != "")


def spans(c: Column | str, pattern: str) -> Column:
    """All matches of ``pattern`` with their places, as array(struct(start, raw)); ``pattern`` must not match nothing.

    Spark tells all matches or the first place; the places of all follow from the lengths of what lies between them.
    """
    text = blank(col(c))
    none = F.expr("cast(array() as array<struct<start:int,raw:string>>)")
    found = F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("raw"), F.split(text, pattern, -1).alias("between"))

    def placed(held: Column) -> Column:
        def step(state: Column, i: Column) -> Column:
            start = state["at"] + F.length(F.get(held["between"], i))
            word = F.get(held["raw"], i)
            return F.struct((start + F.length(word)).alias("at"), F.concat(state["out"], F.array(F.struct(start.alias("start"), word.alias("raw")))).alias("out"))

        start = F.struct(F.lit(0).alias("at"), none.alias("out"))
        return F.when(F.size(held["raw"]) == 0, none).otherwise(F.aggregate(F.sequence(F.lit(0), F.size(held["raw"]) - 1), start, step, lambda s: s["out"]))

    return F.when(text.rlike(pattern), let(found, placed)).otherwise(none)
