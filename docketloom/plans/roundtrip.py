"""Queries over the star-schema tables that exercise the operators by round trip: text is made from known columns, parsed back,
and SQL states the known columns. Each entry is a callable (spark, sf_dir) and, under the same name, DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates, roles, text
from ..operators import carry, keys, quality, rules
from ..sources import tables

AS_OF = "2026-09-30"
QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- pages: links, titles, text ----------------------------------------------------------------------------------------

_LINKS = r"""
WITH a AS (SELECT page_id, url, html, unnest(regexp_extract_all(html, '(?is)<a\b[^>]*?\bhref\s*=\s*["'']([^"'']*)["''][^>]*>(.*?)</a>')) AS a,
  generate_subscripts(regexp_extract_all(html, '(?is)<a\b[^>]*?\bhref\s*=\s*["'']([^"'']*)["''][^>]*>(.*?)</a>'), 1) - 1 AS pos FROM pages),
l AS (SELECT page_id, pos, regexp_extract(a, 'href\s*=\s*["'']([^"'']*)["'']', 1) AS href,
  trim(regexp_replace(regexp_replace(regexp_extract(a, '(?is)>(.*)</a>$', 1), '<[^>]+>', ' ', 'g'), '\s+', ' ', 'g')) AS label FROM a)
"""


@query(_LINKS + "SELECT page_id, CAST(pos AS INT) AS pos, href, label, 'PAGES:' || page_id || ':' || pos AS row_key FROM l WHERE label <> ''")
def page_link_index(spark, sf_dir):
    """Links of every page with a key (anchor index)."""
    found = tables.link_rows(read(spark, sf_dir, "pages").select("page_id", "html"), decode=text.unescape_common)
    return found.filter("label <> ''").select("page_id", "pos", "href", "label", keys.row_key(F.lit("PAGES"), F.col("page_id").cast("string"), F.col("pos").cast("string")).alias("row_key"))


@query(_LINKS + "SELECT lower(href) AS link, min(page_id) AS page_id, count(DISTINCT page_id) AS n_pages FROM l WHERE href <> '' GROUP BY 1")
def distinct_links(spark, sf_dir):
    """First-wins by lower-cased link, with the number of pages that hold it."""
    found = tables.link_rows(read(spark, sf_dir, "pages").select("page_id", "html"), decode=text.unescape_common).filter("href <> ''")
    return found.groupBy(F.lower("href").alias("link")).agg(F.min("page_id").alias("page_id"), F.count_distinct("page_id").alias("n_pages"))


@query(r"""SELECT page_id, trim(regexp_replace(replace(replace(replace(replace(regexp_extract(html, '(?is)<title\b[^>]*>(.*?)</title>', 1), '&quot;', '"'), '&copy;', '©'), '&middot;', '·'), '&amp;', '&'), '\s+', ' ', 'g')) AS title FROM pages""")
def page_title(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", tables.title("html", text.unescape_common).alias("title"))


@query(r"""
SELECT page_id, trim(regexp_replace(regexp_replace(replace(replace(replace(replace(regexp_replace(regexp_replace(
  regexp_replace(regexp_replace(html, '(?is)<script\b.*?</script\s*>', ' ', 'g'), '(?is)<style\b.*?</style\s*>', ' ', 'g'), '(?i)<br\s*/?>', chr(10), 'g'), '<[^>]+>', ' ', 'g'),
  '&quot;', '"'), '&copy;', '©'), '&middot;', '·'), '&amp;', '&'), '[ \t]+', ' ', 'g'), '\n\s+', chr(10), 'g')) AS text FROM pages""")
def html_strip(spark, sf_dir):
    """Visible text of pages without scripts and styles."""
    return read(spark, sf_dir, "pages").select("page_id", text.strip_html(text.without_scripts("html"), text.unescape_common).alias("text"))


@query(r"""SELECT page_id, url, regexp_extract(url, '^[a-z]+://[^/]*', 0) || '/files/' || page_id || '.pdf' AS rooted,
  'https://other.example/x' AS absolute, regexp_extract(url, '^([a-z]+:)', 1) || '//cdn.example/y' AS scheme_relative FROM pages""")
def url_join(spark, sf_dir):
    p = read(spark, sf_dir, "pages")
    return p.select("page_id", "url", text.absolute_url(F.col("url"), F.concat(F.lit("/files/"), F.col("page_id").cast("string"), F.lit(".pdf"))).alias("rooted"), text.absolute_url(F.col("url"), F.lit("https://other.example/x")).alias("absolute"), text.absolute_url(F.col("url"), F.lit("//cdn.example/y")).alias("scheme_relative"))


# --- captions and roles ------------------------------------------------------------------------------------------------


def captions(spark, sf_dir) -> DataFrame:
    """A caption for each supplier: its nation's city against a local, sides swapped on odd keys."""
    s, n = read(spark, sf_dir, "supplier"), read(spark, sf_dir, "nation")
    made = s.join(n, s.s_nationkey == n.n_nationkey)
    city, local = F.concat(F.lit("City of "), F.col("n_name")), F.concat(F.lit("Teamsters Local "), F.col("s_suppkey").cast("string"))
    odd = F.col("s_suppkey") % 2 == 1
    return made.select("s_suppkey", F.when(odd, local).otherwise(city).alias("left"), F.when(odd, city).otherwise(local).alias("right")).withColumn("case_name", F.concat_ws(" v. ", "left", "right"))


_NAMES = "SELECT s_suppkey, 'City of ' || n_name AS employer_name, 'Teamsters Local ' || s_suppkey AS union_name FROM supplier JOIN nation ON s_nationkey = n_nationkey"


@query(_NAMES)
def caption_roles(spark, sf_dir):
    """Roles of two sides by content, in either order."""
    return captions(spark, sf_dir).withColumn("r", roles.assign_roles("left", "right")).select("s_suppkey", F.col("r.employer").alias("employer_name"), F.col("r.union").alias("union_name"))


@query(_NAMES)
def case_name_roles(spark, sf_dir):
    """Roles of whole case names."""
    return captions(spark, sf_dir).withColumn("r", roles.caption_roles("case_name")).select("s_suppkey", F.col("r.employer").alias("employer_name"), F.col("r.union").alias("union_name"))


@query("SELECT c_custkey, 'City of ' || n_name AS publics, 'AFSCME Local ' || c_custkey AS unions FROM customer JOIN nation ON c_nationkey = n_nationkey")
def compound_sides(spark, sf_dir):
    """A side that names both parties is split only as proven."""
    c, n = read(spark, sf_dir, "customer"), read(spark, sf_dir, "nation")
    made = c.join(n, c.c_nationkey == n.n_nationkey).withColumn("side", F.concat(F.lit("City of "), "n_name", F.lit(" and AFSCME Local "), F.col("c_custkey").cast("string")))
    return made.withColumn("s", roles.split_side("side")).select("c_custkey", F.array_join("s.publics", "; ").alias("publics"), F.array_join("s.unions", "; ").alias("unions"))


@query("""SELECT c_custkey, c_mktsegment, c_custkey % 3 = 0 AS union_body, c_custkey % 3 = 1 AS public_body, c_custkey % 3 = 2 AS person FROM customer""")
def party_predicates(spark, sf_dir):
    """Native tests on names: a union, a public employer, a person."""
    c = read(spark, sf_dir, "customer")
    name = F.when(F.col("c_custkey") % 3 == 0, F.concat(F.initcap("c_mktsegment"), F.lit(" Employees Association"))).when(F.col("c_custkey") % 3 == 1, F.concat(F.initcap("c_mktsegment"), F.lit(" Township"))).otherwise(F.lit("Jane Q. Doe"))
    return c.withColumn("name", name).select("c_custkey", "c_mktsegment", roles.is_union("name").alias("union_body"), roles.is_public_employer("name").alias("public_body"), roles.is_personal_name("name").alias("person"))


# --- dates -------------------------------------------------------------------------------------------------------------


def order_texts(spark, sf_dir) -> DataFrame:
    day = F.col("o_orderdate")
    body = F.concat(F.lit("Filed January 5, 1999 (see Order of March 3, 2001). IT IS SO ORDERED. DATE: "), F.date_format(day, "MMMM d, yyyy"), F.lit(". Copies mailed "), F.date_format(day, "M/d/yyyy"))
    return read(spark, sf_dir, "orders").select("o_orderkey", body.alias("body"))


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS issued, 'day' AS precision FROM orders")
def order_dates(spark, sf_dir):
    """The first date behind the last anchor, past decoys."""
    hit = dates.date_after("body", (r"IT IS SO ORDERED", r"BY ORDER OF"), AS_OF)
    return order_texts(spark, sf_dir).select("o_orderkey", hit.alias("h")).select("o_orderkey", F.col("h.iso").alias("issued"), "h.precision")


@query("SELECT o_orderkey, '1999-01-05;2001-03-03;' || strftime(o_orderdate, '%Y-%m-%d;%Y-%m-%d') AS found, CAST(6 AS INT) AS first_start FROM orders")
def all_dates(spark, sf_dir):
    """Every date of a text in order, with places."""
    found = order_texts(spark, sf_dir).select("o_orderkey", dates.find_dates("body", AS_OF).alias("d"))
    return found.select("o_orderkey", F.array_join(F.transform("d", lambda h: h["iso"]), ";").alias("found"), F.col("d")[0]["start"].alias("first_start"))


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS slash, strftime(o_orderdate, '%Y-%m-%d') AS stamp, strftime(o_orderdate, '%Y-%m-%d') AS compact, CAST(year(o_orderdate) AS VARCHAR) AS year_only, strftime(o_orderdate, '%Y-%m-01') AS as_of FROM orders")
def date_forms(spark, sf_dir):
    day = F.col("o_orderdate")
    o = read(spark, sf_dir, "orders")
    return o.select("o_orderkey", dates.iso(dates.slash_date(F.date_format(day, "M/d/yy"), 80)).alias("slash"), dates.iso(dates.month_stamp(F.date_format(day, "MMM d yyyy"))).alias("stamp"), dates.compact_date(F.date_format(day, "yyyyMMdd")).alias("compact"), dates.year_only(F.date_format(day, "yyyy"), AS_OF)["iso"].alias("year_only"), dates.month_as_of(F.concat(F.lit("as of "), F.date_format(day, "MMMM yyyy"))).alias("as_of"))


# --- codes, numbers, strings -------------------------------------------------------------------------------------------


@query("""SELECT o_orderkey, 'PF-' || left(o_orderpriority, 1) || '-' || strftime(o_orderdate, '%y') || '-' || o_orderkey || '-W' AS docket,
  CASE left(o_orderpriority, 1) WHEN '1' THEN 'ULP' WHEN '2' THEN 'CERTIFICATION' WHEN '3' THEN 'DECERTIFICATION' ELSE left(o_orderpriority, 1) END AS canonical_case_type,
  strftime(o_orderdate, '%y') AS docket_year FROM orders""")
def docket_parse(spark, sf_dir):
    """A docket number out of prose, its type mapped; unknown codes pass through."""
    o = read(spark, sf_dir, "orders")
    prose = F.concat(F.lit("Re: Case No. pf-"), F.substring("o_orderpriority", 1, 1), F.lit("-"), F.date_format("o_orderdate", "yy"), F.lit("-"), F.col("o_orderkey").cast("string"), F.lit("-w, filed today"))
    pattern = r"(?i)\b(PF-([0-9A-Z])-(\d{2})-\d+-[A-Z])\b"
    part = lambda k: F.upper(F.regexp_extract("prose", pattern, k))
    return o.withColumn("prose", prose).select("o_orderkey", part(1).alias("docket"), rules.canonical_case_type(part(2), {"1": "ULP", "2": "CERTIFICATION", "3": "DECERTIFICATION"}).alias("canonical_case_type"), part(3).alias("docket_year"))


@query("""SELECT event_type, CASE WHEN event_type LIKE '%c%' THEN 'HAS_C' WHEN event_type LIKE '%e%' THEN 'HAS_E' ELSE 'OTHER' END AS label, count(*) AS n FROM events GROUP BY ALL""")
def first_matching_rule(spark, sf_dir):
    """Ordered rules: the first that matches decides."""
    e = read(spark, sf_dir, "events")
    return e.withColumn("label", rules.first_match("event_type", [("c", "HAS_C"), ("e", "HAS_E")], "OTHER")).groupBy("event_type", "label").agg(F.count("*").alias("n"))


@query("""SELECT p_partkey, trim(regexp_replace(upper(p_name), '[^A-Z0-9]+', '_', 'g'), '_') AS slug, trim(regexp_replace(upper(p_type), '[^A-Z0-9]+', '-', 'g'), '-') AS key_part,
  regexp_replace(lower(p_brand), '[^a-z0-9]+', '', 'g') AS header_key, left(p_name, 6) AS short FROM part""")
def key_forms(spark, sf_dir):
    p = read(spark, sf_dir, "part")
    return p.select("p_partkey", text.slug("p_name").alias("slug"), text.key_part("p_type").alias("key_part"), text.header_key("p_brand").alias("header_key"), text.capped("p_name", 6).alias("short"))


@query("SELECT p_partkey, CAST(p_size AS VARCHAR) AS n, p_type AS craft, p_brand AS org, p_name AS unit FROM part")
def cell_splits(spark, sf_dir):
    """Count prefixes, organisation / craft, trailing parentheses."""
    p = read(spark, sf_dir, "part")
    size = F.col("p_size").cast("string")
    made = p.select("p_partkey", text.count_prefix(F.concat(size, F.lit("-"), "p_type")).alias("c"), text.split_first(F.concat("p_brand", F.lit(" / "), "p_type"), (" / ", "/", " - ")).alias("o"), text.trailing_parenthesis(F.concat("p_brand", F.lit(" ("), "p_name", F.lit(")"))).alias("t"))
    return made.select("p_partkey", F.col("c.count").alias("n"), F.col("o.tail").alias("craft"), F.col("t.head").alias("org"), F.col("t.inner").alias("unit"))


@query("SELECT s_suppkey, 'City of ' || n_name AS party FROM supplier JOIN nation ON s_nationkey = n_nationkey")
def clean_parties(spark, sf_dir):
    """Captions' typography off a name."""
    s, n = read(spark, sf_dir, "supplier"), read(spark, sf_dir, "nation")
    raw = F.concat(F.lit("The  City of&nbsp;"), "n_name", F.lit(" ), Petitioner, v."))
    return s.join(n, s.s_nationkey == n.n_nationkey).select("s_suppkey", text.clean_party(raw, text.unescape_common).alias("party"))


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def json_props(spark, sf_dir):
    payloads = read(spark, sf_dir, "events").select("event_id", F.concat(F.lit("["), "props", F.lit("]")).alias("payload"))
    return tables.json_records(payloads, "k bigint").select("event_id", "k")


@query("""SELECT o_orderkey, 'A-' || lpad(CAST(n AS VARCHAR), 5, '0') AS case_number FROM (
  SELECT o_orderkey, unnest(generate_series(first, CASE WHEN first % 100 + o_orderkey % 3 < 100 THEN first + o_orderkey % 3 ELSE first END)) AS n
  FROM (SELECT o_orderkey, 10000 + o_orderkey % 80000 AS first FROM orders))""")
def case_ranges(spark, sf_dir):
    """A-12897-99 is three cases; a second number that is smaller (A-12899-01) is no range."""
    from .weekly import case_numbers

    o = read(spark, sf_dir, "orders").withColumn("first", F.lit(10000) + F.col("o_orderkey") % 80000)
    last = F.lpad(((F.col("first") + F.col("o_orderkey") % 3) % 100).cast("string"), 2, "0")
    cell = F.concat(F.lit("A-"), F.col("first").cast("string"), F.when(F.col("o_orderkey") % 3 == 0, F.lit("")).otherwise(F.concat(F.lit("-"), last)))
    return o.select("o_orderkey", F.explode(case_numbers(cell)).alias("c")).select("o_orderkey", F.col("c.case_number"))


# --- order-dependent operators -----------------------------------------------------------------------------------------


@query("SELECT l_orderkey, l_linenumber, CAST(l_orderkey AS VARCHAR) AS case_cell, l_partkey FROM lineitem")
def continuation_rows(spark, sf_dir):
    """Rows below the first take the case above, inside their table."""
    li = read(spark, sf_dir, "lineitem")
    first = F.min("l_linenumber").over(carry.Window.partitionBy("l_orderkey").orderBy("l_linenumber"))  # the order of the fill, so one sort serves both
    shown = li.select("l_orderkey", "l_linenumber", "l_partkey", F.when(F.col("l_linenumber") == first, F.col("l_orderkey").cast("string")).otherwise(F.lit(" ")).alias("case_cell"), (F.col("l_linenumber") == first).alias("reset"))
    return carry.fill_continuations(shown, ["case_cell"], F.col("reset"), ["l_orderkey"], "l_linenumber").select("l_orderkey", "l_linenumber", "case_cell", "l_partkey")


def outline(spark, sf_dir) -> DataFrame:
    """Lines region, then its nations, then their suppliers."""
    r, n, s = (read(spark, sf_dir, t) for t in ("region", "nation", "supplier"))
    key = lambda a, b, c: F.struct(a.alias("a"), b.alias("b"), c.alias("c"))
    low = F.lit(-1).cast("long")
    lines = r.select(F.concat(F.lit("SECTION "), "r_name").alias("line"), key(F.col("r_regionkey").cast("long"), low, low).alias("pos"))
    lines = lines.union(n.select(F.concat(F.lit("1. City of "), "n_name"), key(F.col("n_regionkey").cast("long"), F.col("n_nationkey").cast("long"), low)))
    ns = s.join(n, s.s_nationkey == n.n_nationkey)
    return lines.union(ns.select(F.concat(F.lit("a. "), "s_name", F.lit(" (approx. 1,250 employees)")), key(F.col("n_regionkey").cast("long"), F.col("n_nationkey").cast("long"), F.col("s_suppkey")))).withColumn("doc", F.col("pos.a"))


@query("SELECT r_name AS section, 'City of ' || n_name AS employer, s_name AS unit, '1250' AS n FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey")
def outline_ffill(spark, sf_dir):
    """Outline lines: section and employer carried to each unit."""
    lines = outline(spark, sf_dir)
    section, employer = F.regexp_extract("line", r"^SECTION (.*)$", 1), F.regexp_extract("line", r"^\d+\. (.*)$", 1)
    filled = carry.carry_forward(lines, {"section": F.nullif(section, F.lit("")), "employer": F.nullif(employer, F.lit(""))}, ["doc"])
    units = filled.filter(F.col("line").rlike(r"^[a-z]\. ")).withColumn("u", text.approximate_count(F.regexp_replace("line", r"^[a-z]\. ", "")))
    return units.select("section", "employer", F.col("u.rest").alias("unit"), F.col("u.count").alias("n"))


@query("""WITH x AS (SELECT *, lag(l_returnflag) OVER w AS prev FROM lineitem WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice)),
y AS (SELECT *, sum(CASE WHEN prev IS NULL OR prev <> l_returnflag THEN 1 ELSE 0 END) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS island FROM x)
SELECT l_orderkey, CAST(island AS INT) AS island, l_returnflag, count(*) AS n FROM y GROUP BY ALL""")
def section_islands(spark, sf_dir):
    """Runs of one flag inside an order."""
    li = read(spark, sf_dir, "lineitem").withColumn("pos", F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"))
    before = F.lag("l_returnflag").over(carry.Window.partitionBy("l_orderkey").orderBy("pos"))
    marked = li.withColumn("edge", before.isNull() | (before != F.col("l_returnflag")))
    return carry.islands(marked, F.col("edge"), ["l_orderkey"]).groupBy("l_orderkey", "island", "l_returnflag").agg(F.count("*").alias("n"))


@query("SELECT l_orderkey, l_linenumber, coalesce(lead(l_linenumber) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber), 99) AS stop FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)")
def section_ends(spark, sf_dir):
    lines = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber").distinct()
    return carry.until_next(lines, "l_linenumber", F.lit(99), ["l_orderkey"])


@query("SELECT l_orderkey, min(l_linenumber) FILTER (l_returnflag = 'R') AS next_r, count(*) AS n FROM lineitem GROUP BY 1 HAVING count(*) FILTER (l_returnflag = 'R') > 0")
def name_below(spark, sf_dir):
    """As-of forward: from a document's first line, the next marked one."""
    li = read(spark, sf_dir, "lineitem")
    found = carry.carry_backward(li, {"next_r": F.when(F.col("l_returnflag") == "R", F.col("l_linenumber"))}, ["l_orderkey"], "l_linenumber")
    return found.groupBy("l_orderkey").agg(F.min("next_r").alias("next_r"), F.count("*").alias("n")).filter("next_r is not null")


@query("SELECT unnest(generate_series(1, (SELECT max(o_orderkey) FROM orders WHERE o_orderkey % 7 <> 3))) AS o_orderkey EXCEPT SELECT o_orderkey FROM orders WHERE o_orderkey % 7 <> 3")
def gap_fill(spark, sf_dir):
    """Integers below the greatest that no row has."""
    return carry.missing_numbers(read(spark, sf_dir, "orders").filter("o_orderkey % 7 <> 3"), "o_orderkey")


# --- keys, merges, counts ----------------------------------------------------------------------------------------------


@query("SELECT c_mktsegment, c_nationkey, c_custkey, c_name FROM (SELECT *, row_number() OVER (PARTITION BY c_mktsegment, c_nationkey ORDER BY c_custkey) AS n FROM customer) WHERE n = 1")
def first_wins(spark, sf_dir):
    c = read(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_nationkey", "c_name")
    return keys.first_wins(c, ["c_mktsegment", "c_nationkey"], ["c_custkey"]).select("c_mktsegment", "c_nationkey", "c_custkey", "c_name")


@query("SELECT c_nationkey, coalesce(min(c_custkey) FILTER (c_custkey % 4 = 1), min(c_custkey)) AS c_custkey FROM customer GROUP BY 1")
def best_row_merge(spark, sf_dir):
    """A row that fills the preferred column takes the place of one that doesn't."""
    c = read(spark, sf_dir, "customer").select("c_nationkey", "c_custkey", F.when(F.col("c_custkey") % 4 == 1, F.col("c_name")).otherwise(F.lit("")).alias("employer"), F.lit("").alias("pdf"))
    return keys.prefer_filled(c, "c_nationkey", "c_custkey", "employer", "pdf").select("c_nationkey", "c_custkey")


@query("""WITH b AS (SELECT *, 'LI:' || l_returnflag || ':' || repeat(l_linestatus, 130) || l_suppkey AS base FROM lineitem),
k AS (SELECT *, CASE WHEN length(base) > 124 THEN left(base, 112) || ':H' || left(sha1(base), 10) ELSE base END AS key FROM b),
n AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY l_orderkey, l_linenumber, l_partkey, l_extendedprice) AS n FROM k)
SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice, CASE WHEN n = 1 THEN key ELSE key || ':' || n END AS row_key FROM n""")
def ordinal_keys(spark, sf_dir):
    """Keys capped by a digest, repeats numbered."""
    li = read(spark, sf_dir, "lineitem")
    base = keys.capped_key(keys.row_key(F.lit("LI"), "l_returnflag", F.concat(F.repeat("l_linestatus", 130), F.col("l_suppkey").cast("string"))))
    made = keys.with_ordinals(li.withColumn("base", base), "base", ["l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"])
    return made.select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "row_key")


@query("SELECT min(doc_id) AS doc_id, count(*) AS n FROM documents GROUP BY text")
def report_dedup(spark, sf_dir):
    """Documents of equal lines by content signature; the first stays."""
    d = read(spark, sf_dir, "documents").withColumn("sha", F.sha2("text", 256))
    return d.groupBy("sha").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("n")).select("doc_id", "n")


@query("SELECT min(l_orderkey) AS first_order, count(*) AS n_orders FROM (SELECT l_orderkey, string_agg(l_returnflag || '|' || l_linestatus, ',' ORDER BY l_returnflag || '|' || l_linestatus) AS sig FROM lineitem GROUP BY 1) GROUP BY sig")
def group_signatures(spark, sf_dir):
    """Orders whose lines are the same multiset."""
    sig = read(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(keys.content_signature("l_returnflag", "l_linestatus").alias("sig"))
    return sig.groupBy("sig").agg(F.min("l_orderkey").alias("first_order"), F.count("*").alias("n_orders")).select("first_order", "n_orders")


def _replayed(spark, sf_dir) -> DataFrame:
    c = captions(spark, sf_dir).withColumn("r", roles.assign_roles("left", "right")).select("s_suppkey", F.col("r.employer").alias("employer_name"), F.col("r.union").alias("union_name"))
    k = F.col("s_suppkey") % 5
    old = c.withColumns({"employer_name": F.when(k == 0, "").when(k == 1, "Other").otherwise(F.col("employer_name")), "union_name": F.when(k == 2, F.lit("")).otherwise(F.col("union_name"))})
    new = c.withColumn("union_name", F.when(k == 3, F.lit("")).otherwise(F.col("union_name")))
    return quality.replay(old, new, "s_suppkey", ["employer_name", "union_name"])


@query("""SELECT 'employer_name' AS side, CASE s_suppkey % 5 WHEN 0 THEN 'filled' WHEN 1 THEN 'changed' ELSE 'same' END AS bucket, count(*) AS n FROM supplier GROUP BY ALL
UNION ALL SELECT 'union_name', CASE s_suppkey % 5 WHEN 2 THEN 'filled' WHEN 3 THEN 'emptied' ELSE 'same' END, count(*) FROM supplier GROUP BY ALL""")
def replay_counts(spark, sf_dir):
    return quality.replay_counts(_replayed(spark, sf_dir), ["employer_name", "union_name"])


@query("SELECT s_suppkey FROM supplier WHERE s_suppkey % 5 <> 4")
def replay_diff(spark, sf_dir):
    return quality.changed_rows(_replayed(spark, sf_dir), ["employer_name", "union_name"]).select("s_suppkey")


@query("SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY ALL")
def outcome_counts(spark, sf_dir):
    return quality.outcome_counts(read(spark, sf_dir, "orders"), "o_orderstatus", "o_orderpriority")


@query("SELECT count(*) AS n, count(*) FILTER (o_orderstatus = 'F') AS closed, count(*) FILTER (o_totalprice > 100000) AS large, count(DISTINCT o_custkey) AS customers FROM orders")
def run_statistics(spark, sf_dir):
    o = read(spark, sf_dir, "orders")
    counts = quality.counters(o, {"closed": F.col("o_orderstatus") == "F", "large": F.col("o_totalprice") > 100000})
    return counts.withColumn("customers", F.lit(o.select("o_custkey").distinct().count()))


@query("""SELECT o_orderkey, CAST(l AS INT) AS yes, CAST(o AS INT) AS pop, CASE WHEN l * 100 >= 51 * o THEN 'true' ELSE 'false' END AS passed FROM (
  SELECT o_orderkey, count(*) AS o, count(*) FILTER (l_returnflag = 'N') AS l FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1)""")
def tally_threshold(spark, sf_dir):
    """Fixed-width tally lines written and read back; 51 % of the unit decides."""
    from .rosters import tally_lines

    o, li = read(spark, sf_dir, "orders"), read(spark, sf_dir, "lineitem")
    sums = o.join(li, li.l_orderkey == o.o_orderkey).groupBy("o_orderkey").agg(F.count("*").alias("pop"), F.count_if(F.col("l_returnflag") == "N").alias("yes"))
    line = F.format_string("%03d.%04d   City of Order %d   Teamsters Local 1   All staff   %d  %d  %d  %d", F.lit(1), F.lit(2), "o_orderkey", "pop", "pop", "yes", F.col("pop") - F.col("yes"))
    read_back = tally_lines(sums.select("o_orderkey", line.alias("line")))
    return read_back.select("o_orderkey", F.col("votes_yes").cast("int").alias("yes"), F.col("unit_population").cast("int").alias("pop"), F.col("meets_51_percent").alias("passed"))


@query("SELECT n_nationkey, n_name, coalesce(CASE WHEN n_nationkey % 2 = 0 THEN 'override ' || n_nationkey END, n_name) AS name, r_name FROM nation LEFT JOIN region ON n_regionkey = r_regionkey AND r_regionkey <> 2")
def override_and_enrich(spark, sf_dir):
    """Left joins: an override table beats a parsed value, details enrich where they exist."""
    n, r = read(spark, sf_dir, "nation"), read(spark, sf_dir, "region").filter("r_regionkey <> 2")
    overrides = n.filter("n_nationkey % 2 = 0").select(F.col("n_nationkey").alias("_key"), F.concat(F.lit("override "), F.col("n_nationkey").cast("string")).alias("_name"))
    joined = n.join(overrides, n.n_nationkey == F.col("_key"), "left").join(r, n.n_regionkey == r.r_regionkey, "left")
    return joined.select("n_nationkey", "n_name", F.coalesce("_name", "n_name").alias("name"), "r_name")


@query("""SELECT 'ORD:' || o_orderkey AS row_key, 'TPCH' AS source_agency_code, CAST(o_orderkey AS VARCHAR) AS case_number, 'ULP' AS canonical_case_type, o_orderpriority AS native_case_type,
  '' AS employer_name, '' AS union_name, '' AS jurisdiction_city, '' AS jurisdiction_state, '' AS employer_street, '' AS employer_zip, '' AS source_page_url, '' AS source_url, '2026-01-01' AS scraped_at FROM orders""")
def wide_rows(spark, sf_dir):
    """The sink's shape: fixed string columns, extras gone, missing ones empty."""
    from ..schema import CORE, to_wide

    o = read(spark, sf_dir, "orders")
    made = o.withColumns({"row_key": keys.row_key(F.lit("ORD"), F.col("o_orderkey").cast("string")), "source_agency_code": F.lit("TPCH"), "case_number": F.col("o_orderkey"), "canonical_case_type": rules.canonical_case_type(F.lit("ulp "), {}), "native_case_type": F.col("o_orderpriority"), "scraped_at": F.lit("2026-01-01"), "employer_name": F.lit(None).cast("string")})
    return to_wide(made, CORE)


@query("""SELECT 'LAB:' || o_orderkey || ':PF-' || left(o_orderpriority, 1) || '-' || strftime(o_orderdate, '%y') || '-' || o_orderkey || '-W' AS row_key, o_orderkey,
  'City of ' || n_name AS employer_name, 'Teamsters Local ' || o_custkey AS union_name, strftime(o_orderdate, '%Y-%m-%d') AS decision_date, 'day' AS decision_date_precision,
  CASE left(o_orderpriority, 1) WHEN '1' THEN 'ULP' WHEN '2' THEN 'CERTIFICATION' WHEN '3' THEN 'DECERTIFICATION' ELSE left(o_orderpriority, 1) END AS canonical_case_type
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""")
def case_index(spark, sf_dir):
    """Flagship: case names, order texts and dockets read into one wide table with key, type, date and precision."""
    c, n = read(spark, sf_dir, "customer"), read(spark, sf_dir, "nation")
    parties = c.join(n, c.c_nationkey == n.n_nationkey).select("c_custkey", F.concat(F.lit("City of "), "n_name").alias("city"))
    o = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey").join(parties, F.col("o_custkey") == F.col("c_custkey"))
    local = F.concat(F.lit("Teamsters Local "), F.col("o_custkey").cast("string"))
    named = o.withColumn("case_name", F.when(F.col("o_orderkey") % 2 == 0, F.concat_ws(" v. ", "city", local)).otherwise(F.concat_ws(" v. ", local, "city")))
    named = named.withColumn("r", roles.caption_roles("case_name")).select("o_orderkey", F.col("r.employer").alias("employer_name"), F.col("r.union").alias("union_name"))
    dated = order_dates(spark, sf_dir).select(F.col("o_orderkey").alias("_d"), F.col("issued").alias("decision_date"), F.col("precision").alias("decision_date_precision"))
    typed = docket_parse(spark, sf_dir).select(F.col("o_orderkey").alias("_t"), "docket", "canonical_case_type")
    made = named.join(dated, F.col("o_orderkey") == F.col("_d"), "left").join(typed, F.col("o_orderkey") == F.col("_t"), "left")
    key = keys.row_key(F.lit("LAB"), F.col("o_orderkey").cast("string"), "docket")
    return made.select(key.alias("row_key"), "o_orderkey", "employer_name", "union_name", "decision_date", "decision_date_precision", "canonical_case_type")
