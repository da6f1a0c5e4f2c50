"""Round-trip queries over whole documents: pages, captions, dossiers, tallies, feeds and rosters made from the star schema and
read back by the datasets' own operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import captions, dates, documents, roles, text
from ..operators import carry, quality
from ..schema import flag
from ..sources import tables
from ..sources.events import event_rows
from . import cases, feeds, layouts, listings, rosters, weekly
from .roundtrip import AS_OF, query, read


def _line_up(df: DataFrame, key: str, order: list[str], parts: str, between: str = "") -> DataFrame:
    """(key, body): the parts of each key in order, joined."""
    rows = F.array_sort(F.collect_list(F.struct(*order, F.col(parts).alias("_part"))))
    return df.groupBy(key).agg(F.array_join(F.transform(rows, lambda r: r["_part"]), between).alias("body"))


@query("SELECT n_regionkey, n_nationkey, n_name, '/n/' || n_nationkey || '.pdf' AS href FROM nation")
def html_tables(spark, sf_dir):
    """Rows of HTML tables: cells and links, header and short rows dropped."""
    n = read(spark, sf_dir, "nation")
    row = F.concat(F.lit("<tr><td>"), F.col("n_nationkey").cast("string"), F.lit("</td><td><b>"), "n_name", F.lit("</b> &amp; co</td><td><a href='/n/"), F.col("n_nationkey").cast("string"), F.lit(".pdf'>x</a></td></tr>"))
    pages = _line_up(n.select("n_regionkey", "n_nationkey", row.alias("row")), "n_regionkey", ["n_nationkey"], "row")
    pages = pages.withColumn("html", F.concat(F.lit("<table><tr><th>No</th><th>Name</th><th>Doc</th></tr><tr><td>short</td></tr>"), "body", F.lit("</table>"))).drop("body")
    r = tables.table_rows(pages, least=3).filter(F.get("cells", F.lit(0)) != "No")
    return r.select("n_regionkey", F.get("cells", F.lit(0)).cast("int").alias("n_nationkey"), F.regexp_replace(F.get("cells", F.lit(1)), " & co$", "").alias("n_name"), F.col("first_href").alias("href"))


@query("""SELECT l_orderkey, 'row' AS kind, count(*) AS n FROM lineitem GROUP BY 1 UNION ALL SELECT DISTINCT l_orderkey, 'text', 2 FROM lineitem UNION ALL SELECT DISTINCT l_orderkey, 'table_end', 1 FROM lineitem""")
def page_events(spark, sf_dir):
    """Pages as ordered events: text runs, table rows, table ends; scripts are silent."""
    li = read(spark, sf_dir, "lineitem")
    row = F.concat(F.lit("<tr><td>"), F.col("l_linenumber").cast("string"), F.lit("<br>x</td></tr>"))
    pages = _line_up(li.select("l_orderkey", "l_linenumber", "l_partkey", row.alias("row")), "l_orderkey", ["l_linenumber", "l_partkey"], "row")
    pages = pages.withColumn("html", F.concat(F.lit("<h1>Head</h1><script>var a='<p>';</script>lead<table>"), "body", F.lit("</table>"))).drop("body")
    return event_rows(pages).groupBy("l_orderkey", "kind").agg(F.count("*").alias("n"))


@query("SELECT o_orderkey, 'A-' || lpad(CAST(o_orderkey % 100000 AS VARCHAR), 5, '0') AS case_number, 'Carrier ' || o_custkey AS employer_name, 'UNION' || l_linenumber AS union_name, 'mediation_new_docket' AS section FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem) JOIN orders ON l_orderkey = o_orderkey")
def weekly_report_rows(spark, sf_dir):
    """Labelled report tables: sections, drifting headers, continuation rows; a report for each order."""
    lines = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber").repartition("l_orderkey").distinct().groupBy("l_orderkey").agg(F.array_sort(F.collect_list("l_linenumber")).alias("lines"))
    case, carrier = F.concat(F.lit("A-"), F.lpad((F.col("o_orderkey") % 100000).cast("string"), 5, "0")), F.concat(F.lit("Carrier "), F.col("o_custkey").cast("string"))
    shown = F.concat(case, F.lit("</td><td>"), carrier)
    row = lambda k, place: F.concat(F.lit("<tr><td>"), F.when(place == 0, shown).otherwise(F.lit("</td><td>")), F.lit("</td><td>UNION"), k.cast("string"), F.lit("</td><td>Crew</td></tr>"))
    body = F.array_join(F.transform("lines", row), "")
    pages = read(spark, sf_dir, "orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey")).select("o_orderkey", body.alias("body"))
    head = "<p>November 15 - November 19, 2010</p><p>Arbitration:</p><table><tr><td>A-1</td><td>x</td><td>y</td><td>z</td></tr></table><p>New Dockets:</p><table><tr><th>Case No.</th><th>Carrier</th><th>Org.</th><th>Class/Craft</th></tr>"
    pages = pages.select(F.concat(F.lit("https://n/"), F.col("o_orderkey").cast("string")).alias("source_url"), F.lit("i").alias("source_page_url"), F.concat(F.lit(head), "body", F.lit("</table>")).alias("html"))
    return weekly.parse_reports(pages).select(F.substring_index("source_url", "/", -1).cast("bigint").alias("o_orderkey"), "case_number", "employer_name", "union_name", "section")


@query("SELECT s_suppkey, 'City of ' || replace(n_name, '_', ' ') AS respondent, 'Teamsters Local ' || s_suppkey AS petitioner, '' AS intervenor FROM supplier JOIN nation ON s_nationkey = n_nationkey")
def labelled_captions(spark, sf_dir):
    """Names land in the role whose own label follows them; unlabelled ones in none."""
    s, n = read(spark, sf_dir, "supplier"), read(spark, sf_dir, "nation")
    body = F.concat(F.lit("BOARD\nIn the Matter of:\nTeamsters Local "), F.col("s_suppkey").cast("string"), F.lit(",   )\n   Petitioner,   )\nand   ) Case\nUnlabelled Body\nand\nCity of "), "n_name", F.lit(", Respondent.\nCERTIFICATION\nNobody, Intervenor"))
    made = s.join(n, s.s_nationkey == n.n_nationkey).select("s_suppkey", captions.labelled_caption(body, r"in\s+the\s+matter\s+of\s*:?", r"^\s*certification", (r"Case\b.*",)).alias("c"))
    return made.select("s_suppkey", captions.names(F.col("c.respondent")).alias("respondent"), captions.names(F.col("c.petitioner")).alias("petitioner"), captions.names(F.col("c.intervenor")).alias("intervenor"))


@query("""SELECT s_suppkey, CASE s_suppkey % 3 WHEN 2 THEN '' ELSE 'Teamsters Local ' || s_suppkey END AS name, CASE s_suppkey % 3 WHEN 2 THEN 'no_representative' ELSE 'representative_certified' END AS result FROM supplier""")
def certified_representatives(spark, sf_dir):
    """Only the operative section says whom a board certified."""
    s = read(spark, sf_dir, "supplier")
    local = F.concat(F.lit("Teamsters Local "), F.col("s_suppkey").cast("string"))
    k = F.col("s_suppkey") % 3
    act = F.when(k == 0, F.concat(F.lit("the "), local, F.lit(" has been designated"))).when(k == 1, F.concat(F.lit("a majority of the valid ballots have been cast for "), local, F.lit(", and that it"))).otherwise(F.lit("no labor organization has been selected"))
    made = s.select("s_suppkey", captions.certified_representative(F.concat(F.lit("Petitioner: AFSCME.\nIT IS HEREBY CERTIFIED that "), act), text.unescape_common).alias("r"))
    return made.select("s_suppkey", "r.name", "r.result")


@query("SELECT s_suppkey, 'Teamsters Local ' || s_suppkey AS name FROM supplier")
def certification_sentences(spark, sf_dir):
    body = F.concat(F.lit("NOW, THEREFORE, the Board certifies that the Teamsters\n   Local "), F.col("s_suppkey").cast("string"), F.lit(" has been duly designated and authorized to represent the craft"))
    return read(spark, sf_dir, "supplier").select("s_suppkey", captions.certification_sentence(body)["name"].alias("name"))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'revoked' ELSE 'in_effect' END AS status, strftime(o_orderdate, '%Y-%m-%d') AS certified, CASE WHEN o_orderkey % 3 = 0 THEN '2005-05-02' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS latest FROM orders""")
def dossier_status(spark, sf_dir):
    """A dossier's last order decides its status, its first certifying order the date."""
    o = read(spark, sf_dir, "orders")
    body = F.concat(F.lit("ORDER AND CERTIFICATION\nIt was filed and a copy served on each party on "), F.date_format("o_orderdate", "MMMM d, yyyy"), F.lit(".\n"), F.when(F.col("o_orderkey") % 3 == 0, F.lit("ORDER REVOKING CERTIFICATION\nDated May 2, 2005.\n")).otherwise(F.lit("")))
    s = o.select("o_orderkey", documents.dossier_status(body, AS_OF).alias("s"))
    return s.select("o_orderkey", F.col("s.certification_status").alias("status"), F.col("s.certification_order_date").alias("certified"), F.col("s.latest_order_date").alias("latest"))


@query("SELECT p_partkey, CAST(length(p_name) * 8 AS INT) AS text_chars, CASE WHEN p_partkey % 5 = 0 THEN 'true' ELSE CASE WHEN p_partkey % 5 = 1 THEN '' ELSE 'false' END END AS image_only FROM part WHERE p_partkey % 5 NOT IN (0, 1) UNION ALL SELECT p_partkey, 0, CASE WHEN p_partkey % 5 = 0 THEN 'true' ELSE '' END FROM part WHERE p_partkey % 5 IN (0, 1)")
def pdf_probe(spark, sf_dir):
    """Bytes of made PDFs: text layers, scans, and files that are no PDF."""
    p = read(spark, sf_dir, "part")
    k = F.col("p_partkey") % 5
    drawn = F.concat(F.lit("%PDF-1.4 /Type /Page /Font stream\nBT ("), F.repeat("p_name", 8), F.lit(") Tj ETendstream"))
    made = p.select("p_partkey", documents.probe_pdf(F.encode(F.when(k == 0, F.lit("%PDF-1.4 /Type /Page /Subtype /Image")).when(k == 1, F.lit("plain")).otherwise(drawn), "UTF-8")).alias("p"))
    return made.select("p_partkey", "p.text_chars", flag(F.col("p.is_image_only")).alias("image_only"))


@query("SELECT n_nationkey, n_regionkey, 'NATION ' || n_nationkey || ' County' AS employer_name, 'AFSCME Local ' || n_nationkey AS union_name FROM nation")
def json_feed(spark, sf_dir):
    """An offset-paged JSON feed to rows with roles (Oregon's dataset)."""
    n = read(spark, sf_dir, "nation")
    record = F.struct(F.col("n_nationkey").cast("string").alias("pointer"), F.lit("UP-1-17").alias("title"), F.concat(F.lit("AFSCME Local "), F.col("n_nationkey").cast("string"), F.lit(" v. NATION "), F.col("n_nationkey").cast("string"), F.lit(" County")).alias("subjec"), F.lit("ULP").alias("type"), F.lit("2020-01-01").alias("date"))
    pages = n.groupBy(F.col("n_regionkey").alias("start")).agg(F.to_json(F.struct(F.collect_list(record).alias("records"))).alias("payload"))
    made = feeds.oregon({"pages": pages}, AS_OF)
    return made.select(F.col("contentdm_pointer").cast("int").alias("n_nationkey"), F.col("start").alias("n_regionkey"), "employer_name", "union_name")


@query("SELECT n_nationkey, 'PERC 2020-' || lpad(CAST(n_nationkey AS VARCHAR), 3, '0') AS case_number, '20' || CASE WHEN n_nationkey % 2 = 0 THEN '20' ELSE '20' END AS decision_year, n_name AS employer_name FROM nation")
def xml_feed(spark, sf_dir):
    """Cursor-paged XML entries to rows (New Jersey's dataset)."""
    n = read(spark, sf_dir, "nation")
    k = F.col("n_nationkey").cast("string")
    entry = F.concat(F.lit('<viewentry position="'), k, F.lit('" unid="'), k, F.lit('"><entrydata columnnumber="2" name="$17"><text>[&lt;a href="/x/'), k, F.lit('.pdf?OpenElement"&gt;PERC 2020-'), k, F.lit('&lt;/a&gt;]</text></entrydata><entrydata columnnumber="5" name="$21"><text>'), "n_name", F.lit("</text></entrydata></viewentry>"))
    pages = _line_up(n.select("n_regionkey", "n_nationkey", entry.alias("e")), "n_regionkey", ["n_nationkey"], "e")
    pages = pages.select(F.col("n_regionkey").alias("page"), F.concat(F.lit("<viewentries>"), "body", F.lit("</viewentries>")).alias("payload"))
    made = feeds.new_jersey({"pages": pages}, AS_OF)
    return made.select(F.col("unid").cast("int").alias("n_nationkey"), "case_number", "decision_year", "employer_name")


@query("SELECT n_name AS employer_name, s_name AS bargaining_unit_name, CASE WHEN s_suppkey % 4 = 0 THEN 'DECERTIFIED' ELSE 'CERTIFIED' END AS status FROM supplier JOIN nation ON s_nationkey = n_nationkey")
def prose_roster(spark, sf_dir):
    """A roster in prose: employers, units, stars (Kansas' dataset); a blocked source of higher priority doesn't count."""
    s, n = read(spark, sf_dir, "supplier"), read(spark, sf_dir, "nation")
    unit = F.concat("s_name", F.when(F.col("s_suppkey") % 4 == 0, F.lit("*")).otherwise(F.lit("")))
    entries = _line_up(s.join(n, s.s_nationkey == n.n_nationkey).select("n_name", "s_suppkey", unit.alias("u")), "n_name", ["s_suppkey"], "u", "; ")
    body = entries.agg(F.array_join(F.array_sort(F.collect_list(F.concat("n_name", F.lit(" - "), "body"))), ", ").alias("b"))
    page = body.select(F.lit("https://k/b").alias("url"), F.lit(2).alias("priority"), F.concat(F.lit("<strong>Cities</strong>: "), "b", F.lit("<br>")).alias("html"))
    blocked = spark.createDataFrame([("https://k/a", 1, "Access Denied by akamai")], "url string, priority int, html string")
    return cases.kansas({"pages": blocked.union(page)}, AS_OF).select("employer_name", "bargaining_unit_name", F.col("representation_status").alias("status"))


@query("""SELECT o_orderpriority AS disposition, CASE WHEN o_orderpriority LIKE '1%' THEN 'true' ELSE 'false' END AS asserted, count(*) AS n FROM orders GROUP BY ALL""")
def certification_dispositions(spark, sf_dir):
    """A disposition asserts representation only with the word and without a negative marker."""
    words = F.when(F.col("o_orderpriority").startswith("1"), "Certification").when(F.col("o_orderpriority").startswith("2"), "Certification Revoked").when(F.col("o_orderpriority").startswith("3"), "Dismissed").otherwise("Transfer of Certification")
    return read(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("disposition"), F.when(cases.certifies(words), "true").otherwise("false").alias("asserted")).groupBy("disposition", "asserted").agg(F.count("*").alias("n"))


@query("SELECT s_suppkey, 'S-RC-14-' || lpad(CAST(s_suppkey % 1000 AS VARCHAR), 3, '0') AS case_number, 'City of ' || n_name AS employer_name, 'Teamsters Local ' || s_suppkey AS union_name, '5/2/2014' AS certified_date FROM supplier JOIN nation ON s_nationkey = n_nationkey")
def layout_tables(spark, sf_dir):
    """Fixed-width tables by their own headers (Illinois' dataset)."""
    s, n = read(spark, sf_dir, "supplier"), read(spark, sf_dir, "nation")
    line = F.concat(F.rpad(F.concat(F.lit("S-RC-14-"), F.lpad((F.col("s_suppkey") % 1000).cast("string"), 3, "0")), 20, " "), F.rpad(F.concat(F.lit("City of "), "n_name"), 30, " "), F.rpad(F.concat(F.lit("Teamsters Local "), F.col("s_suppkey").cast("string")), 30, " "), F.lit("5/2/2014     Clerks"))
    docs = _line_up(s.join(n, s.s_nationkey == n.n_nationkey).select(F.col("s_suppkey").alias("k"), F.lit(1).alias("one"), line.alias("l")), "k", ["one"], "l")
    head = F.concat(F.lit("   CERTIFICATIONS OF REPRESENTATIVE\n"), F.rpad(F.lit("Case Number"), 20, " "), F.rpad(F.lit("Employer"), 30, " "), F.rpad(F.lit("Labor Organization"), 30, " "), F.lit("Certified    Unit Certified\n"))
    made = layouts.illinois({"documents": docs.select(F.col("k").cast("string").alias("url"), F.lit("FY14").alias("fiscal_year"), F.concat(head, "body").alias("text"))}, AS_OF)
    return made.select(F.col("url").cast("bigint").alias("s_suppkey"), "case_number", "employer_name", "union_name", "certified_date")


@query("SELECT event_type, CAST(count(*) AS BIGINT) AS n, CAST(count(*) FILTER (value > 50) AS BIGINT) AS large FROM events GROUP BY 1")
def outcome_struct(spark, sf_dir):
    """Counters of outcomes for each kind in one pass, combined before the shuffle."""
    return quality.counters(read(spark, sf_dir, "events"), {"large": F.col("value") > 50}, "event_type")


@query("""SELECT n_nationkey, t AS town, CASE n_nationkey % 3 WHEN 0 THEN t ELSE '' END AS rhode_island, t AS minnesota
FROM (SELECT n_nationkey, 'Town' || translate(CAST(n_nationkey AS VARCHAR), '0123456789', 'abcdefghij') AS t FROM nation)""")
def city_rules(spark, sf_dir):
    """A city only where an employer's name states one, by the rules of its source."""
    n = read(spark, sf_dir, "nation").withColumns({"town": F.concat(F.lit("Town"), F.translate(F.col("n_nationkey").cast("string"), "0123456789", "abcdefghij")), "k": F.col("n_nationkey") % 3})
    employer = F.when(F.col("k") == 0, F.concat(F.lit("Town of "), "town")).when(F.col("k") == 1, F.concat("town", F.lit(" School Committee"))).otherwise(F.concat(F.lit("ISD 709, "), "town"))
    return n.select("n_nationkey", "town", listings.rhode_island_city(employer).alias("rhode_island"), feeds.minnesota_city(employer).alias("minnesota"))


@query("SELECT o_orderkey, 'FY' || strftime(o_orderdate, '%y') AS fy, '20' || strftime(o_orderdate, '%y') || '_spring' AS cycle FROM orders")
def cycle_labels(spark, sf_dir):
    o = read(spark, sf_dir, "orders")
    return o.select("o_orderkey", dates.fiscal_year(F.concat(F.lit("certs-fy20"), F.date_format("o_orderdate", "yy"), F.lit(".pdf"))).alias("fy"), cases.election_cycle(F.concat(F.lit("https://w/spring-20"), F.date_format("o_orderdate", "yy"), F.lit(".pdf"))).alias("cycle"))


@query("SELECT r_regionkey, count(*) AS n_units FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1")
def roster_lines(spark, sf_dir):
    """Text exploded to lines with their place, and read back by shape."""
    s, n = read(spark, sf_dir, "supplier"), read(spark, sf_dir, "nation")
    docs = _line_up(s.join(n, s.s_nationkey == n.n_nationkey).select(F.col("n_regionkey").alias("r_regionkey"), "s_suppkey", F.concat(F.lit("  a. "), "s_name").alias("l")), "r_regionkey", ["s_suppkey"], "l", "\n")
    return rosters.text_lines(docs, "body").filter(F.col("line").rlike(r"^\s*[a-z]\. ")).groupBy("r_regionkey").agg(F.count("*").alias("n_units"))


@query("SELECT s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN 'Teamsters Local ' || s_suppkey ELSE '' END AS union_name FROM supplier")
def distinct_parties(spark, sf_dir):
    """A party named twice is one; two unions name none."""
    s = read(spark, sf_dir, "supplier")
    k = F.col("s_suppkey").cast("string")
    right = F.when(F.col("s_suppkey") % 2 == 0, F.concat(F.lit("City of X and Teamsters Local "), k)).otherwise(F.lit("City of X and SEIU Local 9999"))
    made = s.withColumns({"l": F.concat(F.lit("Teamsters Local "), k), "r": right})
    return made.withColumn("p", roles.assign_roles("l", "r")).select("s_suppkey", F.col("p.union").alias("union_name"))
