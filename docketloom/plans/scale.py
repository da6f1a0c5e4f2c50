"""Queries of the operators that hold for keys and tables of any size: places, differences of multisets, totals, CSV records."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import ordinals, quality
from ..sources.sinks import csv_line
from . import weekly
from .roundtrip import query, read


@query("""SELECT o_orderkey, row_number() OVER (ORDER BY lower(o_orderpriority) DESC, o_custkey, o_orderdate, o_orderkey) AS position,
  row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_custkey DESC, o_orderkey) AS place_in_status FROM orders""")
def order_places(spark, sf_dir):
    """Places of all orders: case-blind, by a docket's number and not its digits, and within a status that half of them have."""
    o = read(spark, sf_dir, "orders").withColumn("docket", F.concat(F.lit("C-"), F.col("o_custkey").cast("string")))
    number = F.regexp_extract("docket", r"(\d+)", 1).cast("long")
    placed = ordinals.with_places(o, [F.lower("o_orderpriority").desc(), number, "o_orderdate", "o_orderkey"], name="position")
    return ordinals.with_places(placed, [number.desc(), "o_orderkey"], ["o_orderstatus"], "place_in_status").select("o_orderkey", "position", "place_in_status")


@query("""WITH a AS (SELECT l_suppkey AS k, l_returnflag AS v, count(*) AS n FROM lineitem GROUP BY ALL),
b AS (SELECT l_suppkey AS k, CASE WHEN l_linenumber = 1 THEN 'Z' ELSE l_returnflag END AS v, count(*) AS n FROM lineitem WHERE l_linenumber < 7 GROUP BY ALL),
j AS (SELECT k, coalesce(a.n, 0) AS x, coalesce(b.n, 0) AS y FROM a FULL JOIN b USING (k, v)),
s AS (SELECT k, sum(least(x, y)) AS same, sum(x - least(x, y)) AS gone, sum(y - least(x, y)) AS come FROM j GROUP BY k)
SELECT l_suppkey, bucket, n FROM (SELECT k AS l_suppkey, unnest(['same', 'changed', 'emptied', 'filled']) AS bucket, CAST(unnest([same, least(gone, come), gone - least(gone, come), come - least(gone, come)]) AS BIGINT) AS n FROM s) WHERE n > 0""")
def replay_multisets(spark, sf_dir):
    """Two runs with many rows of a key: what stayed, changed, went and came."""
    li = read(spark, sf_dir, "lineitem").select("l_suppkey", "l_linenumber", F.col("l_returnflag").alias("v"))
    new = li.filter("l_linenumber < 7").withColumn("v", F.when(F.col("l_linenumber") == 1, "Z").otherwise(F.col("v")))
    return quality.replay(li, new, "l_suppkey", ["v"]).groupBy("l_suppkey", F.col("v_bucket").alias("bucket")).agg(F.count("*").alias("n"))


@query("""SELECT n_nationkey, count(s_suppkey) AS rows, CAST(count(s_suppkey) + CASE n_nationkey % 5 WHEN 0 THEN 3 WHEN 1 THEN -2 ELSE n_nationkey % 2 END AS BIGINT) AS total
FROM nation LEFT JOIN supplier ON s_nationkey = n_nationkey GROUP BY n_nationkey HAVING n_nationkey % 5 = 0""")
def totals_off(spark, sf_dir):
    """Sections whose rows are further from the stated total than they may be: the guard of a paged listing."""
    s = read(spark, sf_dir, "supplier")
    counts = read(spark, sf_dir, "nation").join(s, F.col("s_nationkey") == F.col("n_nationkey"), "left").groupBy("n_nationkey").agg(F.count("s_suppkey").alias("n"))
    add = F.when(F.col("n_nationkey") % 5 == 0, 3).when(F.col("n_nationkey") % 5 == 1, -2).otherwise(F.col("n_nationkey") % 2)
    stated = counts.select("n_nationkey", (F.col("n") + add).alias("total"))
    return quality.off_totals(s.withColumnRenamed("s_nationkey", "n_nationkey"), stated, F.abs(F.col("rows") - F.col("total")) > 2, "n_nationkey")


@query("""SELECT doc_id, sha256(doc_id || ',' || CASE WHEN regexp_matches(coalesce(text, ''), '[,"\r\n]') THEN '"' || replace(text, '"', '""') || '"' ELSE coalesce(text, '') END || ',' || coalesce(lang, '') || ',' || coalesce(source, '')) AS record_sha256 FROM documents""")
def csv_records(spark, sf_dir):
    """Each document as a record of CSV, quoted only where it must be, line feeds as they are."""
    d = read(spark, sf_dir, "documents")
    return d.select("doc_id", F.sha2(csv_line(["doc_id", "text", "lang", "source"]), 256).alias("record_sha256"))


@query("""WITH d AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, CAST(o_orderdate AS DATE) + 6 AS e, o_orderkey % 7 AS form FROM orders)
SELECT o_orderkey, CASE WHEN form IN (0, 5, 6) THEN '' ELSE strftime(d, '%Y-%m-%d') END AS week_start, CASE form WHEN 5 THEN strftime(d, '%Y-%m-%d') WHEN 6 THEN '' ELSE strftime(e, '%Y-%m-%d') END AS week_end FROM d""")
def report_weeks(spark, sf_dir):
    """Seven forms of a report's week: an ending, an address, a borrowed year (over December, too), abbreviations, days of one month, a
    single day, nothing."""
    o = read(spark, sf_dir, "orders").withColumn("d", F.col("o_orderdate").cast("date")).withColumn("e", F.date_add("d", 6))
    day = lambda c, form="MMMM d": F.date_format(c, form)
    year = lambda c: F.date_format(c, "yyyy")
    borrowed = F.concat(day("d"), F.lit(" – "), day("e"), F.lit(", "), year("e"))
    slug = F.concat(F.lit("https://n.example/weekly-activity-report-"), F.lower(day("d", "MMMM-d-yyyy")), F.lit("-to-"), F.lower(day("e", "MMMM-d-yyyy")), F.lit("/"))
    within = F.when(F.month("d") == F.month("e"), F.concat(day("d"), F.lit("-"), day("e", "d"), F.lit(", "), year("e"))).otherwise(borrowed)
    short = F.concat(day("d", "MMM"), F.lit(". "), day("d", "d"), F.lit(", "), year("d"), F.lit(" through "), day("e", "MMM"), F.lit(". "), day("e", "d"), F.lit(", "), year("e"))
    forms = [F.concat(F.lit("Week ending "), day("e"), F.lit(", "), year("e")), F.lit("Report"), borrowed, short, within, F.concat(day("d", "MMMM d"), F.lit("th "), year("d")), F.lit("Weekly Activity Report")]
    told = F.coalesce(*(F.when(F.col("o_orderkey") % 7 == k, form) for k, form in enumerate(forms)))
    address = F.when(F.col("o_orderkey") % 7 == 1, slug).otherwise(F.lit("https://n.example/19048-2/"))
    return o.select("o_orderkey", weekly.report_week(told, F.lit(""), address).alias("w")).select("o_orderkey", F.col("w.start").alias("week_start"), F.col("w.end").alias("week_end"))
