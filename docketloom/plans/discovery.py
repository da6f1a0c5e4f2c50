"""Discovery as queries: sites made of the suppliers, crawled over their landed pages."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources import crawl
from ..written import shared
from .roundtrip import query, read

SITE = "https://d.example/"
#: index to sections, sections to every other batch, batches to the next one and to documents (those of the next batch's first, too).
RULES = (
    crawl.Rule("index", "section", lambda url, label: url.rlike(r"/i\d+\.html$"), lambda url, label: F.regexp_extract(label, r"(\d+)", 1)),
    crawl.Rule("section", "batch", lambda url, label: url.rlike(r"/b\d+\.html$")),
    crawl.Rule("batch", "batch", lambda url, label: url.rlike(r"/b\d+\.html$")),
    crawl.Rule("batch", "document", lambda url, label: url.rlike(r"\.pdf")),
)


def site(spark, sf_dir: str) -> DataFrame:
    """(url, html): an index, a section for 10,000 suppliers, a batch for 100, so that no page grows with the table."""
    s = read(spark, sf_dir, "supplier").select("s_suppkey", F.floor(F.col("s_suppkey") / 100).alias("b"), F.floor(F.col("s_suppkey") / 10_000).alias("i"))
    link = lambda *parts: F.concat(F.lit('<a href="'), *(F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts), F.lit("</a>"))
    page = lambda name, links: (F.concat(F.lit(SITE), *name).alias("url"), F.array_join(F.array_sort(F.collect_set(links)), "\n").alias("html"))
    index = s.select("i").distinct().agg(page([], link("i", F.col("i"), '.html">Section ', F.col("i")))[1]).select(F.lit(SITE).alias("url"), "html")
    sections = s.filter("b % 2 = 0").groupBy("i").agg(page([], link("/b", F.col("b"), '.html">batch'))[1]).select(F.concat(F.lit(f"{SITE}i"), F.col("i").cast("string"), F.lit(".html")).alias("url"), "html")
    batches = s.groupBy("b").agg(page([], link("files/", F.col("s_suppkey"), '.pdf?x=1&amp;y=2#page">Order'))[1]).select(
        F.concat(F.lit(f"{SITE}b"), F.col("b").cast("string"), F.lit(".html")).alias("url"),
        F.concat("html", link("b", F.col("b") + 1, '.html">next'), link('/">back'), link("/files/", (F.col("b") + 1) * 100, '.pdf?x=1&amp;y=2">first of the next'), link('https://other.example/b1.htm">elsewhere')).alias("html"),
    )
    return index.union(sections).union(batches)


@query(f"""WITH RECURSIVE s AS (SELECT s_suppkey, s_suppkey // 100 AS b, s_suppkey // 10000 AS i FROM supplier),
e AS (SELECT '{SITE}' AS src, '{SITE}i' || i || '.html' AS dst FROM s
  UNION SELECT '{SITE}i' || i || '.html', '{SITE}b' || b || '.html' FROM s WHERE b % 2 = 0
  UNION SELECT '{SITE}b' || b || '.html', '{SITE}b' || (b + 1) || '.html' FROM s
  UNION SELECT '{SITE}b' || b || '.html', '{SITE}files/' || s_suppkey || '.pdf?x=1&y=2' FROM s
  UNION SELECT '{SITE}b' || b || '.html', '{SITE}files/' || ((b + 1) * 100) || '.pdf?x=1&y=2' FROM s),
r AS (SELECT '{SITE}' AS url, 0 AS depth UNION SELECT dst, depth + 1 FROM r JOIN e ON src = url WHERE depth < 9),
d AS (SELECT url, min(depth) AS depth FROM r GROUP BY url),
p AS (SELECT e.dst AS url, min(e.src) AS parent FROM e JOIN d x ON x.url = e.src JOIN d y ON y.url = e.dst WHERE x.depth + 1 = y.depth GROUP BY 1)
SELECT d.url, CASE WHEN d.url = '{SITE}' THEN 'index' WHEN d.url LIKE '%.pdf%' THEN 'document' WHEN d.url LIKE '{SITE}i%' THEN 'section' ELSE 'batch' END AS level, d.depth, coalesce(p.parent, '') AS parent,
  CASE WHEN d.url LIKE '%.pdf%' THEN 'listed' WHEN d.url IN (SELECT src FROM e) THEN 'ok' ELSE 'missing' END AS status, CASE WHEN d.url LIKE '{SITE}i%' THEN regexp_extract(d.url, 'i([0-9]+)', 1) ELSE '' END AS value
FROM d LEFT JOIN p ON p.url = d.url""")
def crawled_site(spark, sf_dir):
    """Every address reached from the index, in rounds over the landed pages."""
    seeds = spark.createDataFrame([(SITE, "index")], "url string, level string")
    found = crawl.crawl(seeds, RULES, crawl.from_landed(site(spark, sf_dir)), f"{shared(spark)}/crawl-{uuid.uuid4().hex}")
    return found.select("url", "level", "depth", "parent", "status", "value")
