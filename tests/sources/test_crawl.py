"""Discovery on canned hosts against a plain breadth-first search; broken-off crawls; what is found feeds a dataset."""

import re
import shutil
from urllib.parse import urldefrag, urljoin

import pytest
from pyspark.sql import functions as F

from docketloom.plans import dataset, listings  # noqa: F401  (registers the datasets)
from docketloom.sources import crawl

from ..plans.helpers import AS_OF, SCRAPED

DE = "https://perb.delaware.gov/"
SITE = {
    f"{DE}decisions/": '<a href="/decisions/2026/">2026</a><a href="/decisions/2025/"> 2025 </a><a href="2025-again/">2025</a><a href="/about">About 2024</a><a href="">2023</a>',
    f"{DE}decisions/2026/": '<a href="/f/1546 ULP.pdf">View decision 2026 ULP 1546 Order of Dismissal</a><a href="/decisions/">index</a><a href="../2025/">2025</a>',
    f"{DE}decisions/2025/": '<a href="/f/9.PDF?v=1#p2">View decision 2025 REP 9 City of Dover</a><a href="https://perb.delaware.gov/f/1546%20ULP.pdf">again</a><a href="/f/9.PDF?v=1">View decision</a><a href="/f/1546 ULP.pdf">twice</a>',
}


def plain(site, index, rules):
    """Breadth first with lists: {url: (level, depth, parent)}; rules as (of, to, pattern of the url, pattern of the label, once)."""
    found, names, frontier = {index: ("index", 0, "")}, {index}, [index]
    while frontier:
        options = {}
        for parent in frontier:
            for pos, (href, label) in enumerate(re.findall(r'<a href="([^"]*)">(.*?)</a>', site.get(parent, ""))):
                url = urldefrag(urljoin(parent, href.replace("&amp;", "&")))[0]
                for of, to, at, said, once in rules:
                    if href and found[parent][0] == of and re.search(at, url) and re.search(said, label):
                        name = f"{to}|{label.strip()}" if once else url
                        if name not in names:
                            options[name] = min(options.get(name, (parent, pos, url, to)), (parent, pos, url, to))
                        break
        depth = found[frontier[0]][1] + 1
        names |= set(options)
        new = {url: (to, depth, parent) for parent, _, url, to in options.values()}
        found.update(new)
        frontier = [u for u, (level, *_) in new.items() if any(r[0] == level for r in rules)]
    return found


DELAWARE = [("index", "year", "", r"^\s*(19|20)\d{2}\s*$", True), ("year", "document", r"(?i)\.pdf", "", False)]


def fetcher(url):
    return ("ok", SITE[url].encode()) if url in SITE else ("HTTP 404", None)


def seeds(spark, url):
    return spark.createDataFrame([(url, "index"), (url, "index"), (None, "index")], "url string, level string")


def test_index_years_documents(spark, tmp_path):
    found = crawl.crawl(seeds(spark, f"{DE}decisions/"), crawl.WAYS["de-perb-decisions"], crawl.from_web(fetcher, 0), str(tmp_path / "c"))
    rows = found.collect()
    assert {r.url: (r.level, r.depth, r.parent) for r in rows} == plain(SITE, f"{DE}decisions/", DELAWARE) and len(rows) == 6
    assert {r.url: r.status for r in rows if r.level == "document"} == {f"{DE}f/1546 ULP.pdf": "listed", f"{DE}f/1546%20ULP.pdf": "listed", f"{DE}f/9.PDF?v=1": "listed"}
    spec = dataset.get("de-perb-decisions")
    frames = {"pages": crawl.year_pages(found), "documents": spark.createDataFrame([], spec.inputs["documents"])}
    got = {(r.decision_year, r.case_number, r.canonical_case_type) for r in spec.rows(frames, SCRAPED, AS_OF).collect()}
    assert {("2026", "1546", "ULP"), ("2025", "9", "CERTIFICATION")} <= got
    assert sorted(r.url for r in crawl.document_urls(found).collect()) == sorted(r.url for r in rows if r.level == "document")


def test_a_crawl_that_was_broken_off_goes_on(spark, tmp_path):
    folder, log = tmp_path / "c", tmp_path / "asked"
    log.mkdir()

    def counting(url):
        (log / f"{re.sub('[^a-z0-9]', '-', url)}.{len(list(log.glob('*')))}").write_text(url)
        return fetcher(url)

    go = lambda: crawl.crawl(seeds(spark, f"{DE}decisions/"), crawl.WAYS["de-perb-decisions"], crawl.from_web(counting, 0), str(folder))
    want = sorted(map(str, go().collect()))
    asked = sorted(p.read_text() for p in log.glob("*"))
    assert asked == sorted(SITE)  # each page once, documents never
    shutil.rmtree(folder / "round=2")
    (folder / "round=1" / "_SUCCESS").unlink()
    shutil.rmtree(folder / "next=2")
    assert sorted(map(str, go().collect())) == want
    again = sorted(p.read_text() for p in log.glob("*"))
    assert again == sorted([*SITE, f"{DE}decisions/2025/", f"{DE}decisions/2026/"])  # the broken round alone
    assert sorted(map(str, go().collect())) == want and len(list(log.glob("*"))) == 5


def test_random_sites(spark, tmp_path):
    import random

    rng = random.Random(3)
    rules = (crawl.Rule("index", "page", lambda url, label: url.rlike(r"/\d+$")), crawl.Rule("page", "page", lambda url, label: url.rlike(r"/\d+$")), crawl.Rule("page", "document", lambda url, label: url.rlike("pdf")))
    as_plain = [("index", "page", r"/\d+$", "", False), ("page", "page", r"/\d+$", "", False), ("page", "document", "pdf", "", False)]
    for n in range(2):
        urls = [f"https://h{k % 3}.org/{k}" for k in range(25)]
        site = {u: "".join(f'<a href="{rng.choice(urls)}">x</a>' if rng.random() < 0.7 else f'<a href="/f{rng.randrange(9)}.pdf#{rng.randrange(3)}">y</a>' for _ in range(rng.randrange(4))) for u in urls if rng.random() < 0.9}
        site[urls[0]] = f'<a href="{urls[1]}">a</a><a href="{urls[2]}">b</a>'
        landed = spark.createDataFrame(list(site.items()), "url string, html string")
        found = crawl.crawl(seeds(spark, urls[0]), rules, crawl.from_landed(landed), str(tmp_path / f"c{n}")).collect()
        assert {r.url: (r.level, r.depth, r.parent) for r in found} == plain(site, urls[0], as_plain) and len(found) == len({r.url for r in found})
    with pytest.raises(RuntimeError, match="after 1 rounds"):
        crawl.crawl(seeds(spark, urls[0]), rules, crawl.from_landed(landed), str(tmp_path / "d"), most=1)


def test_ways_of_other_datasets(spark):
    def led(slug, of, links):
        rows = spark.createDataFrame([(of, "https://h.gov/a/b/", 0, "".join(f'<a href="{h}">{t}</a>' for h, t in links))], "level string, url string, depth int, html string")
        return [(r.url.removeprefix("https://h.gov/"), r.level, r.value) for r in crawl._followed(rows, crawl.WAYS[slug]).orderBy("pos").collect()]

    pa = [("/x/2024-plrb-final-orders", "2024"), ("/x/plrb-final-orders", "index"), ("/x/2023-final-orders/?q=1", ""), ("/x/2022-annual-report", "2022")]
    assert led("pa-plrb-final-orders", "index", pa) == [("x/2024-plrb-final-orders", "year", "2024"), ("x/2023-final-orders/?q=1", "year", "2023")]
    assert led("pa-plrb-final-orders", "year", [("/final-orders/a.pdf", "A"), ("/documents/form/b.pdf", "B"), ("/documents/annual-report.pdf", "C"), ("/c.pdf", "D")]) == [("final-orders/a.pdf", "document", "")]
    weekly = [("/2023-weekly-activity-report/", "2023"), ("/archived-weekly-activity-reports/2024-weekly-activity-reports/", "2024"), ("/weekly-activity-report-july-5-9-2004", "x"), ("/19048-2/", "Week ending May 5"), ("/wp-content/weekly-activity-report-may-2004/", "f"), ("/archived-weekly-activity-reports/", "Weekly Activity Reports archive"), ("/other/", "news")]
    assert led("nmb-weekly-activity-reports", "index", weekly) == [("2023-weekly-activity-report/", "year", "2023"), ("archived-weekly-activity-reports/2024-weekly-activity-reports/", "year", "2024"), ("weekly-activity-report-july-5-9-2004", "document", ""), ("19048-2/", "document", "")]
