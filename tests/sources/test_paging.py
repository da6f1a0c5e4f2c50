"""Paged sources on canned answers."""

import json

from docketloom.sources import paging


def canned(answers):
    asked = []

    def fetcher(url):
        asked.append(url)
        found = answers(url)
        return ("ok", found) if found is not None else ("HTTP 404", None)

    return fetcher, asked


def walked(source, answers):
    fetcher, asked = canned(answers)
    waits = []
    pages = list(paging.walk(source, fetcher, 0.3, waits.append))
    assert waits == [0.3] * (len(asked) - 1) and [p[1] for p in pages] == asked
    return asked, pages


def listed(n, field=None):
    found = [{"id": k} for k in range(n)]
    return json.dumps({field: found, "pager": {"total": 450}} if field else found).encode()


def test_offsets():
    source = paging.by_offset("or", "https://o/?start={start}", 200, "records")
    assert walked(source, lambda u: listed({"0": 200, "200": 200, "400": 50}[u.split("=")[1]], "records"))[0] == [f"https://o/?start={k}" for k in (0, 200, 400)]
    assert len(walked(source, lambda u: listed({"0": 200, "200": 0}[u.split("=")[1]], "records"))[0]) == 2
    assert len(walked(source, lambda u: b"broken")[0]) == 1
    total = paging.by_offset("or", "https://o/?start={start}", 200, "records", lambda c: json.loads(c)["pager"]["total"])
    assert len(walked(total, lambda u: listed(200, "records"))[0]) == 3  # 450 stated, though every page is full


def test_page_numbers():
    source = paging.by_page("ca", "https://c/?page={page}", 100)
    assert walked(source, lambda u: listed(100 if u.endswith(("=1", "=2")) else 7))[0] == [f"https://c/?page={k}" for k in (1, 2, 3)]
    asked, pages = walked(source, lambda u: listed(100) if u.endswith("=1") else None)
    assert len(asked) == 2 and pages[-1][2:] == ("HTTP 404", None)
    assert len(walked(paging.by_page("ca", "https://c/?page={page}", 100, most=2), lambda u: listed(100))[0]) == 2


def test_cursors():
    entries = lambda *n: "".join(f'<viewentry position="{k}" unid="U{k}"/>' for k in n).encode()
    source = paging.by_cursor("nj", "https://n/?start={start}", r'position="([\d.]+)"', r'unid="(\w+)"')
    assert walked(source, lambda u: {"1": entries(1, 2, 3), "3": entries(3, 4, 5), "5": entries(5)}[u.split("=")[1]])[0] == [f"https://n/?start={k}" for k in (1, 3, 5)]
    numbers = iter(range(1, 1000))
    assert len(walked(source, lambda u: entries(next(numbers)))[0]) == 50


def test_stated_totals():
    source = paging.by_total("ia", "https://i/cities", "https://i/cities?page={page}", 20)
    assert walked(source, lambda u: "Displaying 1 – 20 of 45 results".encode())[0] == ["https://i/cities", "https://i/cities?page=1", "https://i/cities?page=2"]
    assert len(walked(source, lambda u: b"no total")[0]) == 1


def test_numbers_until_ten_empties():
    source = paging.by_number("fl", "https://f/?no={number}", 2176, lambda c: not c)
    has = {2176, 2179, 2185}
    asked, _ = walked(source, lambda u: b"row" if int(u.split("=")[1]) in has else b"")
    assert asked[-1].endswith("=2195") and len(asked) == 20
    assert len(walked(source, lambda u: b"row")[0]) == 50


def test_pages_and_tables_of_addresses(spark):
    def fetcher(url):
        if "bad" in url:
            return "failed: TimeoutError", None
        return ("ok", json.dumps([1] * (3 if url.endswith("=1") else 1)).encode()) if "gone" not in url else ("HTTP 404", None)

    sources = [paging.by_page("a", "https://a/?p={page}", 3), paging.by_page("a2", "https://a/x?p={page}", 3), paging.by_page("b", "https://b/?p={page}", 3)]
    made = paging.pages(spark, sources, fetcher, delay=0)
    assert made.rdd.getNumPartitions() == 2
    assert sorted((r.source, r.page, r.status) for r in made.collect()) == [(s, k, "ok") for s in ("a", "a2", "b") for k in (0, 1)]
    urls = spark.createDataFrame([("https://a/1",), ("https://a/1",), ("https://a/bad",), ("https://b/gone",), (None,), ("no address",)], "url string")
    landed = paging.fetch_table(urls, fetcher, delay=0)
    assert sorted((r.url, r.status) for r in landed.collect()) == [("https://a/1", "ok"), ("https://a/bad", "failed: TimeoutError"), ("https://b/gone", "HTTP 404"), ("no address", "ok")]
    again = paging.tried_again(landed, lambda url: ("ok", b"now"), delay=0).collect()
    assert sorted((r.url, r.status) for r in again) == [("https://a/1", "ok"), ("https://a/bad", "ok"), ("https://b/gone", "HTTP 404"), ("no address", "ok")]
    assert paging.fetch_table(urls.limit(0), fetcher).count() == 0 and paging.pages(spark, [], fetcher).count() == 0


def test_harvest_lines_are_numbered(spark, tmp_path):
    import pytest

    from docketloom.sources import landing

    path = tmp_path / "h.jsonl"
    path.write_text('{"id": "a", "line": 9}\n\n{"id": "b", "more": 1}\n{}\n')
    got = landing.read_harvest_jsonl(spark, str(path), "id string, line int")
    assert got.columns == ["id", "line"] and sorted((r.line, r.id) for r in got.collect()) == [(1, "a"), (3, "b"), (4, None)]
    path.write_text('{"id": "a"}\n\nbroken\n{"id": \n')
    with pytest.raises(ValueError, match="line 3"):
        landing.read_harvest_jsonl(spark, str(path), "id string")
    path.write_text("")
    assert landing.read_harvest_jsonl(spark, str(path), "id string").count() == 0
