"""Publishing: each guard fires and leaves the old output as it was; a good run replaces it; nothing is left beside it."""

import glob
import json
import os

import pytest

from docketloom.operators.quality import GuardError
from docketloom.plans import dataset, feeds, listings  # noqa: F401  (registers the datasets)
from docketloom.sources import publish
from docketloom.written import beside

from .helpers import AS_OF, SCRAPED


def card(media):
    return f'<article class="maryland-listing-item__container"><a class="maryland-listing-item__title" href="/media/{media}"><span class="maryland-link__document-title">Town {media} College - AFT</span></a></article>'


def maryland(total, *media):
    return {"pages": [("https://www.maryland.gov/", f"Displaying 1 - {len(media)} of {total} results" + "".join(map(card, media)))]}


def florida(n, read):
    row = '<tr><td>{0}</td><td>PBA {0}</td><td>City of X</td><td><a href="/f.aspx?File={0}.pdf">d</a></td></tr>'
    grid = [("https://perc.myflorida.com/r", p, f'<table id="gridCases">{"".join(row.format(k) for k in range(p * 100, min(n, p * 100 + 100)))}</table>') for p in range(-(-n // 100))]
    return {"pages": grid, "dossiers": [(f"https://perc.myflorida.com/f.aspx?File={k}.pdf", "ORDER AND CERTIFICATION\nJune 1, 1992", "text", True, "", False, 50) for k in range(read)]}


def columbia(n, read):
    row = "<tr><td>12-RC-{0}</td><td>1/1/12</td><td>165</td><td>RC</td><td>FOP,</td><td>Department</td><td>59 DCR</td><td>Cert</td><td><a href='/f?fileid={{12345678-1234-1234-1234-123456789abc}}{0}'>x</a></td></tr>".replace("'", '"')
    return {"pages": [("https://casesearch.perb.dc.gov/", "".join(row.format(k) for k in range(n)))], "documents": [(f"https://casesearch.perb.dc.gov/f?fileid={{12345678-1234-1234-1234-123456789abc}}{k}", "text", "ocr") for k in range(read)]}


def oregon(total, n):
    records = [{"pointer": str(k), "title": "UP-1-17", "subjec": "A v. B", "type": "ULP", "date": "2020-01-01"} for k in range(n)]
    return {"pages": [(0, json.dumps({"pager": {"total": total}, "records": records}))]}


def iowa(total, n):
    items = "".join(f'<a href="/media/{k}/download"><h2>Town {k} County</h2></a>' for k in range(n))
    return {"pages": [("https://eab.iowa.gov/cities", "cities", f"Displaying 1 - {n} of {total} results{items}")]}


def put(spark, slug, target, given, **more):
    spec = dataset.get(slug)
    frames = {name: spark.createDataFrame(given.get(name, []), schema) for name, schema in spec.inputs.items()}
    return spec.publish(frames, target, SCRAPED, AS_OF, **more)


def content(folder):
    return {os.path.basename(p): open(p, "rb").read() for p in glob.glob(f"{folder}/part-*")}


CASES = {
    "md-perb-election-certs": (maryland(3, "1", "2", "412"), 2, [(maryland(4, "1", "2", "412"), "states"), (maryland(2, "1"), "states"), (maryland(0), "at least")]),
    "fl-perc-certifications": (florida(1500, 1430), 1500, [(florida(1499, 1499), "at least 1500"), (florida(1500, 1424), "76 of 1500 documents failed")]),
    "dc-perb-certifications": (columbia(20, 15), 20, [(columbia(20, 14), "6 of 20 documents failed"), (columbia(0, 1), "at least")]),
    "or-erb-contentdm-orders": (oregon(100, 95), 95, [(oregon(100, 94), "states 100")]),
    "ia-eab-unit-certifications": (iowa(10, 8), 8, [(iowa(10, 7), "states 10"), (iowa(200, 205), "states 200")]),
}


@pytest.mark.parametrize("slug", CASES)
def test_guards_leave_the_old_output(spark, tmp_path, slug):
    good, n, bad = CASES[slug]
    target = str(tmp_path / "out" / "data.csv")
    for given, why in bad[:1]:
        with pytest.raises(GuardError, match=why):
            put(spark, slug, target, given)
        assert not os.path.exists(target)
    assert put(spark, slug, target, good) == n
    before = content(target)
    assert sum(len(x) for x in before.values()) > 100
    for given, why in bad:
        with pytest.raises(GuardError, match=why):
            put(spark, slug, target, given)
        assert content(target) == before
    assert os.listdir(tmp_path / "out") == ["data.csv"]
    assert put(spark, slug, target, good, single=False, staging=str(tmp_path / "staging")) == n
    assert b"".join(v for _, v in sorted(content(target).items())) == b"".join(v for _, v in sorted(before.items()))
    assert os.listdir(tmp_path / "out") == ["data.csv"] and os.listdir(tmp_path / "staging") == []


def test_documents_that_were_not_landed_are_no_failures(spark, tmp_path):
    assert put(spark, "dc-perb-certifications", str(tmp_path / "x.csv"), columbia(20, 0)) == 20


def test_broken_publishes(spark, tmp_path):
    target = str(tmp_path / "t")

    def write(text, fail=False):
        def run(path):
            os.makedirs(path)
            with open(f"{path}/part-0", "w") as f:
                f.write(text)
            if fail:
                raise RuntimeError("broken")
            return 1

        return run

    assert publish.published(spark, target, write("a")) == 1
    with pytest.raises(RuntimeError):
        publish.published(spark, target, write("b", fail=True))
    assert content(target) == {"part-0": b"a"} and os.listdir(tmp_path) == ["t"]
    os.rename(target, beside(target, "old"))  # killed between the renames
    os.makedirs(beside(target, "new"))
    publish.recovered(spark, target)
    assert content(target) == {"part-0": b"a"} and os.listdir(tmp_path) == ["t"]
    assert publish.published(spark, target, write("c")) == 1 and content(target) == {"part-0": b"c"}
    before = os.listdir(tmp_path)
    with pytest.raises(ZeroDivisionError), publish.staged(spark.range(5), target, {"n": dataset.F.count(dataset.F.lit(1)), "odd": dataset.F.count_if(dataset.F.col("id") % 2 == 1)}) as (rows, seen):
        assert rows.count() == 5 and seen == {"n": 5, "odd": 2}
        raise ZeroDivisionError
    assert os.listdir(tmp_path) == before
