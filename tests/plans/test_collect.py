"""Collecting end to end on canned hosts: fetched, landed, built, guarded, published; a second run asks nothing."""

import csv
import glob
import json
import re

import pytest

from docketloom import cli
from docketloom.operators.quality import GuardError
from docketloom.plans import collect, dataset


def record(k):
    return {"pointer": str(k), "title": f"UP-{k}-17", "subjec": f"AFSCME Local {k} v. Marion County", "type": "ULP", "date": "2020-01-01"}


def post(k):
    return {"id": k, "date": "2020-01-01T00:00:00", "slug": f"decision-{k}", "link": f"https://perb.ca.gov/decision/{k}/", "title": {"rendered": f"{k}M"}, "content": {"rendered": "<p>x</p>"}}


def entry(k):
    return f'<viewentry position="1.{k}" unid="U{k}"><entrydata columnnumber="2" name="$17"><text>[&lt;a href="/x/{k}.pdf?OpenElement"&gt;PERC 2020-{k}&lt;/a&gt;]</text></entrydata></viewentry>'


def answer(url):
    """The canned web: what each address gives, or None."""
    if "contentdm" in url:
        start = int(re.search(r"/200/(\d+)/1/", url)[1])
        return json.dumps({"pager": {"total": 450}, "records": [record(k) for k in range(start, min(start + 200, 451))]})
    if "perb.ca.gov" in url:
        page = int(re.search(r"[?&]page=(\d+)", url)[1])
        return json.dumps([post(k) for k in range(page * 100, page * 100 + (100 if page < 3 else 7))])
    if "state.nj.us" in url:
        start = int(re.search(r"Start=(?:1\.)?(\d+)", url)[1])
        return "<viewentries>" + "".join(entry(k) for k in range(start, min(start + 3, 8))) + "</viewentries>"
    if "eab.iowa.gov" in url:
        path, page = re.fullmatch(r"https://eab.iowa.gov/([a-z0-9-]+)(?:\?page=(\d+))?", url).groups()
        n, base = (45 if path == "cities" else 1), sum(map(ord, path)) * 100
        at = int(page or 0) * 20
        return f"Displaying {at + 1} - {min(n, at + 20)} of {n} results" + "".join(f'<a href="/media/{base + k}/download"><h2>Town {k} County</h2></a>' for k in range(at, min(n, at + 20)))
    if "myflorida" in url:
        if m := re.search(r"File=(\d+)", url):
            return "no pdf" if int(m[1]) % 2 else None
        if m := re.search(r"CertNo=(\d+)", url):
            numbers = [int(m[1])] if int(m[1]) in (7, 1603) else []
        else:
            numbers = [k for k in range(1, 1601) if k != 7 and k != 9 and k % 3 == (0 if "Union=a" in url else 1 if "Employer=a" in url else 2)]
        row = '<tr><td>{0}</td><td>PBA {0}</td><td>City of X</td><td>{1}</td></tr>'
        return '<table id="gridCases">' + "".join(row.format(k, f'<a href="/f.aspx?File={k}">d</a>' if k < 12 else "") for k in numbers) + "</table>"
    if url == collect.DE_INDEX:
        return '<a href="/decisions/2026/">2026</a>'
    if url == "https://perb.delaware.gov/decisions/2026/":
        return '<a href="/f/1546-ULP.pdf">View decision 2026 ULP 1546 Order of Dismissal</a>'
    if url == collect.PAGES["md-perb-election-certs"]:
        return 'Displaying 1 - 1 of 1 results<article class="maryland-listing-item__container"><a class="maryland-listing-item__title" href="/media/9"><span class="maryland-link__document-title">Town College - AFT</span></a></article>'
    return None


class Host:
    """Answers, and a file for each request."""

    def __init__(self, folder):
        self.folder = folder
        folder.mkdir()

    def __call__(self, url):
        found = answer(url)
        n = len(list(self.folder.glob("*")))
        (self.folder / f"{n:06d}-{abs(hash(url)) % 10**9}").write_text(url)
        return ("ok", found.encode()) if found is not None else ("HTTP 404", None)

    def asked(self):
        return sorted(p.read_text() for p in self.folder.glob("*"))


def table(path):
    with open(glob.glob(f"{path}/part-*")[0], newline="", encoding="utf-8") as f:
        return list(csv.DictReader(f))


CASES = {"or-erb-contentdm-orders": (450, 3), "ca-perb-decisions": (207, 3), "nj-perc-issued-decisions": (7, 4), "ia-eab-unit-certifications": (50, 8), "md-perb-election-certs": (1, 1), "de-perb-decisions": (1, 3)}


@pytest.mark.parametrize("slug", CASES)
def test_collected_and_published(spark, tmp_path, slug):
    rows, requests = CASES[slug]
    host = Host(tmp_path / "log")
    args = [slug, "--collect", "--out", str(tmp_path / "out"), "--as-of", "2026-09-30"]
    assert cli.main(args, host, 0) == 0
    target = tmp_path / "out" / dataset.get(slug).csv_name
    made = table(target)
    assert len(made) == rows and len({r["row_key"] for r in made}) == rows and list(made[0]) == list(dataset.get(slug).columns)
    asked = host.asked()
    assert len(asked) == len(set(asked)) == requests, asked
    assert cli.main(args, host, 0) == 0 and host.asked() == asked


def test_florida_fills_gaps_and_probes(spark, tmp_path):
    host = Host(tmp_path / "log")
    args = ["fl-perc-certifications", "--collect", "--out", str(tmp_path / "out"), "--as-of", "2026-09-30"]
    assert cli.main(args, host, 0) == 0
    asked = host.asked()
    numbers = sorted(int(u.split("CertNo=")[1]) for u in asked if "CertNo=" in u)
    assert numbers == [7, 9, *range(1601, 1614)]  # the gaps; then 1603 is there and ten on end aren't
    made = {r["certification_number"]: r for r in table(tmp_path / "out" / "fl_perc_certifications.csv")}
    assert len(made) == 1600 and "1603" in made and "7" in made and "9" not in made
    assert {made[str(k)]["pdf_fetch_status"] for k in (1, 3, 5)} == {"unreadable_bytes"} and {made[str(k)]["pdf_fetch_status"] for k in (2, 4)} == {"fetch_failed"}
    assert cli.main(args, host, 0) == 0 and host.asked() == asked


def test_what_cannot_be_collected(spark, tmp_path, capsys):
    assert cli.main(["ks-peera-unit-rosters", "--collect", "--out", str(tmp_path)], answer, 0) == 2 and "can't be collected" in capsys.readouterr().err
    with pytest.raises(GuardError, match="HTTP 404"):
        cli.main(["wa-perc-certifications", "--collect", "--out", str(tmp_path)], Host(tmp_path / "log"), 0)
    with pytest.raises(GuardError, match="no year"):
        cli.main(["pa-plrb-final-orders", "--collect", "--out", str(tmp_path)], Host(tmp_path / "log2"), 0)
