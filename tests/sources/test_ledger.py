"""Attempts, texts and probes: canned failures, broken-off runs, and a walk one by one."""

import random
import shutil

import pytest
from pyspark.sql import functions as F

from docketloom.sources import ledger


class Canned:
    """A host whose answers are files; every request leaves a file."""

    def __init__(self, folder, answers):
        self.folder, self.answers = folder, answers
        folder.mkdir(exist_ok=True)

    def __call__(self, url):
        mark = url.replace("/", "_")
        n = len(list(self.folder.glob(f"{mark}~*")))
        (self.folder / f"{mark}~{n}").write_text("")
        statuses = self.answers[url]
        status = statuses[min(n, len(statuses) - 1)]
        return (status, f"text of {url.rstrip('b')}".encode()) if status == "ok" else (status, None)

    def asked(self):
        return sorted(p.name.split("~")[0].replace("_", "/") for p in self.folder.glob("*"))


ANSWERS = {"https://a/1": ["ok"], "https://a/1b": ["ok"], "https://a/2": ["failed: TimeoutError", "ok"], "https://b/3": ["HTTP 404", "ok"], "https://b/4": ["HTTP 503", "HTTP 503", "ok"], "https://b/5": ["rejected", "rejected"]}


def test_only_failures_are_asked_again(spark, tmp_path):
    host = Canned(tmp_path / "log", ANSWERS)
    urls = spark.createDataFrame([(u,) for u in [*ANSWERS, "https://a/1", None, ""]], "url string")
    got = {r.url: (r.status, bytes(r.content or b""), r.attempts) for r in ledger.Ledger(spark, str(tmp_path / "l"), host, 0).ask(urls).collect()}
    assert got == {"https://a/1": ("ok", b"text of https://a/1", 1), "https://a/1b": ("ok", b"text of https://a/1", 1), "https://a/2": ("ok", b"text of https://a/2", 2), "https://b/3": ("HTTP 404", b"", 1), "https://b/4": ("HTTP 503", b"", 2), "https://b/5": ("rejected", b"", 2)}
    before = host.asked()
    assert len(before) == 9
    again = ledger.Ledger(spark, str(tmp_path / "l"), host, 0)
    assert again.rounds.n == 2 and again.ask(urls).count() == 6 and host.asked() == before
    (tmp_path / "l" / "round=1" / "_SUCCESS").unlink()  # the second round was broken off
    broken = ledger.Ledger(spark, str(tmp_path / "l"), host, 0)
    assert {r.url: r.status for r in broken.ask(urls).collect()}["https://b/4"] == "ok"  # its third answer
    more = ledger.Ledger(spark, str(tmp_path / "l"), host, 0, most=3).ask(urls)
    assert {r.url: r.attempts for r in more.collect()}["https://b/5"] == 3


def test_equal_files_are_read_once_and_never_again(spark, tmp_path):
    log = tmp_path / "read"
    log.mkdir()

    @F.udf("struct<text:string,method:string>")
    def reader(content):
        (log / f"{bytes(content).decode().replace('/', '_')}~{len(list(log.glob('*')))}").write_text("")
        return bytes(content).decode().upper(), "told"

    host = Canned(tmp_path / "log", ANSWERS)
    urls = spark.createDataFrame([(u,) for u in ANSWERS], "url string")
    landed = ledger.Ledger(spark, str(tmp_path / "l"), host, 0).ask(urls)
    for _ in range(2):
        texts = ledger.Texts(spark, str(tmp_path / "t"), lambda c: reader(c), "struct<text:string,method:string>")
        got = {r.url: (r.text, r.method) for r in texts.read(landed).collect()}
        assert got["https://a/1"] == got["https://a/1b"] == ("TEXT OF HTTPS://A/1", "told") and got["https://b/3"] == (None, None) and len(got) == 6
        assert len(list(log.glob("*"))) == 2  # two different files
    more = landed.union(spark.createDataFrame([("https://c/9", "ok", b"new", 1)], landed.schema))
    assert ledger.Texts(spark, str(tmp_path / "t"), lambda c: reader(c), "struct<text:string,method:string>").read(more).count() == 7
    assert len(list(log.glob("*"))) == 3


def walk(known, present, run, ahead):
    """The gaps, and one number after the other above the greatest."""
    top = max(known, default=0)
    asked, empties = [n for n in range(1, top) if n not in known], 0
    for n in range(top + 1, top + ahead + 1):
        asked.append(n)
        empties = 0 if n in present else empties + 1
        if empties == run:
            break
    return asked


@pytest.mark.parametrize("seed", range(3))
def test_probes_ask_what_a_walk_asks(spark, tmp_path, seed):
    rng = random.Random(seed)
    known = {n for n in range(1, 30) if rng.random() < 0.8} if seed else set()
    top = max(known, default=0)
    present = {n for n in range(1, 90) if rng.random() < (0.25, 0.1, 0.7)[seed]}
    log = tmp_path / "asked"
    log.mkdir()

    def ask(numbers):
        def one(n):
            (log / f"{n}~{len(list(log.glob(f'{n}~*')))}").write_text("")
            return n in present

        return numbers.select("number", F.udf(one, "boolean")("number").alias("present"))

    table = spark.createDataFrame([(n,) for n in known], "number long")
    go = lambda: {r.number: r.present for r in ledger.probe(table, ask, str(tmp_path / "p"), run=4, ahead=25).collect()}
    want = walk(known, present, 4, 25)
    assert go() == {n: n in present for n in want}
    assert sorted(int(p.name.split("~")[0]) for p in log.glob("*")) == sorted(want)
    assert go() == {n: n in present for n in want} and len(list(log.glob("*"))) == len(want)
    shutil.rmtree(tmp_path / "p" / "round=1")  # from here on the rounds were lost
    for k in range(2, 30):
        shutil.rmtree(tmp_path / "p" / f"round={k}", ignore_errors=True)
    assert go() == {n: n in present for n in want}
    assert all(len(list(log.glob(f"{n}~*"))) == 1 for n in want if n <= top)


def test_runs_of_empties(spark):
    for present, stop in (([0, 0, 0], 3), ([0, 0, 1, 0, 0, 0, 0], 6), ([1, 0, 0, 1, 0], None), ([], None)):
        rows = spark.createDataFrame([(k, bool(p)) for k, p in enumerate(present, 1)], "number long, present boolean")
        assert [r.stop for r in ledger.run_of_empties(rows, 3).collect()] == ([stop] if stop else [])
