"""Keys, carries, guards, sinks, landing, streaming, command line."""

import csv
import glob
import json
import tempfile

import pytest
from pyspark.sql import functions as F

from docketloom import cli
from docketloom.operators import carry, keys, quality, rules
from docketloom.plans import roundtrip
from docketloom.schema import CORE, across_agencies, flag, to_wide
from docketloom.sources import landing, sinks, tables
from docketloom.streaming import ingest


def as_csv(folder):
    with open(glob.glob(str(folder / "part-*"))[0], newline="", encoding="utf-8") as f:
        return list(csv.reader(f))


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_rules(spark):
    df = spark.createDataFrame([("rc",), ("ULP ",), ("zz",), (None,)], "c string")
    got = df.select(rules.canonical_case_type("c", {"RC": "RECOGNITION"}).alias("t"), rules.first_match("c", [("u|U", "x"), ("U", "y")], "z").alias("f")).collect()
    assert [tuple(r) for r in got] == [("RECOGNITION", "z"), ("ULP", "x"), ("ZZ", "z"), ("", "z")]
    assert rows(df.filter("c = 'rc'").select(rules.matched_rule([("a", F.lit(False)), ("b", F.col("c") == "rc")]))) == [("b",)]


def test_keys(spark):
    df = spark.createDataFrame([("k", 2, "b"), ("k", 1, "a"), ("j", 3, None)], "k string, at int, v string")
    assert rows(keys.first_wins(df, ["k"], ["at"]).select("k", "at", "v")) == [("j", 3, None), ("k", 1, "a")]
    assert rows(keys.with_ordinals(df, "k", ["at"]).select("at", "row_key")) == [(1, "k"), (2, "k:2"), (3, "j")]
    assert len(spark.range(1).select(keys.capped_key(F.repeat(F.lit("x"), 300)).alias("k")).first().k) == 124
    # the fold may trade the preferred column away again, in order of arrival
    fold = spark.createDataFrame([(1, 1, "", ""), (1, 2, "e", ""), (1, 3, "", "p"), (1, 4, "f", ""), (2, 9, "", "")], "k int, at int, e string, p string")
    assert rows(keys.prefer_filled(fold, "k", "at", "e", "p").select("k", "at")) == [(1, 4), (2, 9)]


def test_carries(spark):
    df = spark.createDataFrame([("d", 1, "S", "a"), ("d", 2, None, ""), ("d", 3, "T", " "), ("e", 1, None, "")], "doc string, pos int, s string, cell string")
    assert rows(carry.carry_forward(df, {"s": F.col("s")}, ["doc"]).select("doc", "pos", "s")) == [("d", 1, "S"), ("d", 2, "S"), ("d", 3, "T"), ("e", 1, None)]
    assert [r.cell for r in carry.fill_continuations(df, ["cell"], F.col("s") == "T", ["doc"]).orderBy("doc", "pos").collect()] == ["a", "a", "", ""]
    assert [r.id for r in carry.missing_numbers(spark.createDataFrame([(2,), (4,)], "id long"), "id").orderBy("id").collect()] == [1, 3]
    assert carry.missing_numbers(spark.createDataFrame([], "id long"), "id").count() == 0


def test_fills_sort_once(spark):
    made = [("d", k, k % 7 == 3, ["", " ", None, f"v{k}"][k * k % 11 % 4]) for k in range(80)]
    df = spark.createDataFrame(made, "doc string, pos int, edge boolean, cell string")
    filled, above = carry.fill_continuations(df, ["cell"], F.col("edge"), ["doc"]), ""
    got = [r.cell for r in filled.orderBy("pos").collect()]
    for (_, _, edge, cell), seen in zip(made, got, strict=True):
        above = (cell or "").strip() or ("" if edge else above)
        assert seen == above
    assert filled._jdf.queryExecution().sparkPlan().toString().count("Window ") == 1
    folder = tempfile.mkdtemp()
    spark.createDataFrame([(k // 5, k % 5 + 1, k) for k in range(50)], "l_orderkey long, l_linenumber int, l_partkey long").write.parquet(f"{folder}/lineitem.parquet")
    query = roundtrip.continuation_rows(spark, folder)
    assert query._jdf.queryExecution().executedPlan().toString().count("Sort [") == 1
    assert all(r.case_cell == str(r.l_orderkey) for r in query.collect())


def test_guards(spark):
    df = spark.createDataFrame([("a", "ok"), ("a", "no")], "row_key string, s string")
    with pytest.raises(quality.GuardError, match="repeated"):
        quality.require(df, "x", unique="row_key")
    with pytest.raises(quality.GuardError, match="at least"):
        quality.require(df.limit(0), "x")
    with pytest.raises(quality.GuardError, match="states"):
        quality.require(df, "x", expected=3)
    many = spark.range(100).withColumn("s", F.when(F.col("id") < 7, "no"))
    with pytest.raises(quality.GuardError, match="failed"):
        quality.require(many, "x", failures=F.col("s") == "no")
    assert quality.require(df, "x", expected=3, slack=1) is df and quality.require(df, "x", expected=2, ratio=0.95) is df


def test_wide_and_sinks(spark, tmp_path):
    df = spark.createDataFrame([('q"x', None, "a,b"), ("", "é", "line\nfeed")], "b string, a string, extra string")
    wide = to_wide(df, ("a", "b", "c"))
    assert rows(wide) == [("", 'q"x', ""), ("é", "", "")]
    assert sinks.write_csv(df, str(tmp_path / "w"), ("extra", "b", "a")) == 2
    assert as_csv(tmp_path / "w") == [["extra", "b", "a"], ["a,b", 'q"x', ""], ["line\nfeed", "", "é"]]
    assert sinks.write_jsonl(df, str(tmp_path / "j"), ("a", "c")) == 2
    [part] = glob.glob(str(tmp_path / "j" / "*.json"))
    assert sorted((json.loads(x) for x in open(part, encoding="utf-8")), key=str) == [{"a": "", "c": ""}, {"a": "é", "c": ""}]
    assert rows(spark.createDataFrame([(True,), (False,), (None,)], "x boolean").select(flag(F.col("x")))) == [("",), ("false",), ("true",)]
    assert across_agencies([df, df.withColumn("row_key", F.lit("k"))]).columns == list(CORE)


def test_replay(spark, tmp_path):
    old = spark.createDataFrame([("1", "a", ""), ("2", "b", "u"), ("3", "c", "u")], "row_key string, e string, u string")
    new = spark.createDataFrame([("1", "a", "x"), ("2", "z", ""), ("4", "d", "")], "row_key string, e string, u string")
    both = quality.replay(old, new, "row_key", ["e", "u"])
    got = {r.row_key: (r.e_bucket, r.u_bucket) for r in both.collect()}
    assert got == {"1": ("same", "filled"), "2": ("changed", "emptied"), "3": ("emptied", "emptied"), "4": ("filled", "same")}
    assert sinks.write_diff(both, str(tmp_path / "d"), ["e", "u"]) == 4


def test_tables(spark):
    pages = spark.createDataFrame([("u", "<a href='x.pdf'>A &amp; <b>B</b></a><a href=\"y#f\">C</a><table><tr><td>1<td></tr><tr><td>a</td><td><a href='z'>b</a></td></tr></table>")], "url string, html string")
    assert [(r.pos, r.href, r.label) for r in tables.link_rows(pages).orderBy("pos").collect()] == [(0, "x.pdf", "A & B"), (1, "y#f", "C"), (2, "z", "b")]
    assert [(r.cells, r.first_href) for r in tables.table_rows(pages, least=2).collect()] == [(["a", "b"], "z")]
    assert rows(tables.discover(pages.withColumn("url", F.lit("https://h/")), "pdf$|y", "url").select("url")) == [("https://h/x.pdf",), ("https://h/y",)]
    assert spark.range(1).select(tables.page_offsets(F.lit(41), 20).alias("p")).first().p == [0, 1, 2]


def test_landing(spark, tmp_path):
    got = landing.fetched(spark, ["http://127.0.0.1:9/a", "http://127.0.0.1:9/b", "nonsense"], delay=0, timeout=1).collect()
    assert len(got) == 3 and all(r.status.startswith("failed") and r.content is None for r in got)
    waits = []
    assert landing.fetch("http://127.0.0.1:9/", timeout=1, attempts=3, sleep=waits.append)[0].startswith("failed") and waits == [5, 20]
    assert landing.rejected(b"<html>Request Rejected</html>") and not landing.rejected(b"x" * 5000)
    (tmp_path / "h.tsv").write_text("id\ttitle\n1\tx\n")
    with pytest.raises(ValueError, match="lacks"):
        landing.read_harvest_tsv(spark, str(tmp_path / "h.tsv"), ("id", "union"))
    (tmp_path / "f.bin").write_bytes(b"ok \xff")
    assert landing.as_pages(landing.read_files(spark, str(tmp_path / "f.bin"))).first().html == "ok �"
    seen = spark.createDataFrame([(1,), (3,)], "n long")
    assert sorted(r.n for r in landing.missing_and_next(seen, "n", 2).collect()) == [2, 4, 5]


def test_streaming(spark, tmp_path):
    for k, at in enumerate(("2026-01-01T00:00:00", "2026-01-01T00:10:00")):
        (tmp_path / f"{k}.json").write_text("".join(json.dumps({"url": u, "status": "ok", "html": "x", "landed_at": at}) + "\n" for u in ("a", "b")))
    q = ingest.once(ingest.landing(spark, str(tmp_path), 1)).writeStream.format("memory").queryName("landed").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert sorted(r.url for r in spark.table("landed").collect()) == ["a", "b"]
    q = ingest.outcomes(ingest.landing(spark, str(tmp_path), 1)).writeStream.format("memory").queryName("counted").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert [r.n for r in spark.table("counted").collect()] == [4]


def test_command_line(spark, tmp_path, capsys):
    assert cli.main(["--list"]) == 0 and "wa-perc-certifications" in capsys.readouterr().out
    assert cli.main([]) == 1 and cli.main(["nothing-here"]) == 2
    (tmp_path / "nh.tsv").write_text("id\ttitle\tdate_posted\tunion\tpdf_url\tpdf_filename\n7\tDover Police AFSCME\t2020\tAFSCME\t\tf.pdf\n")
    assert cli.main(["NH_PELRB_certifications", "--harvest", str(tmp_path / "nh.tsv"), "--out", str(tmp_path)]) == 0
    assert sinks.read_csv(spark, str(tmp_path / "nh_pelrb_certifications.csv")).first().employer_name == "Dover Police"
    with pytest.raises(quality.GuardError):
        cli.main(["wa-perc-certifications", "--landing", str(tmp_path), "--out", str(tmp_path)])
