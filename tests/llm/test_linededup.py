"""Line dedup against the plain rule, by whatever batches, with runs compacted and frequent hashes broadcast or shuffled."""

import hashlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from docketloom.llm import linededup

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def key(line):
    return line.strip(" \t\n\x0b\x0c\r").translate(UPPER)


def plain(texts, least):
    """(n_lines, n_dropped, kept text) of each text by the rule itself."""
    split = [(t or "").split("\n") for t in texts]
    n = Counter(k for ls in split for k in {key(x) for x in ls})
    gone = {k for k, c in n.items() if k and c >= least}
    return [(len(ls), sum(key(x) in gone for x in ls), "\n".join(x for x in ls if key(x) not in gone)) for ls in split]


LINE = st.sampled_from(["", " ", "a", "A ", "\tb\r", "é", "É", "ã©", "Ã©", "É a", "ß", "×", "÷", "漢字", "🙂", "\x85b", "\xa0a", "long " * 20, "c\x00", "C\x00", "ſ", "K", "k"])
TEXTS = st.lists(st.one_of(st.none(), st.lists(LINE, max_size=6).map("\n".join)), min_size=1, max_size=25)


def test_keys_fold_letters_of_ascii_only(spark):
    rows = ["É", "é", "Ã©", "ã©", "×", "÷", "ß", "Þ", "þ", "A", "a", "漢", "🙂", "Ā", "ā", "\xa0A", "A\x85"]
    got = [r.k[0] for r in spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "i int, t string").orderBy("i").select(linededup.keys(linededup.F.col("t")).alias("k")).collect()]
    assert all((a == b) == (key(x) == key(y)) for a, x in zip(got, rows) for b, y in zip(got, rows))


@settings(max_examples=3, deadline=None)
@given(TEXTS)
def test_against_the_rule(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    batches = [docs.filter(f"doc_id % 5 = {k}") for k in range(5)]
    for parts in (None, batches):
        got = {r.doc_id: (r.n_lines, r.n_dropped, r.text or "") for r in linededup.dedup(docs, parts, least=3, fanout=2).collect()}
        assert [got[i] for i in range(len(texts))] == plain(texts, 3)


def test_runs_are_compacted_and_hold_every_document(spark):
    runs = linededup.LineRuns(spark, least=4, fanout=2)
    texts = [f"every\nsome {k % 3}\nown {k}" for k in range(14)]
    for k, t in enumerate(texts):
        runs.add(spark.createDataFrame([(k, t)], "doc_id long, text string"))
        assert all(len(level) < 2 for level in runs.levels)
    assert [len(level) for level in runs.levels] == [0, 1, 1, 1]  # 14 batches = 8 + 4 + 2
    held = runs.runs()
    counts = Counter()
    for run in held:
        for r in run.collect():
            counts[r.h1, r.h2] += r.n
    # "every" needs no counting once a run says 4: batches 5 to 14 leave it out, or count it in runs that hold fewer
    every = spark.createDataFrame([("every",)], "key string").select(*linededup.hashes("key")).first()
    assert 4 <= counts[every.h1, every.h2] < 14 and sorted(n for k, n in counts.items() if k != (every.h1, every.h2))[-3:] == [4, 5, 5]
    plan = linededup.line_counts(spark.createDataFrame([(1, "x")], "doc_id long, text string")).join(held[0].hint("merge"), ["h1", "h2"], "left_anti")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and plan.count("Exchange hashpartitioning") == 1  # the run isn't shuffled
    assert runs.frequent().count() == 4
    assert "Exchange" not in runs._summed(held)._jdf.queryExecution().executedPlan().toString()
    names = [x for level in runs.levels for x in level]
    runs.close()
    assert not any(spark.catalog.tableExists(x) for x in names)


@pytest.mark.parametrize("most", [0, 500_000])
def test_frames(spark, odd_docs, monkeypatch, most):
    monkeypatch.setattr(linededup, "BROADCAST_ROWS", most)
    extra = spark.createDataFrame([(70 + k, f"Same line\n{'x' * k}\n same LINE ", "en", "s", 1, "clash") for k in range(12)] + [(None, "same line\nleft", None, None, None, None)], odd_docs.schema)
    docs = odd_docs.union(extra).withColumn("n_lines", linededup.F.lit("mine")).withColumn("_lines", linededup.F.lit(1))
    texts = [r.text for r in docs.collect()]
    rows = linededup.digest(docs).collect()
    want = sorted((a, b, hashlib.sha256(t.encode()).hexdigest()) for a, b, t in plain(texts, 10))
    assert sorted((r.n_lines, r.n_dropped, r.kept_sha256) for r in rows) == want and sum(r.n_dropped for r in rows) == 25
    made = linededup.dedup(docs)
    assert set(made.columns) == {*docs.columns, "n_dropped"} and dict(made.dtypes)["n_lines"] == "bigint"
    assert linededup.digest(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        linededup.LineRuns(spark, fanout=1)


def test_tables_are_batched_by_files(spark, tmp_path):
    rows = [(k, "common\nline " + str(k % 7)) for k in range(60)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(6).write.parquet(str(tmp_path / "d.parquet"))
    docs = spark.read.parquet(str(tmp_path / "d.parquet"))
    parts = linededup.by_files(docs, 4)
    assert len(parts) == 4 and sorted(r.doc_id for p in parts for r in p.collect()) == list(range(60))
    got = sorted((r.n_dropped, r.n_lines) for r in linededup.digest(docs, batches=4, least=9).collect())
    assert got == sorted((1 + (sum(k % 7 == j % 7 for j in range(60)) >= 9), 2) for k, _ in rows)
