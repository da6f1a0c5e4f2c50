"""Places, ordinals, the best-row walk and the multiset difference against plain versions, hot keys included."""

from collections import Counter, defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docketloom.operators import keys, ordinals, quality


def test_places_of_all_rows_and_within_keys(spark):
    rows = [(k % 7 if k % 3 else None, (k * 37) % 50, k) for k in range(900)]
    df = spark.createDataFrame(rows, "k int, v int, id int").repartition(5)
    want = {r[2]: n for n, r in enumerate(sorted(rows, key=lambda r: (-r[1], r[2])), 1)}
    assert {r.id: r.place for r in ordinals.with_places(df, [F.desc("v"), "id"]).collect()} == want
    groups = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r[1], r[2])):
        groups[r[0]].append(r[2])
    got = {r.id: r.n for r in ordinals.with_places(df, ["v", "id"], ["k"], "n").collect()}
    assert got == {i: n for ids in groups.values() for n, i in enumerate(ids, 1)}
    renamed = ordinals.with_places(df.withColumnsRenamed({"k": "n", "v": "low"}), ["low", "id"], ["n"], "rows")
    assert {r.id: r.rows for r in renamed.collect()} == got
    assert ordinals.with_places(df.limit(0), ["v"]).count() == 0
    clash = df.withColumns({"_part": F.lit(1), "_tie": F.lit(2), "_of": F.lit(3), "_of_0": F.lit(4), "_add": F.lit(5)})
    assert set(ordinals.with_places(clash, ["v"]).columns) == {*clash.columns, "place"}


def test_a_hot_key_of_equal_rows_is_dealt_to_many_parts(spark):
    df = spark.range(0, 40_000, 1, 4).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), F.lit(1).alias("v"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # which would join so few rows again
    try:
        held, part, _ = ordinals.ranges(df, "k", "v")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    sizes = [r["count"] for r in held.groupBy(part).count().collect()]
    assert len(sizes) >= 4 and max(sizes) < 0.5 * sum(sizes)
    assert held.filter("k = -1").select(part).distinct().count() >= 2
    assert ordinals.descents(held, part, "k", "v").count() == 0
    assert ordinals.descents(held.withColumn("k", -F.col("k")), part, "k", "v").count() > 0
    n = ordinals.with_places(df, ["v"], ["k"], "n").filter("k = -1").agg(F.count("*"), F.count_distinct("n"), F.max("n")).first()
    assert n[0] == n[1] == n[2] == 13_334


def walk(rows):
    """The rule of the best row, arrival by arrival."""
    held = None
    for at, a, b in rows:
        if held is None or (a and not held[1]) or (b and not held[2]):
            held = (at, a, b)
    return held


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.sampled_from([None, 1, 2, 3, 4]), st.sampled_from(["", "x"]), st.sampled_from([None, "y"])), min_size=1, max_size=40))
def test_best_row_is_the_walks(spark, arrivals):
    rows = [(k, n, a, b) for n, (k, a, b) in enumerate(arrivals)]
    df = spark.createDataFrame(rows, "k int, at int, e string, p string").repartition(3)
    want = {k: walk([(n, bool(a), bool(b)) for q, n, a, b in rows if q == k]) for k in {r[0] for r in rows}}
    assert {r.k: (r.at, bool(r.e), bool(r.p)) for r in keys.prefer_filled(df, "k", "at", "e", "p").collect()} == want


def test_best_row_of_a_key_of_many_rows(spark):
    n = 1_000_000
    df = spark.range(0, n, 1, 8).select(F.lit(1).alias("k"), F.col("id").alias("at"), F.when(F.col("id") % 5 < 2, "e").otherwise("").alias("e"), F.when(F.col("id") % 5 == 3, "p").otherwise("").alias("p"))
    want = walk([(i, i % 5 < 2, i % 5 == 3) for i in range(n)])
    [r] = keys.prefer_filled(df, "k", "at", "e", "p").collect()
    assert r.at == want[0]
    assert "collect_list" not in keys.prefer_filled(df, "k", "at", "e", "p")._jdf.queryExecution().toString()


VALUE = st.sampled_from([None, "", "a", "b"])
ROWS = st.lists(st.tuples(st.sampled_from([None, "k", "j", "i"]), VALUE, VALUE), max_size=14)


@settings(max_examples=6, deadline=None)
@given(ROWS, ROWS)
def test_replay_is_a_difference_of_multisets(spark, old, new):
    a, b = (spark.createDataFrame(x, "key string, e string, u string") for x in (old, new))
    got = quality.replay(a, b, "key", ["e", "u"]).collect()
    clean = lambda rows: Counter((k, e or "", u or "") for k, e, u in rows)
    mine, theirs = clean(old), clean(new)
    assert Counter((r.key, r.old_e, r.old_u) for r in got if r.old_e is not None) == mine
    assert Counter((r.key, r.new_e, r.new_u) for r in got if r.new_e is not None) == theirs
    unchanged = Counter((r.key, r.old_e, r.old_u) for r in got if r.old_e is not None and (r.old_e, r.old_u) == (r.new_e, r.new_u))
    assert unchanged == mine & theirs
    per_key = lambda c: Counter({k: sum(n for (q, *_), n in c.items() if q == k) for k in {x[0] for x in c}})
    assert Counter(r.key for r in got) == per_key(mine) | per_key(theirs)
    assert all(r.e_bucket == ("same" if (r.old_e or "") == (r.new_e or "") else "filled" if not r.old_e else "emptied" if not r.new_e else "changed") for r in got)


def test_replay_of_a_key_of_many_rows_stays_small(spark):
    old = spark.range(30_000).select(F.lit("k").alias("key"), (F.col("id") % 3).cast("string").alias("v"))
    new = spark.range(20_000).select(F.lit("k").alias("key"), (F.col("id") % 2).cast("string").alias("v"))
    got = {(r.old_v, r.new_v): r["count"] for r in quality.replay(old, new, "key", ["v"]).groupBy("old_v", "new_v").count().collect()}
    assert got == {("0", "0"): 10_000, ("1", "1"): 10_000, ("2", None): 10_000}
