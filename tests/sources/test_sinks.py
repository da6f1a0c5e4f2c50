"""CSV byte for byte as Python's csv writes it, in one file or in ordered parts."""

import csv
import glob
import io

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docketloom.sources import sinks


def plain(columns, rows):
    out = io.StringIO(newline="")
    w = csv.writer(out)
    w.writerow(columns)
    w.writerows([["" if v is None else v for v in r] for r in rows])
    return out.getvalue().encode()


def read(path):
    return b"".join(open(p, "rb").read() for p in sorted(glob.glob(f"{path}/part-*")))


VALUE = st.one_of(st.none(), st.text(alphabet=' ,"\r\n;\'\tabé🙂#\\-', max_size=8))


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(VALUE, VALUE, VALUE), max_size=8), st.booleans())
def test_bytes_are_those_of_the_csv_module(spark, tmp_path_factory, values, single):
    path = str(tmp_path_factory.mktemp("csv") / "out.csv")
    rows = [(k, *v) for k, v in enumerate(values)]
    df = spark.createDataFrame(rows, "n int, a string, `b c` string, d string")
    columns = ["a", "b c", "d", "n"]
    assert sinks.write_csv(df.orderBy("n"), path, columns, single) == len(rows)
    assert read(path) == plain(columns, [(*v, str(k)) for k, v in enumerate(values)])
    back = sinks.read_csv(spark, path)
    feeds = lambda v: (v or "").replace("\r\n", "\n")
    assert back.columns == columns and sorted(tuple(r)[3] for r in back.collect()) == sorted(str(k) for k, _ in enumerate(values))
    if not any("\r" in (x or "") for v in values for x in v):
        assert sorted(tuple(r) for r in back.collect()) == sorted((*map(feeds, v), str(k)) for k, v in enumerate(values))


def test_a_single_column_and_many_ordered_parts(spark, tmp_path):
    one = spark.createDataFrame([("",), ("x",), (None,)], "a string")
    sinks.write_csv(one.coalesce(1), str(tmp_path / "one"), ["a"])
    assert read(tmp_path / "one") == plain(["a"], [("",), ("x",), ("",)])
    n = 5000
    many = spark.range(n).repartition(7).select("id", F.concat(F.lit("v,"), F.col("id").cast("string")).alias("v")).orderBy(F.desc("id"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert sinks.write_csv(many, str(tmp_path / "parts"), ["id", "v"], single=False) == n
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(glob.glob(str(tmp_path / "parts" / "part-*"))) >= 4
    assert read(tmp_path / "parts") == plain(["id", "v"], [(str(k), f"v,{k}") for k in reversed(range(n))])
    assert sinks.read_csv(spark, str(tmp_path / "parts")).count() == n
    assert sinks.write_csv(many, str(tmp_path / "parts"), ["v"]) == n and read(tmp_path / "parts") == plain(["v"], [(f"v,{k}",) for k in reversed(range(n))])
