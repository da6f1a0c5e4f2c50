"""What has been fetched and read so far: a ledger of attempts, a store of texts by their bytes, and probes that know where to stop.

Each is a folder of tables that only grows, one complete table a round, so a run that was broken off, or a later one, asks and reads
only what is open. Every round is written before anything reads it; nothing but counts comes to the driver.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.carry import missing_numbers
from ..written import Files
from .landing import fetch
from .paging import Fetcher, fetch_table


class Rounds:
    """Numbered tables of a folder; one that wasn't finished doesn't count and is written anew."""

    def __init__(self, spark: SparkSession, folder: str, schema: str):
        self.spark, self.folder, self.schema, self.files = spark, folder.rstrip("/"), schema, Files(spark)
        self.n = 0
        while self.files.exists(f"{self.folder}/round={self.n}/_SUCCESS"):
            self.n += 1

    def rows(self) -> DataFrame:
        if not self.n:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*(f"{self.folder}/round={k}" for k in range(self.n)))

    def add(self, df: DataFrame) -> int:
        """Write a round; gives its number of rows."""
        seen = Observation()
        df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(f"{self.folder}/round={self.n}")
        self.n += 1
        return seen.get["n"]


class Ledger:
    """Attempts at addresses. What was got, or refused for good (HTTP 4xx), is never asked again, other failures ``most`` times in all."""

    def __init__(self, spark: SparkSession, folder: str, fetcher: Fetcher = fetch, delay: float = 0.3, most: int = 2):
        self.rounds = Rounds(spark, folder, "url string, status string, content binary, attempt int")
        self.fetcher, self.delay, self.most = fetcher, delay, most

    def best(self) -> DataFrame:
        """A row for each address: url, status and content of its best attempt (one that got it, else the last), and attempts."""
        rank = F.struct((F.col("status") == "ok").alias("got"), "attempt")
        won = self.rounds.rows().groupBy("url").agg(F.max_by(F.struct("status", "content"), rank).alias("_w"), F.max("attempt").alias("attempts"))
        return won.select("url", "_w.status", "_w.content", "attempts")

    def _open(self, urls: DataFrame) -> DataFrame:
        """(url, attempt) of the addresses that are to be asked (again)."""
        so_far = self.rounds.rows().groupBy(F.col("url").alias("_url")).agg(F.max("attempt").alias("_n"), F.max((F.col("status") == "ok") | F.col("status").startswith("HTTP 4")).alias("_done"))
        both = urls.select("url").filter("url is not null and url <> ''").distinct().join(so_far, F.col("url") == F.col("_url"), "left")
        return both.filter(F.col("_url").isNull() | (~F.col("_done") & (F.col("_n") < self.most))).select("url", (F.coalesce("_n", F.lit(0)) + 1).cast("int").alias("attempt"))

    def ask(self, urls: DataFrame) -> DataFrame:
        """The best attempts at ``urls`` (url) after whatever is open among them has been asked; a failure is a row with its status."""
        while True:
            todo = self._open(urls)
            if todo.isEmpty():
                break
            got = fetch_table(todo, self.fetcher, self.delay)
            self.rounds.add(got.join(todo.withColumnRenamed("url", "_url"), F.col("url") == F.col("_url")).select("url", "status", "content", "attempt"))
        return self.best().join(urls.select("url").distinct(), "url", "left_semi")


class Texts:
    """Documents' texts by the SHA-256 of their bytes: equal files are read once, and never by a later run. ``reader`` gives a struct
    (of the type ``kind``) for a column of bytes."""

    def __init__(self, spark: SparkSession, folder: str, reader: Callable[[Column], Column], kind: str):
        self.rounds, self.reader = Rounds(spark, folder, f"digest string, r {kind}"), reader

    def read(self, landed: DataFrame) -> DataFrame:
        """``landed`` (url, status, content, …) without its content, with the fields of what was read of it; null for what wasn't got."""
        told = landed.withColumn("digest", F.when((F.col("status") == "ok") & F.col("content").isNotNull(), F.sha2("content", 256)))
        new = told.filter("digest is not null").groupBy("digest").agg(F.first("content").alias("content")).join(self.rounds.rows(), "digest", "left_anti")
        if not new.isEmpty():
            self.rounds.add(new.select("digest", self.reader(F.col("content")).alias("r")))
        have = self.rounds.rows().dropDuplicates(["digest"])
        return told.drop("content").join(have, "digest", "left").select(*(c for c in told.columns if c not in ("content", "digest")), "digest", "r.*")


def run_of_empties(asked: DataFrame, run: int) -> DataFrame:
    """(stop): the number at which the first run of ``run`` neighbouring numbers without a result is full; no row where there is none.

    Islands by differences: in a run, number minus place stays the same. ``asked`` has number and present."""
    empty = asked.filter("not present").withColumn("_island", F.col("number") - F.row_number().over(Window.orderBy("number")))
    full = empty.groupBy("_island").agg(F.min("number").alias("low"), F.count("*").alias("n")).filter(F.col("n") >= run)
    return full.agg(F.min(F.col("low") + run - 1).alias("stop")).filter("stop is not null")


def probe(known: DataFrame, ask: Callable[[DataFrame], DataFrame], folder: str, run: int = 10, ahead: int = 50) -> DataFrame:
    """(number, present) of all numbers asked: the gaps below the greatest of ``known`` (number), then those above it until ``run`` on
    end are empty or ``ahead`` have been asked. ``ask`` takes numbers and gives (number, present).

    Above, as many are asked at once as must be asked in any case: a run can't be full sooner. So nothing is asked that a walk one by
    one wouldn't ask, and a probe that was broken off asks nothing twice. The numbers above are ``ahead`` at most, in one task."""
    rounds = Rounds(known.sparkSession, folder, "number long, present boolean, above boolean, top long")
    if not rounds.n:
        top = known.agg(F.max("number")).first()[0] or 0
        gaps = missing_numbers(known.select(F.col("number").cast("long").alias("number")), "number")
        rounds.add(ask(gaps).select("number", "present", F.lit(False).alias("above"), F.lit(top).cast("long").alias("top")).union(known.sparkSession.createDataFrame([(None, None, None, top)], rounds.schema)))
    top = rounds.rows().agg(F.max("top")).first()[0]
    while True:
        above = rounds.rows().filter("above")
        last = above.agg(F.max("number")).first()[0] or top
        if last >= top + ahead or run_of_empties(above, run).first():
            break
        hit = above.filter("present").agg(F.max("number")).first()[0] or top
        upto = min(top + ahead, hit + run)
        rounds.add(ask(known.sparkSession.range(last + 1, upto + 1).withColumnRenamed("id", "number")).select("number", "present", F.lit(True).alias("above"), F.lit(top).cast("long").alias("top")))
    return rounds.rows().filter("number is not null").select("number", "present")
