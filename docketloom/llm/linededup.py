"""Line dedup over levelled sorted runs of line hashes, in DataFrame operations alone.

A line's key is the line without white space at its ends, A-Z lower-cased. A run is a table of (h1, h2, n): 128 bits of a
key's hash and the number of documents with that line, bucketed and sorted by the hash, so runs are merged without a shuffle.
:class:`LineRuns` takes documents batch by batch. Each batch's lines are counted (once a document, combined before the shuffle),
merge-anti-joined with the runs for keys that these show to be frequent already, and what is left becomes a run of its own on
the lowest level. When a level holds ``fanout`` runs, they are compacted into one run of the next level, so there are few runs
however many batches came. A key is frequent when its documents over all runs are ``least`` or more; it needs no more counting
once a single run says so, and without that the runs hold every document, so the frequent keys don't depend on the batches.

:func:`without_frequent` drops the frequent lines from documents: (document, place, hash) of each line meets the frequent
hashes, and only the places of dropped lines return to the documents. Lines' texts are never shuffled, documents once.

A run's size is one row for each different line; a line that a third of all documents hold is one row for each task of a
batch before the shuffle. The frequent hashes are broadcast if a count shows that they are at most ``BROADCAST_ROWS``; beyond,
the lines' hashes are shuffled to them, and adaptive execution splits a hot hash.

Defined cases: a null or empty text is one empty line, which stays; empty keys are never frequent. Each row is a document of
its own, also if it repeats an id or another row; rows without an id are documents like all others. An empty table gives an
empty result. Other columns pass through; columns already named ``n_lines`` or ``n_dropped`` are replaced. Two keys with equal
hashes of 128 bits would be taken for one.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import let
from .common import cut, prepare, shared_folder, unused

#: Most rows (16 bytes each) of the frequent hashes that are broadcast.
BROADCAST_ROWS = 500_000
BLANKS = " \t\n\x0b\x0c\r"
HASH = ("h1", "h2")


def lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def keys(text: Column) -> Column:
    """The keys of a text's lines, each byte of them as one character.

    ``lower`` takes the bytes for Latin-1. It changes A-Z and, alike in every text, the first bytes of two-byte characters;
    those of longer characters and all other bytes stay, so different keys stay different and only A-Z are folded.
    """
    folded = F.lower(F.decode(F.coalesce(text, F.lit("")).cast("binary"), "ISO-8859-1"))
    return F.transform(F.split(folded, "\n"), lambda x: F.btrim(x, F.lit(BLANKS)))


def hashes(key: str) -> tuple[Column, Column]:
    """128 bits of a key: two hashes with different seeds."""
    return F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(1), F.col(key)).alias("h2")


def line_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """(h1, h2, n): in how many documents each line stands."""
    found = docs.select(F.explode(F.array_distinct(keys(F.col(text)))).alias("key")).filter("key <> ''")
    return found.select(*hashes("key")).groupBy(*HASH).agg(F.count("*").alias("n"))


class LineRuns:
    """Runs by level, in the shared folder. ``buckets`` is the number of parts of each run (default: the shuffle partitions)."""

    def __init__(self, spark: SparkSession, least: int = 10, fanout: int = 4, buckets: int | None = None, text: str = "text"):
        if least < 1 or fanout < 2:
            raise ValueError("least is 1 or more, fanout 2 or more")
        prepare(spark)
        self.spark, self.least, self.fanout, self.text = spark, least, fanout, text
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = []  # names of runs, by level

    def runs(self) -> list[DataFrame]:
        return [self.spark.table(name) for level in self.levels for name in level]

    def add(self, docs: DataFrame) -> None:
        """One batch: counted, anti-joined with the runs, written as a run; full levels are compacted."""
        fresh = line_counts(docs, self.text)
        for run in self.runs():
            fresh = fresh.join(run.filter(F.col("n") >= self.least).select(*HASH).hint("merge"), list(HASH), "left_anti")
        self._put(0, self._written(fresh))

    def _put(self, level: int, name: str) -> None:
        while True:
            if level == len(self.levels):
                self.levels.append([])
            self.levels[level].append(name)
            if len(self.levels[level]) < self.fanout:
                return
            full = self.levels[level]
            name = self._written(self._summed([self.spark.table(x) for x in full]))
            self.levels[level] = []
            self._removed(full)
            level += 1

    def _summed(self, runs: Sequence[DataFrame]) -> DataFrame:
        """Equal hashes of several runs added up. Equal buckets meet without a shuffle. The filter, which all rows pass, keeps Spark
        4.1 from the union of column batches: that one claims to keep the buckets together and doesn't (the tests would show it)."""
        first, *rest = [run.filter("n > 0") for run in runs]
        for run in rest:
            first = first.union(run)
        return first.groupBy(*HASH).agg(F.sum("n").alias("n"))

    def _written(self, rows: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex}"
        rows.write.bucketBy(self.buckets, *HASH).sortBy(*HASH).option("path", shared_folder(self.spark, name)).saveAsTable(name)
        return name

    def _removed(self, names: Sequence[str]) -> None:
        for name in names:
            place = self._place(name)
            self.spark.sql(f"DROP TABLE {name}")
            place.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(place, True)

    def _place(self, name: str):
        found = self.spark.sql(f"DESCRIBE FORMATTED {name}").filter("col_name = 'Location'").first()
        return self.spark._jvm.org.apache.hadoop.fs.Path(found.data_type)

    def frequent(self) -> DataFrame:
        """(h1, h2) of the keys that are in ``least`` documents or more; written, so it outlives the runs."""
        runs = self.runs()
        none = self.spark.createDataFrame([], "h1 long, h2 long")
        return cut(self._summed(runs).filter(F.col("n") >= self.least).select(*HASH)) if runs else none

    def close(self) -> None:
        """Drop all runs."""
        self._removed([name for level in self.levels for name in level])
        self.levels = []


def without_frequent(docs: DataFrame, frequent: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without the lines whose hashes are in ``frequent``, with n_lines (before) and n_dropped."""
    docs = docs.drop("n_lines", "n_dropped")
    own = unused("lines", docs)
    # Rows with equal texts lose equal lines, so a text's hash says which document a place belongs to.
    digest = lambda seed: F.xxhash64(F.lit(seed), F.col(text))
    marked = docs.withColumn(own, F.struct(digest(1).alias("a"), digest(2).alias("b")))
    places = docs.select(digest(1).alias("a"), digest(2).alias("b"), F.posexplode(keys(F.col(text))).alias("place", "key")).filter("key <> ''")
    places = places.select("a", "b", "place", *hashes("key"))
    met = places.join(F.broadcast(frequent) if frequent.count() <= BROADCAST_ROWS else frequent.hint("merge"), list(HASH))
    gone = met.groupBy("a", "b").agg(F.collect_set("place").alias("gone")).select(F.struct("a", "b").alias(f"{own}_of"), F.col("gone").alias(f"{own}_gone"))
    both = marked.join(gone, F.col(own) == F.col(f"{own}_of"), "left")
    dropped = F.col(f"{own}_gone")
    some = let(lines(F.col(text)), lambda all_lines: F.transform(F.array_except(F.sequence(F.lit(0), F.size(all_lines) - 1), dropped), lambda k: F.get(all_lines, k)))
    sizes = {"n_lines": F.size(lines(F.col(text))).cast("long"), "n_dropped": F.coalesce(F.size(dropped), F.lit(0)).cast("long")}
    made = both.withColumns({**sizes, text: F.when(dropped.isNull(), F.col(text)).otherwise(F.array_join(some, "\n"))})
    return made.drop(own, f"{own}_of", f"{own}_gone")


def by_files(docs: DataFrame, batches: int) -> list[DataFrame]:
    """``docs``, a table's scan, as batches of whole files: Spark lists the files of a batch and reads no others."""
    n = min(batches, len(docs.inputFiles()))
    return [docs] if n < 2 else [docs.filter(F.pmod(F.xxhash64("_metadata.file_path"), F.lit(n)) == k) for k in range(n)]


def dedup(docs: DataFrame, batches: Sequence[DataFrame] | None = None, least: int = 10, fanout: int = 4, text: str = "text") -> DataFrame:
    """``docs`` without the lines that stand in ``least`` documents or more; ``batches`` together are ``docs`` (default: one)."""
    runs = LineRuns(docs.sparkSession, least, fanout, text=text)
    for batch in [docs] if batches is None else batches:
        runs.add(batch)
    frequent = runs.frequent()
    runs.close()
    return without_frequent(docs, frequent, text)


def digest(docs: DataFrame, batches: int = 8, least: int = 10) -> DataFrame:
    """doc_id, n_lines, n_dropped and the digest of what stays, for each document of a table."""
    done = dedup(docs, by_files(docs, batches), least).select("doc_id", "n_lines", "n_dropped", "text")
    return done.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))
