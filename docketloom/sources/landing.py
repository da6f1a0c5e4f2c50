"""Landing: documents fetched politely into a table, and landed files read back.

Fetching is the only part that talks to a host. It is a Python data source with one partition for each host, so the delay between
requests is kept per host however many executors there are; a failed fetch is a row with its status, never a failed task. Land the
result (``write.parquet``) before parsing it: whatever reads it twice must not fetch twice.
"""

from __future__ import annotations

import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator
from urllib.parse import urlsplit

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

AGENT = "Mozilla/5.0 (compatible; docketloom/0.1)"
#: What hosts want that turn away unknown clients.
BROWSER = {
    "User-Agent": "Mozilla/5.0 (X11; Linux x86_64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/126.0 Safari/537.36",
    "Accept": "text/html,application/xhtml+xml,application/pdf,application/xml;q=0.9,*/*;q=0.8",
    "Accept-Language": "en-US,en;q=0.9",
}
SCHEMA = "url string, status string, content binary"


def rejected(content: bytes) -> bool:
    """A small page with a good status that says the request was rejected."""
    return len(content) < 4096 and b"request rejected" in content[:2048].lower()


def fetch(url: str, timeout: float = 120, browser: bool = False, attempts: int = 1, waits: tuple[float, ...] = (5, 20, 60), sleep: Callable[[float], None] = time.sleep) -> tuple[str, bytes | None]:
    """(status, content): ok, rejected, HTTP code or failed. Only timeouts and lost connections are tried again, after ``waits``."""
    status: str = "failed"
    for k in range(max(1, attempts)):
        if k:
            sleep(waits[min(k, len(waits)) - 1])
        try:
            request = urllib.request.Request(url, headers=BROWSER if browser else {"User-Agent": AGENT})
            with urllib.request.urlopen(request, timeout=timeout) as answer:
                content = answer.read()
            return ("rejected", None) if browser and rejected(content) else ("ok", content)
        except urllib.error.HTTPError as e:
            return f"HTTP {e.code}", None
        except (urllib.error.URLError, TimeoutError, ConnectionError, ValueError) as e:
            status = f"failed: {type(e).__name__}"
    return status, None


class _Host(InputPartition):
    def __init__(self, urls: list[str]):
        self.urls = urls


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.urls = [u for u in options.get("urls", "").split("\n") if u]
        self.delay, self.timeout = float(options.get("delay", 0.3)), float(options.get("timeout", 120))
        self.browser, self.attempts = options.get("browser", "false") == "true", int(options.get("attempts", 1))

    def partitions(self) -> list[InputPartition]:
        hosts: dict[str, list[str]] = {}
        for u in dict.fromkeys(self.urls):
            hosts.setdefault(urlsplit(u).netloc, []).append(u)
        return [_Host(urls) for urls in hosts.values()] or [_Host([])]

    def read(self, partition: _Host) -> Iterator[tuple]:
        for k, url in enumerate(partition.urls):
            if k:
                time.sleep(self.delay)
            yield (url, *fetch(url, self.timeout, self.browser, self.attempts))


class PoliteHttp(DataSource):
    """format("polite_http"): options urls (one a line), delay, timeout, browser, attempts."""

    @classmethod
    def name(cls) -> str:
        return "polite_http"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)


def fetched(spark: SparkSession, urls: list[str], **options) -> DataFrame:
    """A row for each URL: url, status, content."""
    spark.dataSource.register(PoliteHttp)
    return spark.read.format("polite_http").options(urls="\n".join(urls), **{k: str(v).lower() for k, v in options.items()}).load()


def as_pages(landed: DataFrame) -> DataFrame:
    """Landed content as text (url, html), undecodable bytes replaced; only what was fetched."""
    return landed.filter("status = 'ok'").select("url", decoded(F.col("content")).alias("html"))


def decoded(content: Column) -> Column:
    return F.make_valid_utf8(content.cast("string"))


def as_documents(landed: DataFrame) -> DataFrame:
    """Landed documents as (url, text, method); what wasn't fetched says so."""
    from ..functions.documents import document_text

    read = landed.withColumn("_d", document_text("content"))
    good = F.col("status") == "ok"
    return read.select("url", F.when(good, F.col("_d.text")).otherwise(F.lit("")).alias("text"), F.when(good, F.col("_d.method")).otherwise(F.lit("fetch_failed")).alias("method"))


def missing_and_next(df: DataFrame, column: str, beyond: int = 50) -> DataFrame:
    """Numbers worth asking for: the gaps below the greatest, and ``beyond`` above it."""
    from ..operators.carry import missing_numbers

    top = df.agg(F.max(column)).first()[0] or 0
    return missing_numbers(df, column).union(df.sparkSession.range(top + 1, top + beyond + 1))


def read_harvest_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A JSON-lines harvest with ``line``, the number of a row's line; blank lines are passed over. A broken line fails the read
    and is named by its number. Lines are numbered from the sizes of the file's parts, one number each on the driver."""
    lines = spark.read.text(path).select("value", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("at"))
    before, starts = 0, []
    for part, n in sorted((r.part, r["count"]) for r in lines.groupBy("part").count().collect()):
        starts += [F.lit(part), F.lit(before)]
        before += n
    first = F.element_at(F.create_map(*starts), F.col("part")) if starts else F.lit(0)
    parsed = F.from_json("value", f"{schema}, _broken string", {"columnNameOfCorruptRecord": "_broken"})
    rows = lines.filter("trim(value) <> ''").select(parsed.alias("r"), (F.col("at") + first + 1).cast("long").alias("_line"))
    broken = rows.filter("r._broken is not null or r is null").agg(F.min("_line")).first()[0]
    if broken is not None:
        raise ValueError(f"harvest {path}: line {broken} is no JSON object")
    return rows.select("r.*", "_line").drop("_broken", *(["line"] if "line" in schema.replace(",", " ").split() else [])).withColumnRenamed("_line", "line")


def read_harvest_tsv(spark: SparkSession, path: str, required: tuple[str, ...]) -> DataFrame:
    """A TSV harvest with a header; missing columns fail the read."""
    made = spark.read.option("sep", "\t").option("header", True).option("multiLine", True).csv(path)
    if lost := sorted(set(required) - set(made.columns)):
        raise ValueError(f"harvest {path} lacks columns {lost}")
    return made


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """Landed files as (url, status, content)."""
    return spark.read.format("binaryFile").load(path).select(F.col("path").alias("url"), F.lit("ok").alias("status"), "content")
