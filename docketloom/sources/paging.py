"""Sources that are asked page after page, and tables of addresses that are fetched host by host.

A :class:`Source` says where its first page is and, from each answer, which page comes next; the rules below cover offsets, page
numbers, cursors, stated totals and numbers that are probed until a run of empty answers. What comes next depends on what came
before, so a source is walked in one task, and all sources of a host in one partition, with the delay between requests; other
hosts are walked beside it. The fetcher is a parameter, so a walk can be run on canned answers.
"""

from __future__ import annotations

import json
import re
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .landing import SCHEMA, fetch

#: (status, content) of an address.
Fetcher = Callable[[str], tuple[str, bytes | None]]
#: The next address, from what has been asked so far (the number of pages) and the last answer; None where the walk ends.
Next = Callable[[int, bytes | None], str | None]
PAGES = "source string, page int, url string, status string, content binary"


@dataclass(frozen=True)
class Source:
    """``rule()`` gives a fresh :data:`Next` for each walk; ``most`` pages at the most."""

    name: str
    first: str
    rule: Callable[[], Next]
    most: int = 10_000


def records(content: bytes | None, field: str | None = None) -> list | None:
    """The list of a JSON payload (or its ``field``); None where there is none."""
    try:
        found = json.loads(content or b"null")
    except ValueError:
        return None
    found = found.get(field) if field and isinstance(found, dict) else found
    return found if isinstance(found, list) else None


def by_offset(name: str, template: str, size: int, field: str | None = None, total: Callable[[bytes], int | None] = lambda content: None, first: int = 0) -> Source:
    """``template`` with {start}: ``first``, ``first`` + size, … until a page is short or empty, or the stated total is reached."""

    def rule() -> Next:
        def following(asked: int, content: bytes | None) -> str | None:
            found, stated = records(content, field), total(content) if content else None
            done = not found or len(found) < size or (stated is not None and asked * size >= stated)
            return None if done else template.format(start=first + asked * size)

        return following

    return Source(name, template.format(start=first), rule)


def by_page(name: str, template: str, size: int, field: str | None = None, most: int = 10_000) -> Source:
    """``template`` with {page}: 1, 2, … until a page is short or no list."""

    def rule() -> Next:
        def following(asked: int, content: bytes | None) -> str | None:
            found = records(content, field)
            return None if found is None or len(found) < size else template.format(page=asked + 1)

        return following

    return Source(name, template.format(page=1), rule, most)


def by_cursor(name: str, template: str, position: str, key: str, most: int = 50) -> Source:
    """``template`` with {start}, the last ``position`` (a pattern) of the page before; until a page has no new ``key``."""

    def rule() -> Next:
        seen: set[str] = set()

        def following(asked: int, content: bytes | None) -> str | None:
            text = (content or b"").decode("utf-8", "replace")
            new = set(re.findall(key, text)) - seen
            seen.update(new)
            places = re.findall(position, text)
            return template.format(start=places[-1]) if new and places else None

        return following

    return Source(name, template.format(start=1), rule, most)


def by_total(name: str, first: str, template: str, size: int, total: str = r"(?i)Displaying\s+\d+\s*[-–]\s*\d+\s+of\s+(\d+)\s+results") -> Source:
    """``first``, then ``template`` with {page}: 1, 2, … as many pages as the first one's stated total fills."""

    def rule() -> Next:
        pages = 0

        def following(asked: int, content: bytes | None) -> str | None:
            nonlocal pages
            if asked == 1:
                stated = re.search(total, (content or b"").decode("utf-8", "replace"))
                pages = -(-int(stated[1]) // size) if stated else 1
            return template.format(page=asked) if asked < pages else None

        return following

    return Source(name, first, rule)


def by_number(name: str, template: str, start: int, empty: Callable[[bytes | None], bool], run: int = 10, ahead: int = 50) -> Source:
    """``template`` with {number}: start, start + 1, …, ``ahead`` of them, until ``run`` answers on end are empty."""

    def rule() -> Next:
        empties = 0

        def following(asked: int, content: bytes | None) -> str | None:
            nonlocal empties
            empties = empties + 1 if empty(content) else 0
            return None if empties >= run else template.format(number=start + asked)

        return following

    return Source(name, template.format(number=start), rule, ahead)


def walk(source: Source, fetcher: Fetcher, delay: float = 0.3, sleep: Callable[[float], None] = time.sleep) -> Iterator[tuple[int, str, str, bytes | None]]:
    """(page, url, status, content) of each page asked; a page that can't be fetched counts as empty and is in the result."""
    url, following = source.first, source.rule()
    for asked in range(1, source.most + 1):
        if asked > 1:
            sleep(delay)
        status, content = fetcher(url)
        yield asked - 1, url, status, content
        if (url := following(asked, content if status == "ok" else None)) is None:
            return


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(schema)], schema=schema)


def pages(spark: SparkSession, sources: list[Source], fetcher: Fetcher = fetch, delay: float = 0.3) -> DataFrame:
    """A row for each page of each source; land it (``write.parquet``) before it is read twice."""
    hosts: dict[str, list[Source]] = {}
    for source in sources:
        hosts.setdefault(urlsplit(source.first).netloc, []).append(source)
    walks = list(hosts.values())
    schema = pa.schema([("source", pa.string()), ("page", pa.int32()), ("url", pa.string()), ("status", pa.string()), ("content", pa.binary())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n in batch.column("id").to_pylist():
                for source in walks[n]:
                    for row in walk(source, fetcher, delay):
                        yield _batch([(source.name, *row)], schema)
                    time.sleep(delay)

    return spark.range(0, len(walks), 1, max(1, len(walks))).mapInArrow(read, PAGES)


def fetch_table(urls: DataFrame, fetcher: Fetcher = fetch, delay: float = 0.3) -> DataFrame:
    """url, status, content for each distinct ``url`` of a table; a host's addresses meet in one partition, the driver sees none."""
    host = F.coalesce(F.parse_url("url", F.lit("HOST")), F.lit(""))
    dealt = urls.select("url").filter("url is not null").distinct().withColumn("host", F.when(F.col("url").rlike("^[a-zA-Z][a-zA-Z0-9+.-]*://[^ ]*$"), host).otherwise(F.lit("")))
    dealt = dealt.repartition("host").sortWithinPartitions("host", "url").select("url")
    schema = pa.schema([("url", pa.string()), ("status", pa.string()), ("content", pa.binary())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begun = False
        for batch in batches:
            for url in batch.column("url").to_pylist():
                if begun:
                    time.sleep(delay)
                begun = True
                yield _batch([(url, *fetcher(url))], schema)

    return dealt.mapInArrow(read, SCHEMA)


def tried_again(landed: DataFrame, fetcher: Fetcher = fetch, delay: float = 0.3) -> DataFrame:
    """``landed`` (url, status, content) with what failed fetched a second time; a page that a host refuses (HTTP 4xx) is not."""
    failed = F.coalesce(~((F.col("status") == "ok") | F.col("status").startswith("HTTP 4")), F.lit(True))
    return landed.filter(~failed).select("url", "status", "content").union(fetch_table(landed.filter(failed), fetcher, delay))
