"""Pages as ordered events: runs of text outside tables, table rows, table ends."""

from __future__ import annotations

import re
from collections.abc import Sequence
from html import unescape
from html.parser import HTMLParser
from itertools import accumulate, chain

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..udf import array_udf

#: Elements at whose edges a run of text ends.
EDGES = frozenset("p div h1 h2 h3 h4 h5 h6 li br table".split())
EVENTS = "struct<title:string,events:array<struct<kind:string,text:string,cells:array<string>>>>"

#: A tag that every reader takes alike: plain names, attributes with quotes or without odd characters.
_TAG = re.compile(r"""<(?:/([a-zA-Z][a-zA-Z0-9]*)[ \t\r\n]*|([a-zA-Z][a-zA-Z0-9]*)(?:[ \t\r\n]+[a-zA-Z][a-zA-Z-]*(?:=(?:"[^"<>]*"|'[^'<>]*'|[a-zA-Z0-9_.:#%;&?+,-]+))?)*[ \t\r\n]*(/?))>""")
#: Elements whose content isn't read as markup by some version of the parser.
_RAW = frozenset("script style title textarea iframe noembed noframes noscript plaintext xmp".split())


def _joined(parts: list[str]) -> str:
    return " ".join("".join(parts).split())


class _Reader(HTMLParser):
    """One sink at a time takes characters: the open cell, else (outside tables) the open run of text."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out: list[tuple[str, str, list[str]]] = []
        self.title: list[str] = []
        self.run: list[str] = []
        self.cell: list[str] | None = None
        self.row: list[str] | None = None
        self.tables = self.silent = 0
        self.titled = False

    def end_run(self) -> None:
        if text := _joined(self.run):
            self.out.append(("text", text, []))
        self.run = []

    def handle_starttag(self, tag, attrs):
        if tag in ("script", "style"):
            self.silent += 1
        elif tag == "title":
            self.titled = True
        elif tag == "table":
            if not self.tables:
                self.end_run()
            self.tables += 1
        elif not self.tables:
            if tag in EDGES:
                self.end_run()
        elif tag == "tr":
            self.row = []
        elif tag in ("td", "th"):
            self.cell = []
        elif tag == "br" and self.cell is not None:
            self.cell.append(" ")

    def handle_endtag(self, tag):
        if tag in ("script", "style"):
            self.silent = max(0, self.silent - 1)
        elif tag == "title":
            self.titled = False
        elif not self.tables:
            if tag in EDGES:
                self.end_run()
        elif tag == "table":
            self.tables -= 1
            if not self.tables:
                self.out.append(("table_end", "", []))
        elif tag in ("td", "th") and self.cell is not None:
            if self.row is not None:
                self.row.append(_joined(self.cell))
            self.cell = None
        elif tag == "tr" and self.row is not None:
            if any(self.row):
                self.out.append(("row", "", self.row))
            self.row = None

    def handle_data(self, data):
        if self.silent:
            return
        if self.titled:
            self.title.append(data)
        if self.cell is not None:
            self.cell.append(data)
        elif not self.tables:
            self.run.append(data)


def _feed_plain(reader: _Reader, html: str) -> bool:
    """Feed a page that consists of plain tags and text alone to ``reader``; False, and nothing fed, if there is anything else."""
    parts = _TAG.split(html)
    texts, ends, starts, closed = parts[::4], parts[1::4], parts[2::4], parts[3::4]
    if any("<" in text for text in texts) or any(tag and tag.lower() in _RAW for tag in starts):
        return False
    for text, end, start, at_once in zip(texts, ends, starts, closed):
        if text:
            reader.handle_data(unescape(text) if "&" in text else text)
        if start:
            reader.handle_starttag(start.lower(), ())
        if end or at_once:
            reader.handle_endtag((end or start).lower())
    if texts[-1]:
        reader.handle_data(unescape(texts[-1]))
    return True


def read_page(html: str | None) -> tuple[str, list[tuple[str, str, list[str]]]]:
    """(title, events) of a page. Plain markup is cut up by one pattern; any other goes through the parser, with the same result."""
    reader = _Reader()
    if not _feed_plain(reader, html or ""):
        reader.feed(html or "")
        reader.close()
    reader.end_run()
    return "".join(reader.title), reader.out


def offsets(lists: Sequence[Sequence]) -> pa.Array:
    return pa.array(list(accumulate(map(len, lists), initial=0)), pa.int32())


def lists_of_strings(lists: Sequence[Sequence[str]]) -> pa.Array:
    return pa.ListArray.from_arrays(offsets(lists), pa.array(list(chain.from_iterable(lists)), pa.string()))


def event_fields(events: Sequence[tuple[str, str, list[str]]]) -> dict[str, pa.Array]:
    """The events' kind, text and cells, as arrays."""
    return {"kind": pa.array([e[0] for e in events], pa.string()), "text": pa.array([e[1] for e in events], pa.string()), "cells": lists_of_strings([e[2] for e in events])}


@array_udf(EVENTS)
def page_events(pages: pa.Array) -> pa.Array:
    """struct(title, events) of each page."""
    read = [read_page(p) for p in pages.to_pylist()]
    lists = [events for _, events in read]
    fields = event_fields([*chain.from_iterable(lists)])
    events = pa.StructArray.from_arrays([*fields.values()], names=[*fields])
    return pa.StructArray.from_arrays([pa.array([t for t, _ in read], pa.string()), pa.ListArray.from_arrays(offsets(lists), events)], names=["title", "events"])


def body_of(html: Column, marker: str = "entry-content") -> Column:
    """The part of a page inside the element of class ``marker``, or the whole page."""
    part = F.regexp_extract(html, rf'(?s)class="[^"]*{marker}[^"]*"(.*?)(?:<!--\s*\.{marker}\s*-->|<footer|id="secondary")', 1)
    return F.when(part == "", html).otherwise(part)


def event_rows(pages: DataFrame, html: str = "html") -> DataFrame:
    """A row for each event: the page's other columns, title, pos, kind, text, cells."""
    rest = [c for c in pages.columns if c != html]
    made = pages.withColumn("_page", page_events(body_of(F.col(html))))
    return made.select(*rest, F.col("_page.title").alias("title"), F.posexplode_outer("_page.events").alias("pos", "e")).select(*rest, "title", "pos", "e.kind", "e.text", "e.cells")
