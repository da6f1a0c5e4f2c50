"""Benchmark decontamination by the q-gram lemma.

Texts are folded to lower-case letters and digits with single spaces between words. Benchmark items are cut into windows of
``window`` folded characters at every ``window // 4`` (the last one ends with the item; a shorter item is one window), so an
excerpt of an item of ``window * 5 / 4`` characters holds a whole window wherever it was cut. A window of m characters may
occur with k = floor(rate * m) edits. It then shares at least m + 1 - q * (k + 1) of its q-grams with the text, on diagonals
(place in the text less place in the window) that differ by at most k. So the diagonals are cut into bands of 2 * (k + 1),
each overlapping the next by half; distinct window places hit are counted for each band, and only bands that reach the
lemma's number are verified, by a banded alignment of the window with any part of the region. q is eight, or less for short
windows, for which the number would not be positive. No occurrence within the budget is lost, and what is reported has been
aligned. Items too short for any edit (k = 0) must stand as whole words.

Memory: a slice of texts is searched in blocks of ``BLOCK`` characters that overlap by more than a region; equal blocks, as
boilerplate and copies have, are searched once. Blocks are taken together until their q-grams hit ``HITS`` window places; a
block with more hits is searched for a part of the windows at a time. A band is aligned once for each distinct pair of
window and characters.

The items are the stated query set: they pass through the driver in blocks of at most ``block`` characters, each broadcast
by itself; with more than one block, a block's result is written before the next is read. Documents are never shuffled.

Defined cases: null and empty texts match nothing, nor do items without a letter or digit; items with one folded text each
report; repeated documents report each; positions are code points of the whole text, the start exact within the edits; other
columns aren't carried; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache, reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, per_batch, prepare, slices

MATCHES = "doc_id long, item_id long, start long, end long, windows int, edits int"
#: Characters of a block of text, hits looked at together, and verified bands remembered.
BLOCK, HITS, REMEMBERED = 512, 400_000, 50_000
_BREAK = 1  # stands between documents; equals nothing
_MULTIPLIERS = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]
_BITS = 22


@cache
def _fold_table() -> np.ndarray:
    out = np.full(0x10000, 32, np.uint32)
    for c in range(0x10000):
        x = chr(c)
        if x.isalnum():
            low = x.lower()
            out[c] = ord(low) if len(low) == 1 else c
    return out


def fold(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(folded code points of all texts with a break behind each, their places in the joined texts, ends of the texts there)."""
    texts = [t or "" for t in texts]
    ends = np.cumsum([len(t) + 1 for t in texts]) if texts else np.zeros(0, np.int64)
    points = np.frombuffer("".join(t + "\n" for t in texts).encode("utf-32-le", "surrogatepass"), "<u4")
    table = _fold_table()
    folded = np.where(points < 0x10000, table[np.minimum(points, 0xFFFF)], points).astype(np.uint32)
    folded[ends - 1] = _BREAK
    gap = folded == 32
    keep = np.ones(len(folded), bool)
    keep[1:] = ~(gap[1:] & (gap[:-1] | (folded[:-1] == _BREAK)))
    if len(keep):
        keep[0] = not gap[0]
    places = np.flatnonzero(keep)
    return folded[places], places, ends


def grams(points: np.ndarray, q: int = 8) -> np.ndarray:
    """Hash of the ``q`` characters at each place."""
    h = points.astype(np.uint64)
    if len(h) < q:
        return np.zeros(0, np.uint64)
    if q == 8:
        for step, m in zip((1, 2, 4), _MULTIPLIERS, strict=True):
            h = h[:-step] * m + (h[step:] ^ (h[step:] >> np.uint64(29)))
    else:
        one, n = h, len(h) - q + 1
        h = one[:n].copy()
        for k in range(1, q):
            h = (h ^ (h >> np.uint64(29))) * _MULTIPLIERS[1] + one[k : k + n]
    return h * _MULTIPLIERS[0]


def ragged(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, … for count[0] numbers, then from first[1] on, and so on."""
    return np.repeat(first - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))


def lemma(m: int, rate: float) -> tuple[int, int, int]:
    """(edits, q, least number of shared q-grams) of a window of ``m`` characters."""
    k = int(rate * m)
    q = min(8, m // (k + 1))
    return k, q, m + 1 - q * (k + 1)


class Windows:
    """The index of one block of items: for each q in use, the places of the windows' q-grams."""

    def __init__(self, items: list[tuple[int, str]], window: int, rate: float):
        self.item, self.offset, self.text = [], [], []
        for item_id, text in items:
            points = fold([text])[0][:-1]
            points = points[:-1] if len(points) and points[-1] == 32 else points
            if not len(points):
                continue
            starts = [*range(0, max(1, len(points) - window + 1), max(1, window // 4))]
            if starts[-1] + window < len(points):
                starts.append(len(points) - window)
            for s in starts:
                self.item.append(item_id)
                self.offset.append(s)
                self.text.append(points[s : s + window])
        self.long = np.array([len(x) for x in self.text], np.int64)
        known = np.array([lemma(len(x), rate) for x in self.text], np.int64).reshape(-1, 3)
        self.edits, self.q, self.need = known.T
        self.most = int((self.long + self.edits).max(initial=0))  # characters of the longest region
        self.grams = [_Grams(self, int(q)) for q in np.unique(self.q)]

    def search(self, texts: list[str | None]) -> list[tuple[int, int, int, int, int, int]]:
        """(number of the text, item, start, end, windows, edits) of each region that holds an item's windows."""
        if not self.item:
            return []
        points, places, ends = fold(texts)
        stops = np.flatnonzero(points == _BREAK)
        found: set[tuple] = set()
        for index in self.grams:
            for w, edits, e in index.occurrences(points, stops):
                begin = e - int(self.long[w])
                if not self.edits[w] and not ((begin == 0 or points[begin - 1] in (32, _BREAK)) and (points[e] in (32, _BREAK))):
                    continue
                to = int(places[e - 1]) + 1
                n = int(np.searchsorted(ends, to - 1, "right"))
                base = int(ends[n - 1]) if n else 0
                found.add((n, self.item[w], max(base, int(places[max(0, begin)])) - base, to - base, self.offset[w], edits))
        out: list[list[int]] = []
        windows: set[int] = set()
        for n, item, start, to, offset, c in sorted(found):
            last = out[-1] if out else None
            if last and last[:2] == [n, item] and start <= last[3]:
                last[3] = max(last[3], to)
                windows.add(offset)
                last[4], last[5] = len(windows), min(last[5], c)
            else:
                windows = {offset}
                out.append([n, item, start, to, 1, c])
        return [tuple(x) for x in out]


class _Grams:
    """The q-grams of those windows that are counted with one q."""

    def __init__(self, windows: Windows, q: int):
        self.all, self.q = windows, q
        chosen = np.flatnonzero(windows.q == q)
        hashes = [grams(windows.text[w], q) for w in chosen.tolist()]
        flat = np.concatenate(hashes)
        which = np.repeat(chosen, [len(x) for x in hashes])
        place = np.concatenate([np.arange(len(x)) for x in hashes])
        order = np.argsort(flat, kind="stable")
        self.which, self.place = which[order], place[order]
        self.hash, self.first, self.count = np.unique(flat[order], return_index=True, return_counts=True)
        #: (number of the q-gram, window) ascends, so a part of the windows is a range of each q-gram's places
        self.number = np.repeat(np.arange(len(self.hash)), self.count) * len(windows.item) + self.which
        self.least = int(windows.need[chosen].min())
        self.bitmap = np.zeros(1 << _BITS, bool)
        self.bitmap[(self.hash >> np.uint64(64 - _BITS)).astype(np.int64)] = True

    def occurrences(self, points: np.ndarray, stops: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(window, edits, place behind its last character) of each occurrence in ``points``, whose texts end at ``stops``."""
        found = grams(points, self.q)
        at = np.flatnonzero(self.bitmap[(found >> np.uint64(64 - _BITS)).astype(np.int64)]) if len(found) else np.zeros(0, np.int64)
        gram = np.minimum(np.searchsorted(self.hash, found[at]), len(self.hash) - 1)
        real = self.hash[gram] == found[at]
        at, gram = at[real], gram[real]
        if not len(at):
            return
        # blocks begin at every ``core`` characters of a text and reach beyond the next one's beginning by a region
        text = np.searchsorted(stops, at, "left")
        begin = np.concatenate([[0], stops[:-1] + 1])[text]
        over = self.all.most + self.q
        core = max(BLOCK, over)
        own = begin + (at - begin) // core * core
        before = own[(at - own < over) & (own > begin)] - core
        starts = np.unique(np.concatenate([own, before]))
        ends = np.minimum(starts + core + over, stops[np.searchsorted(stops, starts, "left")])
        low, high = np.searchsorted(at, starts), np.searchsorted(at, ends - self.q, "right")
        enough = high - low >= self.least
        same: dict[bytes, list[int]] = {}
        first: list[int] = []
        for k in np.flatnonzero(enough).tolist():
            key = points[starts[k] : ends[k]].tobytes()
            if key not in same:
                first.append(k)
            same.setdefault(key, []).append(int(starts[k]))
        if not first:
            return
        copies = list(same.values())
        low, high, starts, ends = low[first], high[first], starts[first], ends[first]
        sums = np.concatenate([[0], np.cumsum(self.count[gram])])
        weight = np.cumsum(sums[high] - sums[low])
        verified: dict[tuple, tuple[int, int]] = {}
        a = 0
        while a < len(first):
            b = max(a + 1, int(np.searchsorted(weight, (weight[a - 1] if a else 0) + HITS, "right")))
            size = ends[a:b] - starts[a:b] + 1
            base = np.cumsum(size) - size
            joined = points[ragged(starts[a:b], size)]
            joined[base + size - 1] = _BREAK
            rows = ragged(low[a:b], high[a:b] - low[a:b])
            moved = at[rows] - np.repeat(starts[a:b] - base, high[a:b] - low[a:b])
            for window, diagonal in self.bands(moved, gram[rows], len(joined), 0, len(self.all.item)):
                for w, edits, end in self.verify(joined, window, diagonal, verified):
                    block = int(np.searchsorted(base, end - 1, "right")) - 1
                    for start in copies[a + block]:
                        yield w, edits, start + end - int(base[block])
            a = b

    def bands(self, at: np.ndarray, gram: np.ndarray, size: int, a: int, b: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(windows, first diagonals) of the bands of windows a to b that hold enough q-grams, a bounded number of hits at a time."""
        n = len(self.all.item)
        low, high = np.searchsorted(self.number, gram * n + a), np.searchsorted(self.number, gram * n + b)
        count = high - low
        if count.sum() > HITS and b - a > 1:
            yield from self.bands(at, gram, size, a, (a + b) // 2)
            yield from self.bands(at, gram, size, (a + b) // 2, b)
            return
        row = ragged(low, count)
        window, place = self.which[row], self.place[row]
        most = self.all.most
        band = (np.repeat(at, count) - place + most) // (self.all.edits[window] + 1)
        wide = size + 2 * most + 2
        key = (window * wide + band) * most + place  # a window's band and the place hit
        hit = np.sort(np.concatenate([key + most, key]))  # each in its band and in the one before it
        hit = hit[np.concatenate([[True], hit[1:] != hit[:-1]])] // most
        edge = np.flatnonzero(np.concatenate([[True], hit[1:] != hit[:-1]])) if len(hit) else hit
        distinct = np.diff(np.concatenate([edge, [len(hit)]]))
        key = hit[edge]
        window = key // wide
        good = distinct >= self.all.need[window]
        window, key = window[good], key[good]
        if len(window):
            yield window, (key % wide - 1) * (self.all.edits[window] + 1) - most

    def verify(self, points: np.ndarray, window: np.ndarray, diagonal: np.ndarray, known: dict) -> Iterator[tuple[int, int, int]]:
        """(window, edits, end) of the bands that hold their window within its budget; equal ones are aligned once."""
        most = self.all.most
        for part in range(0, len(window), 1024):
            w, first = window[part : part + 1024], diagonal[part : part + 1024]
            width = int((2 * self.all.edits[w] + 2).max())  # an alignment's diagonals lie in one band
            index = first[:, None] + np.arange(int(self.all.long[w].max()) + width)
            seen = np.where((index >= 0) & (index < len(points)), points[np.clip(index, 0, len(points) - 1)], _BREAK).astype(np.uint32)
            if len(known) > REMEMBERED:
                known.clear()
            keys = [(x, row.tobytes()) for x, row in zip(w.tolist(), seen, strict=True)]
            fresh = list({key: k for k, key in enumerate(keys) if key not in known}.values())
            if fresh:
                for k, c, e in zip(fresh, *(x.tolist() for x in self.align(seen[fresh], w[fresh], width)), strict=True):
                    known[keys[k]] = c, e
            for key, f in zip(keys, first.tolist(), strict=True):
                c, e = known[key]
                if c <= self.all.edits[key[0]]:
                    yield key[0], c, f + e

    def align(self, seen: np.ndarray, window: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """(edits of the best alignment of each window inside its row of characters, its end in the row)."""
        most = int(self.all.long[window].max())
        text = np.zeros((len(window), most), np.uint32)
        for r, w in enumerate(window.tolist()):
            text[r, : self.all.long[w]] = self.all.text[w]
        step = np.where(seen == _BREAK, 1 << 16, 1).astype(np.int32)
        passed = np.cumsum(step, 1, dtype=np.int32)  # what it costs to leave out the characters up to each place
        row, below = np.zeros((len(window), width), np.int32), np.full((len(window), width), 1 << 20, np.int32)
        best, where = np.full(len(window), 1 << 20, np.int64), np.zeros(len(window), np.int64)
        live, long, edits = np.arange(len(window)), self.all.long[window], self.all.edits[window]
        for j in range(most):
            if j % 24 == 0 and j:  # what is beyond its budget or done goes no further
                on = (row.min(1) <= edits) & (long > j)
                if not on.any():
                    break
                if not on.all():
                    live, long, edits, text, seen, step, passed, row, below = (x[on] for x in (live, long, edits, text, seen, step, passed, row, below))
            here = slice(j, j + width)
            below[:, :-1] = row[:, 1:] + 1
            row = np.minimum(row + np.where(seen[:, here] == text[:, j : j + 1], 0, step[:, here]), below)
            row = np.minimum.accumulate(row - passed[:, here], 1) + passed[:, here]
            done = long == j + 1
            if done.any():
                at = row[done].argmin(1)
                best[live[done]], where[live[done]] = row[done, at], at + j + 1
        return best, where


def blocks(benchmark: DataFrame, most: int) -> Iterator[list[tuple[int, str]]]:
    held, size = [], 0
    for row in benchmark.select("item_id", "text").filter("item_id is not null and text is not null").toLocalIterator():
        if held and size + len(row.text) > most:
            yield held
            held, size = [], 0
        held.append((row.item_id, row.text))
        size += len(row.text)
    yield held


def indexes(spark: SparkSession, benchmark: DataFrame, window: int, rate: float, block: int) -> Iterator:
    """A broadcast index for each block of items, one after another."""
    prepare(spark)
    for items in blocks(benchmark, block):
        yield spark.sparkContext.broadcast(Windows(items, window, rate))  # of at most ``block`` characters


def contaminated(docs: DataFrame, benchmark: DataFrame, window: int = 96, rate: float = 0.1, block: int = 2_000_000) -> DataFrame:
    """The regions of ``docs`` (doc_id, text) that hold a window of ``benchmark`` (item_id, text) within the edit budget."""
    parts: list[DataFrame] = []
    for index in indexes(docs.sparkSession, benchmark, window, rate, block):
        if parts:
            parts[-1] = cut(parts[-1])

        def matches(batch: pa.RecordBatch, index=index) -> dict:
            rows = index.value.search(batch.column("text").to_pylist())
            of, *rest = [list(x) for x in zip(*rows, strict=True)] if rows else [[]] * 6
            return {"doc_id": batch.column("doc_id").take(pa.array(of, pa.int64())), **dict(zip(("item_id", "start", "end", "windows", "edits"), rest, strict=True))}

        parts.append(per_batch(docs.select("doc_id", "text"), matches, MATCHES))
    return reduce(DataFrame.unionAll, parts)


def keep_clean(docs: DataFrame, benchmark: DataFrame, window: int = 96, rate: float = 0.1, block: int = 2_000_000) -> DataFrame:
    """``docs`` without the rows whose ``text`` holds a benchmark region; all columns, no shuffle. Each further block of items
    sees only what the one before kept, as written."""
    for n, index in enumerate(indexes(docs.sparkSession, benchmark, window, rate, block)):
        if n:
            docs = cut(docs)
        docs = docs.filter(_clean(index))
    return docs


def _clean(held):
    """A predicate on ``text``: no region of this block's items."""

    @F.pandas_udf("boolean")
    def clean(texts: pd.Series) -> pd.Series:
        out, at = np.ones(len(texts), bool), 0
        for part in slices(pa.record_batch([pa.array(texts, pa.string(), from_pandas=True)], ["text"]), "text"):
            out[[at + found[0] for found in held.value.search(part.column("text").to_pylist())]] = False
            at += part.num_rows
        return pd.Series(out)

    return clean(F.col("text"))
