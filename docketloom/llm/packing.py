"""Sequence packing as a cutting-stock problem solved by column generation.

Documents longer than a sequence give whole sequences and a remainder; remainders and short documents are the stock's
orders. Their lengths are counted in units of ``unit`` tokens (rounded up) and a sequence's in whole units (rounded down; a
piece longer than those stands alone), so the problem has at most ``length / unit`` order sizes whatever the corpus. The linear program over cutting patterns is solved on the driver: the
simplex basis holds one pattern for each order size, and a knapsack dynamic program over the units prices new patterns.
Rounded down, the patterns take nearly all orders; what is left, a number bounded by the basis and not by the corpus, goes
into bins that each take the largest piece left and the others that fill it best. Pieces are then ranked within their order size and each takes the slot of its rank.

Sizes on the driver and in the one broadcast: patterns and slots, bounded by the number of order sizes. Ranks are made from
counts by (order size, salt), so an order size that holds a third of all pieces is still dealt to many tasks.

Defined cases: a null or empty text is its end id alone; repeated rows and doc_ids are packed each; an empty table gives an
empty result; columns other than the id and the text aren't carried.
"""

from __future__ import annotations

from zlib import crc32

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, per_batch
from .tokens import encoded

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def pieces(docs: DataFrame, tokenizer: str, kind: str, end: int, length: int) -> DataFrame:
    """One row for each piece of each document: whole sequences first, then the remainder."""

    def make(batch) -> dict:
        ids, offsets = encoded(batch.column("text"), tokenizer, kind, end, pieces=600_000)
        ids, sizes = ids.astype("<u4"), np.diff(offsets)
        n = -(-sizes // length)
        row = np.repeat(np.arange(len(sizes)), n)
        start = (np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)) * length
        long = np.minimum(length, sizes[row] - start)
        at = offsets[row] + start
        crc = [crc32(ids[a : a + k].data) for a, k in zip(at.tolist(), long.tolist(), strict=True)]
        return {"doc_id": batch.column("doc_id").take(_index(row)), "start": start, "length": long, "ids_crc32": crc, "doc_tokens": sizes[row]}

    return per_batch(docs.select("doc_id", "text"), make, PIECES)


def _index(row: np.ndarray):
    import pyarrow as pa

    return pa.array(row, pa.int64())


def knapsack(value: np.ndarray, size: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack: the best total value and how often each item is taken. Dynamic program over the capacity."""
    best, took = np.zeros(capacity + 1), np.full(capacity + 1, -1, np.int64)
    for room in range(1, capacity + 1):
        fit = np.searchsorted(size, room, "right")  # sizes ascend
        best[room] = best[room - 1]
        if fit:
            got = best[room - size[:fit]] + value[:fit]
            k = int(got.argmax())
            if got[k] > best[room] + 1e-12:
                best[room], took[room] = got[k], k
    counts, room = np.zeros(len(size), np.int64), capacity
    while room > 0:
        if took[room] < 0:
            room -= 1
        else:
            counts[took[room]] += 1
            room -= size[took[room]]
    return float(best[capacity]), counts


def inverted(basis: np.ndarray) -> np.ndarray:
    """The inverse by Gauss-Jordan elimination with row pivots."""
    m = len(basis)
    work = np.hstack([basis, np.eye(m)])
    for k in range(m):
        p = k + int(np.abs(work[k:, k]).argmax())
        if p != k:
            work[[k, p]] = work[[p, k]]
        work[k] /= work[k, k]
        others = work[:, k].copy()
        others[k] = 0
        work -= np.outer(others, work[k])
    return work[:, m:]


def solve(size: np.ndarray, demand: np.ndarray, capacity: int, rounds: int = 10_000, close: float = 1e-4) -> list[tuple[np.ndarray, int]]:
    """Patterns (copies of each size in a bin) and the number of bins of each, which together take exactly ``demand``.

    ``size`` ascends. The first columns are single sizes and the patterns of a greedy filling; the knapsack prices new ones once
    none of those improves. Column generation stops when no pattern is worth more than 1 + ``close`` (the bins are then within
    that factor of the linear program's least number), or after ``rounds`` (the bins are still valid, only more of them), which
    bounds the driver's time: some 5 ms each. All algebra is plain numpy loops: on a driver with a session, threaded LAPACK was
    seen to wait for ever."""
    m = len(size)
    if not m:
        return []
    basis = np.diag(capacity // size).astype(float)
    inverse = np.diag(1.0 / np.diag(basis))
    times = lambda a, b: np.einsum("ij,j->i", a, b)
    amount = times(inverse, demand)
    pool = np.array([p for p, _ in fill_rest(size, demand.astype(np.int64), capacity)], float).reshape(-1, m)
    for k in range(rounds):
        if k % 200 == 199:  # against rounding errors
            inverse = inverted(basis)
            amount = np.maximum(0, times(inverse, demand))
        prices = inverse.sum(0)
        worth = times(pool, prices)
        gain, pattern = float(worth.max()), pool[int(worth.argmax())]
        if gain <= 1 + close:
            gain, pattern = knapsack(prices, size, capacity)
        if gain <= 1 + close:
            break
        way = times(inverse, pattern)
        ratio = np.where(way > 1e-9, amount / np.where(way > 1e-9, way, 1), np.inf)
        out = int(ratio.argmin())
        amount = np.maximum(0, amount - ratio[out] * way)
        amount[out] = ratio[out]
        basis[:, out] = pattern
        row = inverse[out] / way[out]
        inverse -= np.outer(way, row)
        inverse[out] = row
    chosen, left = [], demand.astype(np.int64).copy()
    for k in np.argsort(-amount, kind="stable"):
        pattern = basis[:, k].round().astype(np.int64)
        used = pattern > 0
        bins = min(int(amount[k] + 1e-6), int((left[used] // pattern[used]).min()))
        if bins > 0:
            chosen.append((pattern, bins))
            left -= bins * pattern
    return chosen + fill_rest(size, left, capacity)


def fill_rest(size: np.ndarray, count: np.ndarray, capacity: int) -> list[tuple[np.ndarray, int]]:
    """Bins for what the patterns leave: each takes the largest piece left and those others that fill it best (subset sums)."""
    left, out = count.copy(), []
    while left.any():
        pattern = np.zeros(len(size), np.int64)
        top = int(np.flatnonzero(left)[-1])
        pattern[top] = 1
        room = capacity - int(size[top])
        mask, reached, steps = (1 << (room + 1)) - 1, 1, []  # bit n: some pieces have n units together
        for k in np.flatnonzero(left)[::-1].tolist():
            for _ in range(min(int(left[k]) - (k == top), room // int(size[k]))):
                steps.append((k, reached))
                reached |= reached << int(size[k]) & mask
            if reached >> room & 1:
                break
        at = reached.bit_length() - 1
        for k, before in reversed(steps):
            if not before >> at & 1:
                pattern[k] += 1
                at -= int(size[k])
        used = pattern > 0
        bins = int((left[used] // pattern[used]).min())
        out.append((pattern, bins))
        left -= bins * pattern
    return out


def first_fit(size: np.ndarray, count: np.ndarray, capacity: int) -> list[tuple[np.ndarray, int]]:
    """First fit decreasing, filling one bin at a time with the largest size that fits; equal bins are made at once."""
    left, out = count.copy(), []
    while left.any():
        pattern, room = np.zeros(len(size), np.int64), capacity
        for k in np.flatnonzero(left)[::-1]:
            pattern[k] = min(left[k], room // size[k])
            room -= pattern[k] * size[k]
        used = pattern > 0
        bins = int((left[used] // pattern[used]).min())
        out.append((pattern, bins))
        left -= bins * pattern
    return out


def slots(size: np.ndarray, chosen: list[tuple[np.ndarray, int]]) -> list[tuple[int, int, int, int, int]]:
    """(units, first rank, rank behind the last, slots in a bin, first sequence) for each pattern and size in it."""
    at, sequence, out = np.zeros(len(size), np.int64), 0, []
    for pattern, bins in chosen:
        for k in np.flatnonzero(pattern):
            out.append((int(size[k]), int(at[k]), int(at[k] + bins * pattern[k]), int(pattern[k]), sequence))
            at[k] += bins * pattern[k]
        sequence += bins
    return out


def pack(docs: DataFrame, tokenizer: str, kind: str = "words", end: int = 2, length: int = 4096, unit: int = 16) -> DataFrame:
    """Pieces of all ``docs`` (doc_id, text) with the sequence and offset that each one takes."""
    spark: SparkSession = docs.sparkSession
    capacity = length // unit
    if capacity < 1:
        raise ValueError(f"a sequence of {length} tokens holds no unit of {unit}")
    salts = max(16, int(spark.conf.get("spark.sql.shuffle.partitions")))
    made = cut(pieces(docs, tokenizer, kind, end, length).withColumns({"units": F.least(F.ceil(F.col("length") / unit), F.lit(capacity)).cast("int"), "salt": F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(salts)).cast("int")}))
    counts = made.groupBy("units", "salt").agg(F.count("*").alias("n"))
    orders = sorted((r.units, r.n) for r in counts.groupBy("units").agg(F.sum("n").alias("n")).collect())
    size, demand = np.array([u for u, _ in orders], np.int64), np.array([n for _, n in orders], np.int64)
    held = spark.createDataFrame(slots(size, solve(size, demand, capacity)), "units int, since long, until long, per long, first long")
    before = Window.partitionBy("units").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("units", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("units", "salt").orderBy("doc_id", "start", "ids_crc32")
    ranked = made.withColumn("rank", F.row_number().over(within) - 1).join(base, ["units", "salt"]).withColumn("rank", F.col("rank") + F.col("base"))
    h = F.broadcast(held).alias("h")  # at most patterns times order sizes
    placed = ranked.alias("r").join(h, (F.col("r.units") == F.col("h.units")) & (F.col("rank") >= F.col("since")) & (F.col("rank") < F.col("until")))
    placed = placed.select("r.*", (F.col("first") + F.floor((F.col("rank") - F.col("since")) / F.col("per"))).alias("sequence_id"))
    inside = Window.partitionBy("sequence_id").orderBy(F.desc("length"), "rank").rowsBetween(Window.unboundedPreceding, -1)
    return placed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", F.coalesce(F.sum("length").over(inside), F.lit(0)).alias("offset"))
