"""Filter interaction audit: what each of five filters removes in each of the 120 orders in which they may run.

A document's failures are five bits, so the filter that removes it in an order is a lookup: ``FIRST[bits, order]`` is the step
of the first failing filter, or 5 where all are passed. In ``mapInArrow`` each batch of documents indexes that table and
``np.bincount`` counts removals by (part, order, step), for all documents and for those with a label; a task adds its batches up
and gives one array for each part that it met. The arrays are summed in two steps, by (part, salt) and by part, in sorted
streams that hold one array at a time, and each part's sum is its 600 rows.

Filters A to D read a document's own text. E fails a document whose text also stands under a smaller id: the smallest id of each
text's SHA-256 is a minimum (combined before the shuffle) over small rows without texts, and only digests of several ids are
joined back, so a text that a third of all documents share is a hot key of a plain join, which adaptive execution splits.

Defined cases: a null text is an empty one, which fails A only; a null part is the empty part. Each row is a document; a row
without an id has no labels and E never fails it, nor does it count as a smaller id; rows that repeat an id share its labels and
fail E only for a smaller id. A label holds if any row of ``labels`` for the id has it. An empty table gives no rows; other
columns aren't read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, per_batch

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
STEPS = len(FILTERS)
#: FIRST[bits, order]: the step (from 0) at which a document with these failures goes; STEPS: it stays. Bit k: FILTERS[k] fails.
FIRST = np.array([[next((s for s, f in enumerate(o) if bits >> FILTERS.index(f) & 1), STEPS) for o in ORDERS] for bits in range(1 << STEPS)], np.int64)
#: OF[order, step]: the number of the filter that stands there.
OF = np.array([[FILTERS.index(f) for f in o] for o in ORDERS], np.int64)
_CELLS = len(ORDERS) * STEPS
#: An array of a part: removals, of good and of toxic documents by (order, step); failures and lone failures by filter; documents.
_SLOTS = 3 * _CELLS + 2 * STEPS + 1
#: A task gives its arrays away when it holds so many parts, and so many arrays of a part come together first.
PARTS_HELD, SALTS = 256, 32
_UPPER, _MORE = bytes(range(65, 91)), bytes(range(0x80, 0xC0))
ROWS = "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long"


@dataclass(frozen=True)
class Limits:
    """A: fewer words. B: distinct words below so many percent. C: A-Z above so many percent of the code points. D: any of these."""

    words: int = 200
    distinct_percent: int = 50
    upper_percent: int = 3
    marks: bytes = b"#$%&*|"


def failures(text: bytes, limits: Limits) -> int:
    """Bits of the filters A to D that a text fails."""
    words = text.split()  # of bytes: at space and 0x09 to 0x0D, nothing else
    upper = len(text) - len(text.translate(None, _UPPER))
    points = len(text.translate(None, _MORE))  # without the further bytes of longer characters
    return (
        (len(words) < limits.words)
        | (100 * len(set(words)) < limits.distinct_percent * len(words)) << 1
        | (100 * upper > limits.upper_percent * points) << 2
        | (len(text.translate(None, limits.marks)) < len(text)) << 3
    )


def failed(docs: DataFrame, limits: Limits) -> DataFrame:
    """(doc_id, part, bits) with all five filters; the last join's rows are small."""

    def flags(batch: pa.RecordBatch) -> dict:
        texts = [(t or "").encode() for t in batch.column("text").to_pylist()]
        return {"doc_id": batch.column("doc_id"), "part": batch.column("part"), "bits": [failures(t, limits) for t in texts], "same": [sha256(t).digest() for t in texts]}

    own = docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), "text")
    flagged = cut(per_batch(own, flags, "doc_id long, part string, bits int, same binary"))
    ids = flagged.filter("doc_id is not null").groupBy("same").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    several = cut(ids.filter("first < last").select("same", "first"))  # written, so that both sides of the join are plain shuffles
    repeated = F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False)).cast("int") * 16
    return flagged.join(several, "same", "left").select("doc_id", "part", (F.col("bits") + repeated).alias("bits"))


def _added(arrays: Iterator[tuple[str, bytes]]) -> Iterator[tuple[str, np.ndarray]]:
    """Sums of arrays that come sorted by part."""
    part, total = None, None
    for name, data in arrays:
        if name != part:
            if total is not None:
                yield part, total
            part, total = name, np.zeros(_SLOTS, np.int64)
        total += np.frombuffer(data, "<i8")
    if total is not None:
        yield part, total


def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrays of removals by part, one for each part that this task meets (more if it meets very many)."""
    salt = TaskContext.get().partitionId() % SALTS
    held: dict[str, np.ndarray] = {}

    def given() -> pa.RecordBatch:
        sums = [a.astype("<i8").tobytes() for a in held.values()]
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array([salt] * len(held), pa.int32()), pa.array(sums, pa.binary())], names=["part", "salt", "sums"])

    for batch in batches:
        if not batch.num_rows:
            continue
        parts = batch.column("part").dictionary_encode()
        names, code = parts.dictionary.to_pylist(), np.asarray(parts.indices)
        bits = np.asarray(batch.column("bits"))
        good, toxic = (np.asarray(batch.column(c).to_numpy(zero_copy_only=False), bool) for c in ("good", "toxic"))
        cell = (code[:, None] * len(ORDERS) + np.arange(len(ORDERS))) * (STEPS + 1) + FIRST[bits]
        made = np.zeros((len(names), _SLOTS), np.int64)
        for k, rows in enumerate((slice(None), good, toxic)):
            n = np.bincount(cell[rows].ravel(), minlength=len(names) * len(ORDERS) * (STEPS + 1))
            made[:, k * _CELLS : (k + 1) * _CELLS] = n.reshape(len(names), len(ORDERS), STEPS + 1)[:, :, :STEPS].reshape(len(names), _CELLS)
        by_bits = np.bincount(code * 32 + bits, minlength=len(names) * 32).reshape(len(names), 32)
        for f in range(STEPS):
            made[:, 3 * _CELLS + f] = by_bits[:, np.arange(32) >> f & 1 == 1].sum(1)
            made[:, 3 * _CELLS + STEPS + f] = by_bits[:, 1 << f]
        made[:, -1] = by_bits.sum(1)
        for name, row in zip(names, made, strict=True):
            held[name] = held[name] + row if name in held else row
        if len(held) > PARTS_HELD:
            yield given()
            held.clear()
    if held:
        yield given()


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, bytes]]:
    for batch in batches:
        yield from zip(batch.column("part").to_pylist(), batch.column("sums").to_pylist(), strict=True)


def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, total in _added(_stream(batches)):
        yield pa.RecordBatch.from_arrays([pa.array([part]), pa.array([total.astype("<i8").tobytes()], pa.binary())], names=["part", "sums"])


def reported(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of each part, from its sum."""
    names = [x.split()[0] for x in ROWS.split(", ")]
    for part, total in _added(_stream(batches)):
        removed, good, toxic = total[: 3 * _CELLS].reshape(3, len(ORDERS), STEPS)
        fails, lone = total[3 * _CELLS : -1].reshape(2, STEPS)
        share = np.array([removed[OF == f].sum() for f in range(STEPS)])
        columns = [total[-1] - removed.cumsum(1), removed, fails[OF] - removed, lone[OF], good, toxic, share[OF]]
        arrays = [pa.array([part] * _CELLS), pa.array(np.repeat(ORDERS, STEPS).tolist()), pa.array(np.tile(np.arange(1, STEPS + 1, dtype=np.int32), len(ORDERS)))]
        yield pa.RecordBatch.from_arrays([*arrays, *(pa.array(c.ravel()) for c in columns)], names=names)


def audit(docs: DataFrame, labels: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """One row for each part, order and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley."""
    said = labels.filter("doc_id is not null").groupBy("doc_id").agg(F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    rows = failed(docs, limits).join(cut(said), "doc_id", "left")
    known = rows.select("part", "bits", *(F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic")))
    partial = known.mapInArrow(counted, "part string, salt int, sums binary")
    fewer = partial.repartition("part", "salt").sortWithinPartitions("part").mapInArrow(summed, "part string, sums binary")
    return fewer.repartition("part").sortWithinPartitions("part").mapInArrow(reported, ROWS)
