"""Merkle manifest of a dataset: a tree of SHA-256 digests for each key (language), and one over the keys' roots.

Leaves are ranked within their key by a range partitioning of all leaves with the parts' counts as offsets, so a key that holds
a third of all rows, or an id that does, is dealt to many tasks. Ranks fall into aligned blocks of ``fanout ** LEVELS`` leaves; in
each, a contiguous numpy matrix holds the digests as 64-byte hexadecimal rows, is reshaped by the fanout and hashed level by
level. The blocks' nodes are the leaves of the next round, until a key has one block. The way back goes down: a block gets what its
node needs on the way to the root (the shape of each run and its siblings), a few kilobytes for each block, and gives its elements
their own; index arithmetic on the level matrices finds every sibling. Nothing is collected but the largest block number.

A run of one node is hashed too, as long as its level has several nodes. Digests are hashed as hexadecimal text.

Defined cases: null values and a null key have an encoding of their own; a null key comes first, as does a null id in its key; a
row without an id is never tampered with. Rows that repeat an id are leaves of their own, ordered by their leaf digest, and among
equal ones any order gives the same tree. An empty table gives no rows; columns that aren't named aren't read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from hashlib import sha256
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import cut, per_batch

#: Levels of a block, so 512 leaves at a fanout of 8: a batch of 1024 blocks is less than 40 MB.
LEVELS = 3
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def encoded(values: Sequence[bytes | None]) -> bytes:
    """A row's values, none of which can be taken for another."""
    return b"".join(b"-" if v is None else b"%d:%b" % (len(v), v) for v in values)


def depth(n: int, fanout: int) -> int:
    """Levels above ``n`` nodes until one is left."""
    out = 0
    while n > 1:
        n, out = -(-n // fanout), out + 1
    return out


def hex_rows(digests: bytes) -> np.ndarray:
    """Concatenated binary digests as rows of 64 hexadecimal bytes."""
    return np.frombuffer(digests.hex().encode(), np.uint8).reshape(-1, 64)


def levels_of(rows: np.ndarray, count: int, fanout: int) -> list[np.ndarray]:
    """The matrix of the leaves and those of ``count`` levels above it; the last run of a level may be short."""
    out = [rows]
    for _ in range(count):
        below = out[-1]
        whole = len(below) // fanout
        made = [sha256(run).hexdigest() for run in below[: whole * fanout].reshape(whole, fanout * 64)]
        if len(below) % fanout:
            made.append(sha256(below[whole * fanout :].tobytes()).hexdigest())
        out.append(np.frombuffer("".join(made).encode(), np.uint8).reshape(-1, 64))
    return out


class Paths:
    """The ways from all leaves of a block to its node: ``runs[leaf, level]`` holds the run of the leaf's node in that level,
    ``place`` and ``size`` that node's place in it and the run's length."""

    def __init__(self, levels: list[np.ndarray], fanout: int):
        n, self.fanout, self.count = len(levels[0]), fanout, len(levels) - 1
        self.place, self.size = np.zeros((n, self.count), np.int64), np.zeros((n, self.count), np.int64)
        self.runs = np.zeros((n, self.count, fanout, 64), np.uint8)
        for k in range(self.count):
            at = np.arange(n) // fanout**k
            first = at // fanout * fanout
            self.place[:, k], self.size[:, k] = at - first, np.minimum(fanout, len(levels[k]) - first)
            self.runs[:, k] = levels[k][np.minimum(first[:, None] + np.arange(fanout), len(levels[k]) - 1)]

    def siblings(self) -> list[bytes]:
        """The other nodes of each leaf's runs, level by level, left to right."""
        k = np.arange(self.fanout)
        other = (k != self.place[:, :, None]) & (k < self.size[:, :, None])
        found, ends = self.runs[other], np.concatenate([[0], np.cumsum(other.sum((1, 2)))])
        return [found[a:b].tobytes() for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]

    def shapes(self) -> list[bytes]:
        """Two bytes for each level: the node's place in its run and the run's length."""
        both = np.stack([self.place, self.size], 2).astype(np.uint8)
        return [both[k].tobytes() for k in range(len(both))]

    def folded(self, leaves: np.ndarray) -> list[bytes]:
        """The block's node as each of ``leaves`` makes it with the siblings of its place: 64 hexadecimal bytes."""
        now = leaves
        for k in range(self.count):
            runs = self.runs[:, k].copy()
            runs[np.arange(len(now)), self.place[:, k]] = now
            made = [sha256(run[:size].tobytes()).hexdigest() for run, size in zip(runs, self.size[:, k].tolist(), strict=True)]
            now = np.frombuffer("".join(made).encode(), np.uint8).reshape(-1, 64)
        return [row.tobytes() for row in now]


def folded_up(node: bytes, siblings: bytes, shape: bytes) -> bytes:
    """A node's digest (hexadecimal) carried to the root with the siblings that a shape places around it."""
    at = 0
    for place, size in zip(shape[::2], shape[1::2], strict=True):
        others = siblings[at : at + 64 * (size - 1)]
        node = sha256(others[: 64 * place] + node + others[64 * place :]).hexdigest().encode()
        at += len(others)
    return node


def leaves(docs: DataFrame, columns: Sequence[str] = COLUMNS, key: str = "lang", tampered: int = 3) -> DataFrame:
    """(key, id, digest, forged, tie): each row's leaf and the leaf after tampering, which lower-cases A-Z of ``text`` where
    ``tampered`` divides the CRC-32 of the id. The key of null is the empty string, other keys have a mark in front."""

    def made(batch: pa.RecordBatch) -> dict:
        values = [batch.column(f"c{k}").to_pylist() for k in range(len(columns))]
        digests, forged, text = [], [], columns.index("text")
        for id_, *row in zip(batch.column("id").to_pylist(), *values, strict=True):
            row = [None if v is None else v.encode() for v in row]
            digests.append(sha256(encoded(row)).digest())
            hit = id_ is not None and row[text] is not None and crc32(str(id_).encode()) % tampered == 0
            forged.append(sha256(encoded([*row[:text], row[text].lower(), *row[text + 1 :]])).digest() if hit else digests[-1])
        return {"key": batch.column("key"), "id": batch.column("id"), "digest": digests, "forged": forged}

    mark = F.coalesce(F.concat(F.lit("="), F.col(key)), F.lit("")).alias("key")
    rows = docs.select(mark, F.col("doc_id").alias("id"), *(F.col(c).cast("string").alias(f"c{k}") for k, c in enumerate(columns)))
    found = per_batch(rows, made, "key string, id long, digest binary, forged binary", f"c{columns.index('text')}")
    return cut(found.withColumn("tie", F.monotonically_increasing_id()))


def ranked(rows: DataFrame, *order: str) -> DataFrame:
    """``rows`` (key, …) with ``at``, the place of each in its key in ``order``, and ``n``, the rows of its key."""

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, n = None, 0  # rows come sorted by key
        for batch in batches:
            here = []
            for k in batch.column("key").to_pylist():
                n = n + 1 if k == last else 0
                last = k
                here.append(n)
            yield batch.append_column("here", pa.array(here, pa.int64()))

    spread = rows.repartitionByRange("key", *order).sortWithinPartitions("key", *order).withColumn("part", F.spark_partition_id())
    held = cut(spread.mapInArrow(placed, StructType([*spread.schema.fields, StructField("here", LongType())])))
    counts = held.groupBy("key", "part").agg(F.count("*").alias("rows"))  # a row for each part, and one for each key more
    before = Window.partitionBy("key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("key", "part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("base"), F.sum("rows").over(Window.partitionBy("key")).alias("n"))
    return held.join(base, ["key", "part"]).withColumn("at", F.col("base") + F.col("here")).drop("part", "here", "base")


def blocks(nodes: DataFrame, fanout: int, ids: bool = False) -> DataFrame:
    """Nodes (key, at, n, digest; with ``ids`` also id and forged) as a row for each aligned block, with the block's node."""
    size = fanout**LEVELS
    schema = "key string, block long, n long, digests binary, node binary" + ", ids array<bigint>, forged binary" * ids

    def made(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(held)
        key, block, n = (rows.column(c)[0].as_py() for c in ("key", "block", "n"))
        digests = b"".join(rows.column("digest").to_pylist())
        node = levels_of(hex_rows(digests), min(LEVELS, depth(n, fanout)), fanout)[-1].tobytes()
        out = {"key": [key], "block": [block], "n": [n], "digests": [digests], "node": [bytes.fromhex(node.decode())]}
        out |= {"ids": pa.array([rows.column("id").to_pylist()], pa.list_(pa.int64())), "forged": [b"".join(rows.column("forged").to_pylist())]} if ids else {}
        return pa.RecordBatch.from_pydict(out)

    def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, last = [], None  # the batches of one block
        for batch in batches:
            names = list(zip(batch.column("key").to_pylist(), batch.column("block").to_pylist(), strict=True))
            starts = [k for k in range(len(names)) if not k or names[k] != names[k - 1]]
            for a, b in zip(starts, [*starts[1:], len(names)], strict=True):
                if held and names[a] != last:
                    yield made(held)
                    held = []
                held.append(batch.slice(a, b - a))
                last = names[a]
        if held:
            yield made(held)

    rows = nodes.select("key", F.floor(F.col("at") / size).alias("block"), "at", "n", "digest", *(["id", "forged"] if ids else []))
    return cut(rows.repartition("key", "block").sortWithinPartitions("key", "block", "at").mapInArrow(gathered, schema))


def rounds(first: DataFrame, fanout: int) -> list[DataFrame]:
    """Tables of blocks, from the leaves' blocks to the round in which each key has one."""
    out = [first]
    while (out[-1].agg(F.max("block")).first()[0] or 0) > 0:
        nodes = out[-1].select("key", F.col("block").alias("at"), F.ceil(F.col("n") / fanout**LEVELS).alias("n"), F.col("node").alias("digest"))
        out.append(blocks(nodes, fanout))
    return out


def _carried(rows: DataFrame, fanout: int) -> DataFrame:
    """(key, at, siblings, shape, top, root) for each element of blocks with what their nodes need above them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                paths = Paths(levels_of(hex_rows(row["digests"]), min(LEVELS, depth(row["n"], fanout)), fanout), fanout)
                n = len(paths.place)
                at = row["block"] * fanout**LEVELS + np.arange(n)
                siblings = [x + row["siblings"] for x in paths.siblings()]
                shapes = [x + row["shape"] for x in paths.shapes()]
                yield pa.RecordBatch.from_pydict({"key": [row["key"]] * n, "at": pa.array(at, pa.int64()), "siblings": siblings, "shape": shapes, "top": [row["top"]] * n, "root": [row["root"]] * n})

    return rows.mapInArrow(run, "key string, at long, siblings binary, shape binary, top binary, root binary")


def downward(tables: list[DataFrame], top: DataFrame, fanout: int) -> DataFrame:
    """What the nodes of the first round's blocks need: (key, at, …) from ``top`` (key, siblings, shape, top, root)."""
    needed = top.withColumn("at", F.lit(0).cast("long"))
    for table in reversed(tables[1:]):
        both = table.select("key", F.col("block").alias("at"), "n", "digests").join(needed, ["key", "at"]).withColumnRenamed("at", "block")
        needed = _carried(both, fanout)
    return needed


def _proved(rows: DataFrame, fanout: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                held = hex_rows(row["digests"])
                paths = Paths(levels_of(held, min(LEVELS, depth(row["n"], fanout)), fanout), fanout)
                root, up = row["root"].decode(), {}
                ends = []
                for node in paths.folded(hex_rows(row["forged"])):
                    if node not in up:
                        up[node] = folded_up(node, row["siblings"], row["shape"]).decode()
                    ends.append(up[node])
                n = len(held)
                proofs = [sha256(x + row["siblings"]).hexdigest() for x in paths.siblings()]
                made = {"doc_id": pa.array(row["ids"], pa.int64()), "leaf": [x.tobytes().decode() for x in held], "subroot": [row["top"].decode()] * n, "root": [root] * n, "proof_sha256": proofs, "folded_root": ends, "verified": [x == root for x in ends]}
                yield pa.RecordBatch.from_pydict(made)

    return rows.mapInArrow(run, "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")


def _as_hex(node: Column) -> Column:
    return F.lower(F.hex(node)).cast("binary")


def manifest(docs: DataFrame, columns: Sequence[str] = COLUMNS, key: str = "lang", fanout: int = 8, tampered: int = 3) -> DataFrame:
    """doc_id, leaf, subroot, root, the digest of the proof, the root that the (tampered) leaf folds to, and whether it is the root."""
    own = rounds(blocks(ranked(leaves(docs, columns, key, tampered), "id", "digest", "tie"), fanout, ids=True), fanout)
    subroots = own[-1].select(F.lit("").alias("key"), F.col("key").alias("name"), F.col("node").alias("digest"))
    places = cut(ranked(subroots, "name"))
    over = rounds(blocks(places, fanout), fanout)
    empty = F.lit(b"").cast("binary")
    root = over[-1].select("key", empty.alias("siblings"), empty.alias("shape"), _as_hex(F.col("node")).alias("top"), _as_hex(F.col("node")).alias("root"))
    above = downward([over[0], *over], root, fanout)  # for each key's root: its blocks' elements are carried down, too
    top = above.join(places.select("at", "name", "digest"), "at").select(F.col("name").alias("key"), "siblings", "shape", _as_hex(F.col("digest")).alias("top"), "root")
    needed = downward(own, top, fanout).withColumnRenamed("at", "block")
    return _proved(own[0].join(needed, ["key", "block"]), fanout)
