"""Token files: canonical length-limited Huffman codes, independent blocks, and bit-offset checkpoints.

Ids are counted over the whole corpus; package-merge gives code lengths of at most ``most`` bits, and canonical codes follow
from the lengths alone, so the codebook is one length for each id. A block holds whole documents in ascending doc_id order:

    4 bytes   DHF2
    5 x u32   documents, tokens, checkpoints, tokens from one checkpoint to the next, documents without an id (the first ones)
    i64 each  doc_id of each document (0 for those without)
    u32 each  tokens of each document
    u32 each  bit offset of each checkpoint; every document begins with one, at a whole byte
    bytes     the codes, most significant bit first

A checkpoint is a place where decoding can begin, so a block is decoded along all its checkpoints at once: at each step a
window of ``most`` bits at each place is looked up in a table that gives the id and the length of its code.

The folder holds ``codebook`` (id, bits) and ``blocks`` (part, block, tokens of the part before the block, tokens, data), in
Parquet, so any store that Spark writes to will do. Parts are ranges of doc_id in ascending order; the ranges come from
quantiles of doc_id, so no range depends on a hot source or text. A doc_id that fills several quantiles has as many parts, and
rows without a doc_id have parts of their own by their share, in front. The encoded ids, which are written only to be counted
and coded, are deleted once the blocks stand; ``codebook`` and ``blocks`` stay until the caller, who reads them, deletes the folder.

Defined cases: a null or empty text is its end id alone; rows without a doc_id come first; rows with one doc_id (or none) stand
one after another in no particular order. An empty table gives files without blocks.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import per_batch, shared_folder, utf8
from .tokens import encoded

MAGIC = b"DHF2"
STEP = 128
BLOCK_TOKENS = 65_536
MOST_BITS = 18


def code_lengths(counts: np.ndarray, most: int = MOST_BITS) -> np.ndarray:
    """Optimal code lengths of at most ``most`` bits by package-merge; 0 for ids that don't occur."""
    used = np.flatnonzero(counts)
    out = np.zeros(len(counts), np.uint8)
    if len(used) < 2:
        out[used] = 1
        return out
    if len(used) > 1 << most:
        raise ValueError(f"{len(used)} ids don't fit codes of {most} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    weight = counts[order].astype(np.float64)
    packages, leaf = np.zeros(0), []
    for _ in range(most):
        merged = np.concatenate([weight, packages])
        rank = np.argsort(merged, kind="stable")
        leaf.append(rank < len(weight))
        merged = merged[rank]
        packages = merged[0 : len(merged) // 2 * 2 : 2] + merged[1 : len(merged) // 2 * 2 : 2]
    take, bits = 2 * len(weight) - 2, np.zeros(len(weight), np.int64)
    for level in reversed(leaf):
        leaves = int(level[:take].sum())
        bits[:leaves] += 1
        take = 2 * (take - leaves)
    out[order] = bits
    return out


def canonical(bits: np.ndarray) -> np.ndarray:
    """The canonical code of each id: codes ascend by (length, id)."""
    codes, used = np.zeros(len(bits), np.uint32), np.flatnonzero(bits)
    order = used[np.lexsort((used, bits[used]))]
    code, last = 0, 0
    for symbol in order.tolist():
        code <<= int(bits[symbol]) - last
        last = int(bits[symbol])
        codes[symbol] = code
        code += 1
    return codes


def lookup(bits: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Decoding table: for every window of the longest code's bits, the id and the length of the code it begins with."""
    top = int(bits.max()) if len(bits) else 0
    used = np.flatnonzero(bits)
    order = used[np.lexsort((used, bits[used]))]
    spread = 1 << (top - bits[order].astype(np.int64))
    ids, lengths = np.repeat(order, spread), np.repeat(bits[order], spread)
    rest = max(0, (1 << top) - len(ids))  # windows of an incomplete code
    return np.concatenate([ids, np.zeros(rest, np.int64)]).astype(np.uint32), np.concatenate([lengths, np.ones(rest, np.uint8)]).astype(np.int64), top


def write_bits(ids: np.ndarray, offsets: np.ndarray, codes: np.ndarray, bits: np.ndarray, step: int = STEP) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(code bytes of all documents, byte offsets of the documents, checkpoints as bit offsets in their document, number of
    checkpoints of each document)."""
    long = bits[ids].astype(np.int64)
    sums = np.concatenate([[0], np.cumsum(long)])
    size = -(-(sums[offsets[1:]] - sums[offsets[:-1]]) // 8)
    base = np.concatenate([[0], np.cumsum(size)])
    tokens = np.diff(offsets)
    inner = sums[:-1] - np.repeat(sums[offsets[:-1]], tokens)
    at = inner + np.repeat(base[:-1] * 8, tokens)
    value = codes[ids].astype(np.uint64) << (32 - long - (at & 7)).astype(np.uint64)
    out = np.zeros(int(base[-1]) + 4, np.float64)
    for k in range(4):
        out += np.bincount((at >> 3) + k, weights=((value >> np.uint64(24 - 8 * k)) & np.uint64(255)).astype(np.float64), minlength=len(out))[: len(out)]
    place = np.arange(len(ids)) - np.repeat(offsets[:-1], tokens)
    marks = place % step == 0
    return out[: int(base[-1])].astype(np.uint8), base, inner[marks].astype(np.uint32), -(-tokens // step)


def read_bits(data: np.ndarray, marks: np.ndarray, tokens: np.ndarray, step: int, table: tuple[np.ndarray, np.ndarray, int]) -> np.ndarray:
    """Ids of all documents: ``marks`` are the checkpoints' bit offsets in ``data``, ``tokens`` the documents' lengths."""
    n = -(-tokens // step)
    place = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    lane = np.minimum(step, np.repeat(tokens, n) - place * step)
    to = np.concatenate([[0], np.cumsum(lane)])[:-1]
    order = np.argsort(-lane, kind="stable")
    lane, to, at = lane[order], to[order], marks[order].astype(np.int64)
    padded = np.concatenate([data, np.zeros(4, np.uint8)]).astype(np.uint32)
    window = (padded[:-3] << 24) | (padded[1:-2] << 16) | (padded[2:-1] << 8) | padded[3:]
    ids, lengths, top = table
    mask, out = (1 << top) - 1, np.zeros(int(tokens.sum()), np.uint32)
    ends = np.searchsorted(-lane, -np.arange(step), "left")  # lanes longer than each step
    for k in range(step):
        live = int(ends[k])
        if not live:
            break
        spot = at[:live]
        seen = (window[spot >> 3].astype(np.int64) >> (32 - top - (spot & 7))) & mask
        out[to[:live] + k] = ids[seen]
        at[:live] += lengths[seen]
    return out


def make_block(doc_ids: list[int | None], tokens: list[int], marks: list[np.ndarray], data: list[bytes], step: int = STEP) -> bytes:
    starts = np.cumsum([0, *map(len, data)])[:-1] * 8
    places = np.concatenate([m.astype(np.int64) + s for m, s in zip(marks, starts, strict=True)]) if marks else np.zeros(0)
    nameless = sum(d is None for d in doc_ids)  # they come first
    head = MAGIC + struct.pack("<5I", len(doc_ids), sum(tokens), len(places), step, nameless)
    return b"".join([head, np.array([d or 0 for d in doc_ids], "<i8").tobytes(), np.array(tokens, "<u4").tobytes(), places.astype("<u4").tobytes(), *data])


def read_block(block: bytes, table: tuple[np.ndarray, np.ndarray, int]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(doc_ids, tokens of each document, ids of all documents)."""
    if block[:4] != MAGIC:
        raise ValueError("not a token block")
    docs, _, places, step, nameless = struct.unpack("<5I", block[4:24])
    at = 24
    doc_ids = pa.array(np.frombuffer(block, "<i8", docs, at).astype(np.int64), mask=np.arange(docs) < nameless)
    tokens = np.frombuffer(block, "<u4", docs, at := at + 8 * docs).astype(np.int64)
    marks = np.frombuffer(block, "<u4", places, at := at + 4 * docs)
    data = np.frombuffer(block, np.uint8, -1, at + 4 * places)
    return doc_ids, tokens, read_bits(data, marks, tokens, step, table)


def write_files(docs: DataFrame, folder: str, tokenizer: str, kind: str, end: int) -> None:
    """Encode (doc_id, text) into token files under ``folder``; needs no order and no bound on the documents."""
    spark: SparkSession = docs.sparkSession

    def ids_of(batch: pa.RecordBatch) -> dict:
        ids, offsets = encoded(batch.column("text"), tokenizer, kind, end, pieces=2_000_000)
        small = ids.astype("<u2") if not len(ids) or ids.max() < 65_536 else None
        flat = (ids.astype("<u4") if small is None else small).view(np.uint8)
        width = 4 if small is None else 2
        return {"doc_id": batch.column("doc_id"), "tokens": np.diff(offsets), "width": np.full(batch.num_rows, width, np.int32), "ids": binary(flat, offsets * width)}

    per_batch(docs.select("doc_id", "text"), ids_of, "doc_id long, tokens long, width int, ids binary").write.option("compression", "zstd").parquet(f"{folder}/ids")
    known = spark.read.parquet(f"{folder}/ids")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            for row in zip(batch.column("ids").to_pylist(), batch.column("width").to_pylist(), strict=True):
                seen = np.bincount(np.frombuffer(row[0], f"<u{row[1]}"))
                if len(seen) > len(total):
                    seen, total = total, seen.astype(np.int64)
                total[: len(seen)] += seen
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], names=["id", "n"])

    counted = known.select("ids", "width").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()  # one row for each id in use
    counts = np.zeros(1 + max((r.id for r in counted), default=0), np.int64)
    for r in counted:
        counts[r.id] = r.n
    bits = code_lengths(counts)
    codes = canonical(bits)
    spark.createDataFrame([(i, int(b)) for i, b in enumerate(bits.tolist()) if b], "id int, bits int").coalesce(1).write.parquet(f"{folder}/codebook")

    def encode(batch: pa.RecordBatch) -> dict:
        raw, ends = utf8(batch.column("ids"))
        width = batch.column("width").to_numpy()
        tokens = batch.column("tokens").to_numpy()
        if (width == 2).all():
            ids = raw.view("<u2")
        else:
            ids = np.concatenate([raw[a:b].view(f"<u{w}") for a, b, w in zip(ends[:-1], ends[1:], width, strict=True)]).astype(np.uint32)
        data, base, marks, n = write_bits(ids, np.concatenate([[0], np.cumsum(tokens)]), codes, bits)
        return {"doc_id": batch.column("doc_id"), "tokens": tokens, "marks": binary(marks.astype("<u4").view(np.uint8), np.concatenate([[0], np.cumsum(n)]) * 4), "data": binary(data, base)}

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    seen = known.agg(F.percentile_approx("doc_id", [k / parts for k in range(1, parts)], 10_000) if parts > 1 else F.lit(None), F.count("*"), F.count_if(F.col("doc_id").isNull())).first()
    bounds = F.array(*map(F.lit, sorted(seen[0] or []))).cast("array<bigint>")
    nameless = -(-parts * seen[2] // max(1, seen[1]))
    mark = F.xxhash64("data")
    below = F.size(F.filter(bounds, lambda x: x < F.col("doc_id")))
    equal = F.size(F.filter(bounds, lambda x: x == F.col("doc_id")))
    placed = nameless + below + F.when(equal > 0, 1 + F.pmod(mark, F.greatest(equal, F.lit(1)))).otherwise(0)
    part = F.when(F.col("doc_id").isNull(), F.pmod(mark, F.lit(max(1, nameless)))).otherwise(placed).cast("int")
    coded = per_batch(known, encode, "doc_id long, tokens long, marks binary, data binary", "ids")
    dealt = coded.withColumn("part", part).repartitionById(nameless + parts, F.col("part")).sortWithinPartitions("part", "doc_id")

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, held, size, number, done, own = ["part", "block", "before", "tokens", "data"], [], 0, 0, 0, None

        def flush() -> pa.RecordBatch:
            data = make_block(*([r[k] for r in held] for k in range(4)))
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip((own, number, done, size, data), (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()), strict=True)], names=names)

        for batch in batches:
            for p, doc, tokens, marks, data in zip(*(batch.column(c).to_pylist() for c in ("part", "doc_id", "tokens", "marks", "data")), strict=True):
                if held and (p != own or size >= BLOCK_TOKENS):
                    yield flush()
                    held, number, done, size = [], number + 1, done + size, 0
                if p != own:
                    own, number, done = p, 0, 0
                held.append((doc, tokens, np.frombuffer(marks, "<u4"), data))
                size += tokens
        if held:
            yield flush()

    dealt.mapInArrow(blocks, "part int, block long, before long, tokens long, data binary").write.option("compression", "none").parquet(f"{folder}/blocks")
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/ids")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def binary(flat: np.ndarray, ends: np.ndarray) -> pa.Array:
    """A binary column over one buffer."""
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(flat))])


def read_files(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start (tokens of all documents before it), n_tokens, ids_crc32 from the files alone."""
    book = spark.read.parquet(f"{folder}/codebook").collect()  # one row for each id in use
    bits = np.zeros(1 + max((r.id for r in book), default=0), np.uint8)
    for r in book:
        bits[r.id] = r.bits
    stored = spark.read.schema("part int, block long, before long, tokens long, data binary").parquet(f"{folder}/blocks")
    totals = stored.groupBy("part").agg(F.sum("tokens").alias("tokens"))
    parts = dict(totals.select("part", F.sum("tokens").over(Window.orderBy("part")) - F.col("tokens")).collect())  # one row for each part

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = lookup(bits)
        for batch in batches:
            for part, before, data in zip(*(batch.column(c).to_pylist() for c in ("part", "before", "data")), strict=True):
                docs, tokens, ids = read_block(data, table)
                ends = np.concatenate([[0], np.cumsum(tokens)])
                ids = ids.astype("<u4")
                crc = [crc32(ids[a:b].data) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([docs, pa.array(ends[:-1] + before + parts[part]), pa.array(tokens), pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return stored.select("part", "before", "data").mapInArrow(decode, "doc_id long, start long, n_tokens long, ids_crc32 long")


def round_trip(docs: DataFrame, tokenizer: str, kind: str = "spaced", end: int = 0) -> DataFrame:
    """Write token files in the shared folder and read every document back from them."""
    folder = shared_folder(docs.sparkSession, "tokens")
    write_files(docs, folder, tokenizer, kind, end)
    return read_files(docs.sparkSession, folder)
