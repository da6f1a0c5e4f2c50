"""Near-duplicate documents by HyperMinHash.

A document's set is its distinct shingles of ``words`` words, as 64-bit hashes. A HyperMinHash register keeps, of the
smallest hash in its bucket, the number of leading zeros and ten mantissa bits: 16 bits instead of 64. Empty registers are
filled from others of the same document by a fixed sequence of random places (optimal densification), so short documents
are banded as sharply as long ones. Registers are banded; documents that share a band are candidates.

What follows is exact on the candidates. Equal sets are one class and only its smallest id goes on. Each bucket hangs its
members on its smallest one, its hub, so a bucket of n gives n pairs; these are judged by sketches, the low byte of every
register: a pair whose estimate lies more than five standard deviations below the threshold isn't near. Members near their hub
are joined by it; only the others, the bucket's open ones, are searched by sketches, among themselves and against the joined.
Where more than ``members`` are open, the bucket is parted first: its documents get a key for each two such buckets that they
are both in, which is a band of twice the length, and hubs again, and only what stays open there is searched. Components of
what is near, and not of what merely shares a bucket, are then searched for true links inside: from each document reached, those
not yet reached are compared, first by the collision-corrected estimate of the registers, then on full sets. As linked documents
leave the search, a group of near copies costs about one comparison a document. A component of more than ``most`` shingles is
dealt to blocks, each document to one and the smallest to all; then only what isn't linked with the largest part so found is
open. Open documents too are dealt to blocks, and each pair of blocks of which one is open is a task, so no task holds more than
two blocks and no pair is left out.

The 384 registers are cut into bands of as many registers as still miss a pair at the threshold with a probability of at most
``MISS``: at 0.85 48 bands of 8, (1 - 0.85^8)^48 = 2.4e-7; at 0.8 64 bands of 6, 3.6e-9. A pair whose only common buckets are parted
must share two: it is missed with 4.4e-6 and 8.4e-8. A link is lost only where no other path joins its documents.

Defined cases: null, empty and blank texts have an empty set and link with nothing; fewer words than a shingle are one
sequence; copies link; rows that share a doc_id count as one document; a row without an id joins its
copies' component and has none otherwise; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, per_batch, slices, utf8
from .graph import components

REGISTERS = 384
MISS = 1e-6
MANTISSA = 10
_EMPTY = np.uint16(65_535)
_RNG = np.random.default_rng(20_240_601)
_BYTE = _RNG.integers(0, 1 << 64, 256, np.uint64, endpoint=False)
_PLACE = _RNG.integers(0, 1 << 64, 64, np.uint64, endpoint=False) | np.uint64(1)
_BAND = _RNG.integers(0, 1 << 64, REGISTERS, np.uint64, endpoint=False) | np.uint64(1)
_FILL = _RNG.integers(0, REGISTERS, (24, REGISTERS))
_BASE = np.uint64(0x9E3779B97F4A7C15)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(raw: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each lower-cased word, offsets of the documents among the words)."""
    raw = _LOWER[raw]
    inside = ~_SPACE[raw]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    bounds = ends[:-1][ends[:-1] < len(raw)]
    first[bounds] = inside[bounds]  # a document's first byte begins a word even where the one before ends in one
    place = np.flatnonzero(inside)
    if not len(place):
        return np.zeros(0, np.uint64), np.zeros(len(ends), np.int64)
    starts = np.flatnonzero(first[place])
    sizes = np.diff(np.concatenate([starts, [len(place)]]))
    within = np.arange(len(place)) - np.repeat(starts, sizes)
    power = np.concatenate([[np.uint64(1)], np.cumprod(np.full(int(sizes.max()), _BASE, np.uint64))])
    hashes = mix(np.add.reduceat(_BYTE[raw[place]] * power[within], starts) + sizes.astype(np.uint64))
    return hashes, np.searchsorted(place[starts], ends)


def shingle_sets(raw: np.ndarray, ends: np.ndarray, words: int = 5) -> list[np.ndarray]:
    """Each document's set as ascending 64-bit hashes."""
    hashes, at = word_hashes(raw, ends)
    padded = np.concatenate([hashes, np.zeros(words, np.uint64)])
    rolled = np.zeros(len(hashes), np.uint64)
    for k in range(words):
        rolled += padded[k : k + len(hashes)] * _PLACE[k]
    rolled = mix(rolled + np.uint64(words))
    out = []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        if b - a >= words:
            own = np.sort(rolled[a : b - words + 1])
            out.append(own[np.concatenate([[True], own[1:] != own[:-1]])])
        elif b > a:
            out.append(mix(np.array([(hashes[a:b] * _PLACE[: b - a]).sum(dtype=np.uint64) + np.uint64(b - a)], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def registers(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(filled registers of each set, number of registers that were not empty). An empty set keeps empty registers."""
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    out = np.full((len(sets), REGISTERS), _EMPTY)
    if not sizes.sum():
        return out, np.zeros(len(sets), np.int64)
    flat, row = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
    scaled = (flat >> np.uint64(32)) * np.uint64(REGISTERS)
    bucket = (scaled >> np.uint64(32)).astype(np.int64)  # ascends with the hash, so a bucket's first hash is its smallest
    first = np.concatenate([[True], (bucket[1:] != bucket[:-1]) | (row[1:] != row[:-1])])
    part, exponent = np.frexp(np.maximum(scaled[first] & np.uint64(0xFFFFFFFF), 1).astype(np.float64))
    value = ((32 - exponent) << MANTISSA) + ((2 * part - 1) * (1 << MANTISSA)).astype(np.int64)
    out[row[first], bucket[first]] = value.astype(np.uint16)
    own = out.copy()
    filled = (own != _EMPTY).sum(1)
    for places in _FILL:
        r, c = np.nonzero((out == _EMPTY) & (filled > 0)[:, None])
        if not len(r):
            break
        out[r, c] = own[r, places[c]]
    left = np.flatnonzero((out == _EMPTY).any(1) & (filled > 0))
    if len(left):  # the next register in a circle
        twice = np.concatenate([own[left], own[left]], 1)
        at = np.where(twice != _EMPTY, np.arange(2 * REGISTERS), 2 * REGISTERS)
        at = np.minimum.accumulate(at[:, ::-1], 1)[:, ::-1][:, :REGISTERS]
        out[left] = np.where(out[left] == _EMPTY, np.take_along_axis(twice, at, 1), out[left])
    return out, filled


def banding(percent: int) -> tuple[int, int]:
    """(bands, registers in each): the longest bands that miss a pair at the threshold with probability ``MISS`` at most."""
    fits = [rows for rows in range(1, 33) if (1 - (percent / 100) ** rows) ** (REGISTERS // rows) <= MISS]
    rows = max(fits, default=1)
    return REGISTERS // rows, rows


def band_keys(filled: np.ndarray, percent: int) -> np.ndarray:
    bands, rows = banding(percent)
    parts = filled[:, : bands * rows].reshape(len(filled), bands, rows).astype(np.uint64) + np.uint64(1)
    return mix((parts * _BAND[: bands * rows].reshape(bands, rows)).sum(2, dtype=np.uint64) + np.arange(bands, dtype=np.uint64) * _BASE).view(np.int64)


def estimate(one: np.ndarray, many: np.ndarray, size: int, sizes: np.ndarray) -> np.ndarray:
    """Jaccard estimates, less the collisions that different sets of these sizes are expected to have by chance."""
    ratio = sizes / size
    chance = 0.169919487159739093975315012348 * 4 * ratio / (1 + ratio) ** 2 * 2.0**-MANTISSA
    return (many == one).mean(1) - chance


def sketch_of(filled: np.ndarray) -> np.ndarray:
    """The low byte of every register."""
    return (filled & 0xFF).astype(np.uint8)


def trust(used: np.ndarray) -> np.ndarray:
    """How many independent registers as many are worth of which ``used`` were their own and the others copies of those."""
    used = np.maximum(used, 1)
    copies = (REGISTERS - used) / used  # of each one, as often as chance has it
    return REGISTERS**2 / (used * ((1 + copies) ** 2 + copies))


def near(one: tuple, many: tuple, percent: int) -> np.ndarray:
    """May each of ``many`` (sketches, used registers, set sizes) be linked with ``one``, by its size and sketch?"""
    (sketch, used, size), (sketches, uses, sizes) = one, many
    out = 100 * np.minimum(sizes, size) >= percent * np.maximum(sizes, size)
    spread = 5 * np.sqrt(percent / 100 * (1 - percent / 100) / trust(np.minimum(uses, used)))
    out &= (sketches == sketch).mean(-1) >= percent / 100 - spread
    return out


def reached(left: np.ndarray, linked) -> Iterator[tuple[int, int]]:
    """(first of its group, member) for all of ``left`` that ``linked(x, others)``, which gives those of ``others`` linked with x, joins."""
    while len(left):
        root, left = int(left[0]), left[1:]
        front = [root]
        while front and len(left):
            found = linked(front.pop(), left)
            for k in found.tolist():
                yield root, k
            front += found.tolist()
            left = left[~np.isin(left, found)] if len(found) else left


def joined(is_open: np.ndarray, linked) -> Iterator[tuple[int, int]]:
    """Pairs that join the open as all links do, with each other and with the rest, which is joined already."""
    left, rest = np.flatnonzero(is_open), np.flatnonzero(~is_open)
    home, done = {}, set()
    for a, b in reached(left, linked):
        home[b] = a
        yield a, b
    for x in left.tolist():
        group = home.get(x, x)
        if len(rest) and group not in done:
            found = linked(x, rest)
            if len(found):
                done.add(group)
                yield x, int(found[0])


def bucket_links(ids: np.ndarray, is_open: np.ndarray, sketches: np.ndarray, used: np.ndarray, sizes: np.ndarray, percent: int) -> Iterator[tuple[int, int]]:
    """(id, id) edges that join the open documents of one bucket as near pairs do."""

    def linked(x: int, others: np.ndarray) -> np.ndarray:
        return others[near((sketches[x], used[x], sizes[x]), (sketches[others], used[others], sizes[others]), percent)]

    for a, b in joined(is_open, linked):
        yield int(ids[a]), int(ids[b])


def links(ids: list[int], is_open: np.ndarray, sets: list[np.ndarray], filled: np.ndarray, used: np.ndarray, percent: int) -> Iterator[tuple[int, int]]:
    """(id, id) edges that join the open documents of this group as true links do."""
    order = np.argsort(np.array(ids), kind="stable")
    ids, is_open, sets, filled, used = [ids[k] for k in order], is_open[order], [sets[k] for k in order], filled[order], used[order]
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    own = trust(used)

    def linked(x: int, rest: np.ndarray) -> np.ndarray:
        n = sizes[rest]
        close = 100 * np.minimum(n, sizes[x]) >= percent * np.maximum(n, sizes[x])
        spread = 5 * np.sqrt(percent / 100 * (1 - percent / 100) / np.minimum(own[rest], own[x]))
        close[close] = estimate(filled[x], filled[rest[close]], sizes[x], n[close]) >= percent / 100 - spread[close]
        tried = rest[close]
        if not len(tried):
            return tried
        flat, n = np.concatenate([sets[k] for k in tried]), sizes[tried]
        at = np.minimum(np.searchsorted(sets[x], flat), len(sets[x]) - 1)
        shared = np.add.reduceat((sets[x][at] == flat).astype(np.int64), np.cumsum(n) - n)
        return tried[100 * shared >= percent * (n + sizes[x] - shared)]

    for a, b in joined(is_open, linked):
        yield ids[a], ids[b]


def in_blocks(members: DataFrame, group: str, node: str, size: Column, most: int) -> DataFrame:
    """``members`` (with a boolean ``open``) with i and j: the open and the rest of a group are dealt to blocks of about ``most``
    of ``size`` each, and each pair of blocks of which one is open is (group, i, j). A group that fits is one block; one without
    open members has none."""
    total = lambda which: F.sum(F.when(which, size).otherwise(0))
    fits = F.sum(size) <= most
    blocks = members.groupBy(group).agg(
        F.when(fits, 1).otherwise(F.ceil(total(F.col("open")) / most)).cast("int").alias("opens"),
        F.when(fits, 0).otherwise(F.ceil(total(~F.col("open")) / most)).cast("int").alias("rests"),
        F.max("open").alias("some"),
    ).filter("some").drop("some")
    place, last = F.xxhash64(node), F.col("opens") + F.col("rests") - 1
    own = F.when(F.col("open") | (last == 0), F.pmod(place, "opens")).otherwise(F.col("opens") + F.pmod(place, F.greatest("rests", F.lit(1)))).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.when(F.col("open"), last).otherwise(F.col("opens") - 1)))
    dealt = members.join(blocks, group).withColumns({"own": own, "other": other}).filter("opens + rests = 1 or own <> other")
    return dealt.withColumns({"i": F.least("own", "other"), "j": F.greatest("own", "other")}).drop("own", "other", "opens", "rests")


def doubled(sketched: DataFrame, heavy: DataFrame) -> DataFrame:
    """(rep, key) for each two of the buckets ``heavy`` (key) that a text of ``sketched`` is in; a text is in few, its bands."""
    keys = sketched.select("rep", "h1", "h2", F.explode("bands").alias("key")).join(heavy, "key", "left_semi")
    keys = keys.groupBy("rep", "h1", "h2").agg(F.sort_array(F.collect_set("key")).alias("keys"))
    pairs = F.transform("keys", lambda x, i: F.transform(F.slice("keys", i + 2, F.size("keys")), lambda y: F.xxhash64(x, y)))
    return keys.select("rep", F.explode(F.flatten(pairs)).alias("key"))


def candidate_links(sketched: DataFrame, percent: int, members: int) -> DataFrame:
    """(a, b) edges that join the documents of ``sketched`` (rep, h1, h2, bands, sketch, used, n) which share a band and are near.
    A rep with several texts has a sketch for each."""
    sketch = ("sketch", "used", "n")

    def stacked(batch: pa.RecordBatch, prefix: str = "") -> tuple:
        flat, _ = utf8(batch.column(f"{prefix}sketch"))
        return flat.reshape(batch.num_rows, -1), batch.column(f"{prefix}used").to_numpy(), batch.column(f"{prefix}n").to_numpy()

    def judge(batch: pa.RecordBatch) -> dict:
        return {"rep": batch.column("rep"), "hub": batch.column("hub"), "near": pa.array(near(stacked(batch), stacked(batch, "hub_"), percent))}

    def with_hubs(rows: DataFrame) -> DataFrame:
        """(rep, key, hub) of the buckets that several documents share."""
        hubs = cut(rows.groupBy("key").agg(F.min("rep").alias("hub"), F.max("rep").alias("last")).filter("hub < last").select("key", "hub"))
        return cut(rows.join(hubs, "key"))

    def settled(shared: DataFrame) -> tuple[DataFrame, DataFrame | None]:
        """(edges to near hubs; key, rep and open of the buckets in which a member isn't near its hub)."""
        pairs = shared.filter("rep > hub").select("rep", "hub").distinct()
        pairs = pairs.join(known, "rep").join(known.select(F.col("rep").alias("hub"), *(F.col(c).alias(f"hub_{c}") for c in sketch)), "hub")
        judged = cut(per_batch(pairs, judge, "rep long, hub long, near boolean", "sketch"))
        edges = judged.filter("near").select(F.col("rep").alias("a"), F.col("hub").alias("b"))
        far = judged.filter("not near")
        if far.isEmpty():
            return edges, None
        far = far.select("rep", "hub", F.lit(True).alias("open")).distinct()
        marked = cut(shared.join(far, ["rep", "hub"], "left").select("key", "rep", F.coalesce("open", F.lit(False)).alias("open")).distinct())
        return edges, cut(marked.join(marked.filter("open").select("key").distinct(), "key", "left_semi"))

    shared = with_hubs(sketched.select("rep", F.explode("bands").alias("key")))
    known = sketched.join(shared.select("rep").distinct(), "rep", "left_semi").groupBy("rep", "h1", "h2").agg(*(F.first(c).alias(c) for c in sketch))
    known = cut(known.select("rep", *sketch))
    edges, inside = settled(shared)
    if inside is None:
        return edges
    heavy = cut(inside.filter("open").groupBy("key").count().filter(F.col("count") > members).select("key"))
    if not heavy.isEmpty():
        more, parted = settled(with_hubs(cut(doubled(sketched, heavy))))
        edges, inside = edges.union(more), inside.join(heavy, "key", "left_anti")
        inside = inside if parted is None else inside.union(parted)
    group = ["key", "i", "j"]
    grouped = in_blocks(inside, "key", "rep", F.lit(1), members).join(known, "rep").repartition(*group).sortWithinPartitions(*group, "rep")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, held in grouped_rows(batches, group):
            parts = [stacked(b) for b in held]
            ids, is_open = (np.concatenate([b.column(c).to_numpy(zero_copy_only=False) for b in held]) for c in ("rep", "open"))
            if len(ids) > 1:
                found = list(bucket_links(ids, is_open, *(np.concatenate([p[k] for p in parts]) for k in range(3)), percent))
                yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)], names=["a", "b"])

    return edges.union(grouped.mapInArrow(search, "a long, b long"))


def grouped_rows(batches: Iterator[pa.RecordBatch], group: list[str]) -> Iterator[tuple[tuple, list[pa.RecordBatch]]]:
    """(key, its batches) for each run of equal ``group`` columns."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(c).to_numpy() for c in group]
        edge = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], 0)) + 1
        for a, b in zip([0, *edge.tolist()], [*edge.tolist(), batch.num_rows], strict=True):
            key = tuple(int(c[a]) for c in columns)
            if key != last and held:
                yield last, held
                held = []
            last = key
            held.append(batch.slice(a, b - a))
    if held:
        yield last, held


def near_duplicates(docs: DataFrame, percent: int = 85, words: int = 5, most: int = 2_000_000, members: int = 10_000) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for each row of ``docs`` (doc_id, text)."""
    docs = docs.select("doc_id", "text")
    bands, _ = banding(percent)

    def sketch(batch: pa.RecordBatch) -> dict:
        sets = shingle_sets(*utf8(batch.column("text")), words)
        filled, used = registers(sets)
        sizes = np.fromiter(map(len, sets), np.int64, len(sets))
        keys = band_keys(filled, percent)[sizes > 0]
        ends = np.concatenate([[0], np.cumsum((sizes > 0) * bands)])
        sums = np.array([[x.sum(dtype=np.uint64), mix(x + _BASE).sum(dtype=np.uint64)] for x in sets], np.uint64).view(np.int64)
        return {"doc_id": batch.column("doc_id"), "n_shingles": sizes, "h1": sums[:, 0], "h2": sums[:, 1], "used": used, "sketch": [r.tobytes() for r in sketch_of(filled)], "bands": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(keys.ravel()))}

    known = cut(per_batch(docs, sketch, "doc_id long, n_shingles long, h1 long, h2 long, used long, sketch binary, bands array<long>"))
    equal = ["n_shingles", "h1", "h2"]
    shown = known.filter("n_shingles > 0 and doc_id is not null")
    classes = cut(shown.groupBy(*equal).agg(F.min("doc_id").alias("rep")))
    chosen = shown.join(classes.select(F.col("rep").alias("_rep")), F.col("doc_id") == F.col("_rep"), "left_semi")
    sketched = cut(chosen.select(F.col("doc_id").alias("rep"), "h1", "h2", "bands", "sketch", "used", F.col("n_shingles").alias("n")))
    candidates = components(candidate_links(sketched, percent, members))

    placed_in = cut(candidates.join(classes.groupBy("rep").agg(F.max("n_shingles").alias("n")), candidates.node == F.col("rep")).select("node", "root", "n"))
    group = ["root", "i", "j"]

    def true_links(dealt: DataFrame) -> DataFrame:
        """(a, b) edges inside the groups (root, i, j) to which documents (node, open) are dealt."""
        rows = docs.join(dealt, docs.doc_id == dealt.node).select(*group, "node", "open", "text")
        return rows.repartition(*group).sortWithinPartitions(*group).mapInArrow(search, "a long, b long")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        last = None

        def found() -> pa.RecordBatch:
            ids, is_open, sets, filled, used = zip(*held, strict=True)
            pairs = list(links(list(ids), np.array(is_open), list(sets), np.stack(filled), np.array(used), percent))
            return pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1)], names=["a", "b"])

        for batch in batches:
            for part in slices(batch, "text"):
                sets = shingle_sets(*utf8(part.column("text")), words)
                filled, used = registers(sets)
                keys = zip(*(part.column(c).to_pylist() for c in group), strict=True)
                for key, row in zip(keys, zip(part.column("node").to_pylist(), part.column("open").to_pylist(), sets, filled, used, strict=True), strict=True):
                    if key != last and len(held) > 1:
                        yield found()
                    if key != last:
                        held, last = [], key
                    held.append(row)
        if len(held) > 1:
            yield found()

    parts = placed_in.groupBy("root").agg(F.ceil(F.sum("n") / most).cast("int").alias("parts"))
    own = F.when(F.col("node") == F.col("root"), F.sequence(F.lit(0), F.col("parts") - 1)).otherwise(F.array(F.pmod(F.xxhash64("node"), "parts").cast("int")))
    dealt = placed_in.join(parts, "root").withColumn("i", F.explode(own))
    edges = true_links(dealt.select("node", "root", "i", F.lit(0).alias("j"), F.lit(True).alias("open")))
    large = cut(parts.filter("parts > 1").select("root"))
    if not large.isEmpty():
        edges = cut(edges)
        within = placed_in.join(large, "root", "left_semi")
        found = components(edges.join(within.select(F.col("node").alias("a")), "a", "left_semi")).withColumnRenamed("root", "part")
        within = cut(within.join(found, "node", "left").withColumn("part", F.coalesce("part", "node")))
        counted = within.groupBy("root", "part").agg(F.count("*").alias("of"))
        main = counted.groupBy("root").agg(F.max_by("part", F.struct("of", "part")).alias("main"))
        apart = cut(within.join(main, "root").select("node", "root", "n", (F.col("part") != F.col("main")).alias("open")))
        edges = edges.union(true_links(in_blocks(apart, "root", "node", F.col("n"), most).select("node", "root", "i", "j", "open")))
    linked = components(edges)
    roots = linked.select(F.col("node").alias("rep"), "root")
    placed = known.select("doc_id", *equal).join(classes, equal, "left").join(roots, "rep", "left")
    component = F.coalesce("root", "rep", "doc_id")
    return placed.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, component.isNull()).alias("kept"))
