"""Near duplicates and components against all pairs."""

import numpy as np

from docketloom.llm.graph import components
from docketloom.llm import neardup
from docketloom.llm.neardup import REGISTERS, estimate, near, near_duplicates, registers, shingle_sets, sketch_of, trust


def brute(rows, percent=85, k=5):
    sets = []
    for _, text in rows:
        w = bytes((text or "").encode()).lower().split()
        sets.append({tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set())
    ids = [i for i, _ in rows]
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(ids[a]), find(ids[b])))
                root[y] = x
    return {i: (len(s), find(i)) for i, s in zip(ids, sets)}


def made_corpus(seed, n=40):
    rng = np.random.default_rng(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows, base = [], []
    for i in range(n):
        if base and rng.random() < 0.7:
            words = list(base[rng.integers(len(base))])
            for _ in range(rng.integers(0, 4)):
                words[rng.integers(len(words))] = "X" + str(rng.integers(1000))
        else:
            words = [vocabulary[k] for k in rng.integers(0, 400, rng.choice([1, 3, 5, 7, 40, 120, 300]))]
            base.append(words)
        rows.append((i * 3 + 1, " ".join(words).upper() if rng.random() < 0.3 else " ".join(words)))
    return [*rows, (0, None), (2, ""), (5, " \n\t ")]


def got(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


def test_against_all_pairs(spark):
    for seed in (1, 2):
        rows = made_corpus(seed)
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
        want = brute(rows)
        assert got(near_duplicates(docs)) == want
        assert got(near_duplicates(docs, most=400, members=3)) == want  # buckets parted, groups dealt to blocks


def test_odd_documents(spark, odd_docs):
    rows = near_duplicates(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by = {r.doc_id: r for r in rows}
    assert by[0].n_shingles == by[1].n_shingles == 0 and by[0].component_id == 0 and by[0].kept
    assert by[10].component_id == 9 and not by[10].kept
    assert near_duplicates(odd_docs.limit(0)).count() == 0


def test_estimate_is_close():
    rng = np.random.default_rng(5)
    words = [f"t{k}" for k in rng.integers(0, 10_000, 3000)]
    other = list(words)
    for k in range(0, 3000, 60):
        other[k] = "q"
    raw = [" ".join(words).encode(), " ".join(other).encode()]
    sets = shingle_sets(np.frombuffer(b"".join(raw), np.uint8), np.array([0, len(raw[0]), len(raw[0]) + len(raw[1])]))
    filled, _ = registers(sets)
    a, b = map(set, (x.tolist() for x in sets))
    assert abs(estimate(filled[0], filled[1:], len(a), np.array([len(b)]))[0] - len(a & b) / len(a | b)) < 0.1


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 200), (200, 100), (7, 7), (300, 299)]
    found = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert found == {**{i: 0 for i in range(61)}, 100: 100, 200: 100, 299: 299, 300: 299}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_half_a_template_makes_no_candidates(spark):
    """Pages that share half their text share buckets, but neither chain nor meet in one group."""
    rng = np.random.default_rng(6)
    template = [f"t{k}" for k in rng.integers(0, 10_000, 260)]
    rows = [(i, " ".join([*template, *(f"w{k}" for k in rng.integers(0, 50_000, 150))])) for i in range(400)]
    rows += [(400 + i, rows[i][1] + " more") for i in range(10)]
    seen = []
    components = neardup.components
    neardup.components = lambda edges: seen.append(edges.count()) or components(edges)
    try:
        found = got(near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)))
    finally:
        neardup.components = components
    assert {i: root for i, (_, root) in found.items()} == {**{i: i for i in range(400)}, **{400 + i: i for i in range(10)}}
    assert seen[0] < 200 and seen[1] == 10


def template_pages(seed, n=160):
    """Pages that share three quarters of their text, near copies of some, and chains of small changes away from one page."""
    rng = np.random.default_rng(seed)
    template = [f"t{k}" for k in rng.integers(0, 10_000, 300)]
    pages = [[*template, *(f"w{k}" for k in rng.integers(0, 50_000, 60))] for _ in range(n)]
    for k in range(0, n // 4):
        pages.append([*pages[k], *(f"more{k}x{j}" for j in range(k % 9))])
    chain = list(pages[5])
    for k in range(24):
        chain = [*chain[:-6], *(f"c{k}x{j}" for j in range(6))] if k % 2 else [f"d{k}x{j}" for j in range(8)] + chain[8:]
        pages.append(list(chain))
    order = rng.permutation(len(pages))
    return [(int(i), " ".join(page)) for i, page in zip(order, pages)]


def test_a_bucket_of_mutually_far_pages_is_parted(spark):
    rows = template_pages(8)
    docs, want = spark.createDataFrame(rows, "doc_id long, text string").repartition(4), brute(rows)
    assert len({root for _, root in want.values()}) < len(rows) - 40
    parted = []
    doubled = neardup.doubled
    neardup.doubled = lambda *frames: parted.append(1) or doubled(*frames)
    try:
        assert got(near_duplicates(docs)) == want and not parted
        assert got(near_duplicates(docs, members=8)) == want and parted
        assert got(near_duplicates(docs, members=8, most=3000)) == want
    finally:
        neardup.doubled = doubled


def test_keys_of_two_buckets(spark):
    texts = [(1, 10, 10, [5, 6, 7, 8]), (2, 11, 11, [6, 7, 5]), (2, 12, 12, [5, 9]), (3, 13, 13, [])]
    sketched = spark.createDataFrame(texts, "rep long, h1 long, h2 long, bands array<long>")
    heavy = spark.createDataFrame([(5,), (6,), (7,)], "key long")
    found = [(r.rep, r.key) for r in neardup.doubled(sketched, heavy).collect()]
    keys = {k for _, k in found}
    assert len(found) == 6 and len(keys) == 3 and {i for i, _ in found} == {1, 2}  # one key for each two, the same in both


def test_blocks_hold_each_open_pair_and_are_bounded(spark):
    rng = np.random.default_rng(9)
    for n, share, most in ((40, 0.5, 7), (40, 1.0, 7), (30, 0.1, 6), (5, 0.4, 9), (12, 0.0, 4)):
        rows = [(0, k, bool(rng.random() < share)) for k in range(n)]
        dealt = neardup.in_blocks(spark.createDataFrame(rows, "g int, x long, open boolean"), "g", "x", neardup.F.lit(1), most).collect()
        tasks = {}
        for r in dealt:
            tasks.setdefault((r.i, r.j), set()).add(r.x)
        held = {frozenset((a, b)) for t in tasks.values() for a in t for b in t if a != b}
        assert {frozenset((a, b)) for _, a, x in rows for _, b, y in rows if a != b and (x or y)} <= held
        assert len(dealt) == sum(map(len, tasks.values()))  # nobody is twice in a task
        if share == 0.1:  # the rest is copied once for each block of the open
            opens = -(-sum(x for *_, x in rows) // most)
            assert all(sum(k in t for t in tasks.values()) == opens for _, k, x in rows if not x)


def test_a_large_group_is_joined_without_all_pairs_of_blocks(spark):
    """Near copies of one page: after one pass over their blocks nothing is open."""
    rng = np.random.default_rng(10)
    page = [f"p{k}" for k in rng.integers(0, 10_000, 200)]
    rows = [(i, " ".join([*page, f"own{i}"])) for i in range(120)] + [(500 + i, " ".join([*page[:160], *(f"o{i}x{j}" for j in range(12))])) for i in range(3)]
    dealt, in_blocks = [], neardup.in_blocks

    def watched(members, *rest):
        dealt.append(members.filter("open").count())
        return in_blocks(members, *rest)

    neardup.in_blocks = watched
    try:
        assert got(near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), most=2500)) == brute(rows)
    finally:
        neardup.in_blocks = in_blocks
    assert dealt[-1] <= 3


def test_near_misses_no_link():
    rng = np.random.default_rng(7)
    missed = 0
    for n in (3, 20, 60, 200, 900):
        for _ in range(60):
            both = rng.integers(0, 1 << 63, n, np.uint64)
            k = max(0, int(n * 0.15 / 1.85) - 1) // 1
            sets = [np.unique(np.concatenate([both, rng.integers(0, 1 << 63, k // 2 + k % 2 * j, np.uint64)])) for j in (0, 1)]
            shared = len(np.intersect1d(*sets))
            if 100 * shared < 85 * (len(sets[0]) + len(sets[1]) - shared):
                continue
            filled, used = registers(sets)
            sketches, sizes = sketch_of(filled), np.array([len(x) for x in sets])
            missed += not near((sketches[0], used[0], sizes[0]), (sketches[1:], used[1:], sizes[1:]), 85)[0]
    assert missed == 0 and trust(np.array([REGISTERS]))[0] == REGISTERS and 60 < trust(np.array([100]))[0] < 100
