"""Decontamination against a plain edit distance over every part of the text."""

import numpy as np

from docketloom.llm.decontam import Windows, contaminated, fold, keep_clean


def words(rng, n):
    return " ".join("".join(rng.choice(list("abcdefghij"), rng.integers(2, 9))) for _ in range(n))


def plain(text):
    return "".join(map(chr, fold([text])[0][:-1])).strip()


def occurs(pattern, text, budget):
    """Does some part of ``text`` have at most ``budget`` edits from ``pattern``? (Sellers' algorithm)"""
    row = list(range(len(pattern) + 1))
    best = row[-1]
    for c in text:
        new = [0]
        for j, p in enumerate(pattern):
            new.append(min(row[j] + (p != c), row[j + 1] + 1, new[j] + 1))
        row, best = new, min(best, new[-1])
    return best <= budget


def test_fold():
    points, places, ends = fold(["Ab,  c!", None, "É"])
    assert "".join(map(chr, points)) == "ab c \x01\x01é\x01" and ends.tolist() == [8, 9, 11]
    assert places[:5].tolist() == [0, 1, 2, 5, 6]


def changed(rng, text, edits):
    body = list(text)
    for _ in range(edits):
        at = rng.integers(len(body))
        change = rng.integers(3)
        if change == 0:
            body[at] = "z"
        elif change == 1:
            body.insert(at, "y")
        else:
            del body[at]
    return "".join(body)


def windows_of(item, window=96):
    """An item's windows: its start, every quarter window, its end."""
    text = plain(item)
    if len(text) <= window:
        return [text]
    return [text[s : s + window] for s in {*range(0, len(text) - window + 1, window // 4), len(text) - window}]


def expected(items, texts, rate=0.1):
    want = set()
    for n, t in enumerate(texts):
        folded = plain(t or "")
        for item_id, item in items:
            for pattern in windows_of(item):
                budget = int(rate * len(pattern))
                if budget and occurs(pattern, folded, budget) or not budget and f" {pattern} " in f" {folded} ":
                    want.add((n, item_id))
    return want


def test_against_edit_distance():
    rng = np.random.default_rng(4)
    items = [(k, words(rng, n)) for k, n in enumerate((12, 20, 40, 6))]
    index = Windows(items, 96, 0.1)
    texts = []
    for _ in range(60):
        body = changed(rng, items[rng.integers(4)][1], rng.integers(0, 14))
        a, b = sorted(rng.integers(0, len(body), 2)) if rng.random() < 0.2 else (0, len(body))
        texts.append(words(rng, rng.integers(0, 30)) + " " + body[a:b].upper() + ".  " + words(rng, 5))
    got = {(n, item) for n, item, *_ in index.search(texts)}
    assert got == expected(items, texts) and 20 < len(got) < 70


def test_whole_budget_at_every_length():
    rng = np.random.default_rng(5)
    found = 0
    for m in range(5, 201, 3):
        items = [(k, words(rng, m)[: m + k].strip()) for k in range(3)]
        k = int(0.1 * min(m, 96))
        texts = [f"{words(rng, 2)} {changed(rng, items[0][1], edits)} {words(rng, 2)}" for edits in sorted({0, k, k + 1})]
        index = Windows(items, 96, 0.1)
        assert min(index.need) >= 1
        got = {(n, item) for n, item, *_ in index.search(texts)}
        assert got == expected(items[:1], texts)
        found += len(got)
    assert found > 130


def test_excerpts_and_copies():
    rng = np.random.default_rng(9)
    item = words(rng, 90)
    long = plain(item)
    index = Windows([(1, item)], 96, 0.1)
    cuts = [long[a : a + 120] for a in range(0, len(long) - 120, 7)]  # an excerpt of 5/4 of a window is found wherever it is cut
    assert {n for n, *_ in index.search([f"zz {c} zz" for c in cuts])} == set(range(len(cuts)))
    text = f"{words(rng, 400)} {item} {words(rng, 400)}"
    one = index.search([text])
    assert [r[1:] for r in index.search([text, text, "", text])] == [r[1:] for r in one * 3] and len(one) == 1
    assert plain(text[one[0][2] : one[0][3]]) == plain(item)


def test_shared_wording_is_bounded():
    """200 items with one preamble against 20 kB that repeat it: nothing is found, in bounded memory."""
    import tracemalloc

    rng = np.random.default_rng(10)
    preamble = "answer the following question about the text below and "
    index = Windows([(k, preamble + words(rng, 12)) for k in range(200)], 96, 0.1)
    text = preamble * (20_000 // len(preamble))
    mixed = "".join(preamble + words(rng, 20) + " " for _ in range(60))
    tracemalloc.start()
    assert index.search([text, mixed]) == []
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert peak < 200e6


def test_no_match_across_documents():
    rng = np.random.default_rng(6)
    item = words(rng, 16)
    index = Windows([(1, item)], 96, 0.1)
    half = len(item) // 2
    assert index.search([item[:half], item[half:]]) == []
    [(n, i, start, end, _, edits)] = index.search(["", "x " + item, None])
    assert (n, i, edits) == (1, 1, 0) and ("x " + item)[start:end] == item


def test_frames(spark, odd_docs):
    rng = np.random.default_rng(7)
    item = words(rng, 30)
    bench = spark.createDataFrame([(1, item), (2, words(rng, 25)), (3, None), (4, "--"), (6, "q1z"), (5, item)], "item_id long, text string")
    hit = spark.createDataFrame([(50, "before " + item.upper() + " after", "en", "s", 1, "x")], odd_docs.schema)
    docs = odd_docs.union(hit).union(hit)
    for block in (2_000_000, 50):
        assert sorted((r.doc_id, r.item_id) for r in contaminated(docs, bench, block=block).collect()) == [(50, 1), (50, 1), (50, 5), (50, 5)]
    kept = keep_clean(docs, bench)
    assert kept.columns == docs.columns and kept.count() == odd_docs.count()
    assert contaminated(docs.limit(0), bench).count() == 0 and contaminated(docs, bench.limit(0)).count() == 0
