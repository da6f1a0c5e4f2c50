"""Merkle manifest against a tree that is built and walked node by node."""

import hashlib
from zlib import crc32

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from docketloom.llm import merkle

from .conftest import ODD


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree(nodes, fanout):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][k : k + fanout]) for k in range(0, len(levels[-1]), fanout)])
    return levels


def way(levels, k, fanout):
    """(run, place in it) of each level from leaf ``k`` up."""
    out = []
    for nodes in levels[:-1]:
        first = k // fanout * fanout
        out.append((nodes[first : first + fanout], k - first))
        k //= fanout
    return out


def plain(rows, fanout=8, tampered=3):
    """Rows (doc_id, source, lang, n_chars, text) to the manifest's rows."""
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    order = {x: sorted((r for r in rows if r[2] == x), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))) for x in langs}
    trees = {x: tree([leaf(r) for r in order[x]], fanout) for x in langs}
    over = tree([trees[x][-1][0] for x in langs], fanout)
    out = []
    for n, x in enumerate(langs):
        for k, r in enumerate(order[x]):
            path = way(trees[x], k, fanout) + way(over, n, fanout)
            hit = r[0] is not None and r[4] is not None and crc32(str(r[0]).encode()) % tampered == 0
            lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r[4] or "")
            now = leaf((*r[:4], lower) if hit else r)
            for run, at in path:
                now = h(*run[:at], now, *run[at + 1 :])
            out.append((r[0], leaf(r), trees[x][-1][0], over[-1][0], h(*(s for run, at in path for j, s in enumerate(run) if j != at)), now, now == over[-1][0]))
    return sorted(out, key=str)


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def got(spark, rows, **more):
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA + ", leaf string, key int")
    return sorted((tuple(r) for r in merkle.manifest(docs, **more).collect()), key=str)


ROW = st.tuples(st.one_of(st.none(), st.integers(-3, 40)), st.sampled_from([None, "s", "-", "1:a"]), st.sampled_from([None, "", "en", "é", "z", "🙂"]), st.sampled_from([None, 0, 12]), st.sampled_from([None, "", "Text", "text", "É A", "1:-"]))


@settings(max_examples=3, deadline=None)
@given(st.lists(ROW, min_size=1, max_size=40), st.integers(2, 4))
def test_against_a_plain_tree(spark, rows, fanout):
    assert got(spark, rows, fanout=fanout) == plain(rows, fanout)


@pytest.mark.parametrize("n", [1, 8, 9, 64, 513, 4097])
def test_sizes_around_runs_and_blocks(spark, n):
    rows = [(k, "s", "en", k, f"Text {k}") for k in range(n)] + [(-k, None, f"l{k}", None, None) for k in range(n % 11)]
    assert got(spark, rows) == plain(rows)


def test_many_keys_and_a_hot_id(spark):
    rows = [(k, "s", f"lang {k % 700}", 1, "T") for k in range(1400)] + [(7, "s", "lang 7", 1, "Same")] * 600
    assert got(spark, rows) == plain(rows)


def test_odd_frames(spark, odd_docs):
    rows = [(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in odd_docs.collect()]
    assert len(rows) == len(ODD) + 2
    found = sorted((tuple(r) for r in merkle.manifest(odd_docs).collect()), key=str)
    assert found == plain(rows) and merkle.manifest(odd_docs.limit(0)).count() == 0
    assert merkle.manifest(odd_docs).columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def test_any_change_is_found_and_nothing_else(spark):
    rows = [(k, "s", "en", 1, "Abc" if k % 2 else "abc") for k in range(300)]
    bad = {r[0] for r in got(spark, rows) if not r[-1]}
    assert bad == {k for k in range(300) if k % 2 and crc32(str(k).encode()) % 3 == 0}
