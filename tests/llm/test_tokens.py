"""Packing and token files against the tokenizers library itself."""

from concurrent.futures import ThreadPoolExecutor
from functools import cache
from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from docketloom.llm import packing, tokenfile
from docketloom.llm.common import utf8
from docketloom.llm.tokens import Encoder, encoder

P = pytest.importorskip("public_tokenizers")
from tokenizers import Tokenizer  # noqa: E402

from .conftest import ODD  # noqa: E402

FILES = {"words": "word_bpe_49k.json", "spaced": "byte_bpe_50k.json"}


@cache
def library(kind):
    t = Tokenizer.from_file(P.path(FILES[kind]))
    t.encode_special_tokens = True
    return t


def plain(kind, texts, end):
    t = library(kind)
    return [[*(t.encode(x, add_special_tokens=False).ids if x else []), end] for x in texts]


@pytest.mark.parametrize("kind", FILES)
def test_encoder_equals_library(kind):
    made = Encoder(P.path(FILES[kind]), kind)
    texts = [*ODD, "it's a  \n test\n\nx", "<|endoftext|> hi", "don't'll we'll", " 12 345\n67", "ΑΣ. ΑΣ x", "é a ́b", "x\x01y \x01", "a\xa0 b", "\xa0 a"]
    ids, ends = made.encode(*utf8(pa.array(texts, pa.string())))
    assert [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:])] == [x[:-1] for x in plain(kind, texts, 0)]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=" \n\t'sab1.,é\xa0Z<|>\x00\x01", max_size=30), max_size=5))
def test_encoder_on_random_texts(texts):
    for kind in FILES:
        ids, ends = encoder(P.path(FILES[kind]), kind).encode(*utf8(pa.array(texts, pa.string())))
        assert [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:])] == [x[:-1] for x in plain(kind, texts, 0)]


def test_table_grows_and_is_emptied():
    made = Encoder(P.path(FILES["words"]), "words", pieces=100)
    rng = np.random.default_rng(9)
    for _ in range(3):
        texts = [" ".join("".join(rng.choice(list("abcdefgh"), 4)) for _ in range(400))]
        ids, ends = made.encode(*utf8(pa.array(texts)))
        assert ids.tolist() == plain("words", texts, 0)[0][:-1]
        assert len(made.keys) >= made.count


def rows_of(df):
    return [r.asDict() for r in df.collect()]


def check_packing(rows, texts_by_doc, length):
    want = {d: sorted(map(tuple, plain("words", t, 2))) for d, t in texts_by_doc.items()}
    for d, docs in want.items():
        own = [r for r in rows if r["doc_id"] == d]
        assert sum(r["length"] for r in own) == sum(map(len, docs))
        if len(docs) == 1:
            ids = np.array(docs[0], "<u4")
            at = 0
            for r in sorted(own, key=lambda r: r["start"]):
                assert (r["start"], r["doc_tokens"]) == (at, len(ids))
                assert r["ids_crc32"] == crc32(ids[at : at + r["length"]].tobytes())
                at += r["length"]
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for pieces in by.values():
        at = 0
        for offset, k in sorted(pieces):
            assert offset == at
            at += k
        assert at <= length
    return by


def test_pack(spark, odd_docs):
    rows = rows_of(packing.pack(odd_docs, P.path(FILES["words"]), length=512))
    texts = {}
    for r in odd_docs.collect():
        texts.setdefault(r.doc_id, []).append(r.text)
    check_packing(rows, texts, 512)
    assert packing.pack(odd_docs.limit(0), P.path(FILES["words"])).count() == 0


def test_pack_wastes_little(spark):
    rng = np.random.default_rng(3)
    docs = spark.createDataFrame([(i, "word " * int(n)) for i, n in enumerate(rng.integers(1, 700, 3000))], "doc_id long, text string")
    rows = rows_of(packing.pack(docs, P.path(FILES["words"]), length=1024, unit=4))
    by = check_packing(rows, {}, 1024)
    used = sum(r["length"] for r in rows)
    assert used / (1024 * len(by)) > 0.98


def test_solver_takes_exactly_the_demand_and_beats_first_fit():
    rng = np.random.default_rng(1)
    size = np.array([3, 5, 7, 11, 13, 17, 19, 23, 29, 31])
    demand = rng.integers(50, 5000, len(size))
    chosen = packing.solve(size, demand, 64)
    assert (sum(p * n for p, n in chosen) == demand).all()
    assert all((p * size).sum() <= 64 for p, _ in chosen)
    bins, greedy = (sum(n for _, n in c) for c in (chosen, packing.first_fit(size, demand, 64)))
    assert -(-int((size * demand).sum()) // 64) <= bins <= greedy


def test_a_large_program_ends_beside_a_session(spark):
    """251 sizes need several refactorizations of the basis, on a driver whose session runs."""
    assert spark.range(10).count() == 10
    rng = np.random.default_rng(7)
    size = np.arange(1, 257)
    demand = np.maximum(1, 3000 * np.exp(-size / 40) + rng.integers(0, 30, len(size))).astype(np.int64)
    with ThreadPoolExecutor(1) as pool:
        chosen = pool.submit(packing.solve, size, demand, 256).result(timeout=240)
    assert (sum(p * n for p, n in chosen) == demand).all() and all((p * size).sum() <= 256 for p, _ in chosen)
    least = -(-int((size * demand).sum()) // 256)
    assert sum(n for _, n in chosen) <= 1.01 * least + 1
    basis = rng.integers(0, 5, (120, 120)) + np.diag(rng.integers(1, 9, 120))
    assert np.allclose(packing.inverted(basis.astype(float)) @ basis, np.eye(120), atol=1e-6)


def test_knapsack_against_all_combinations():
    value, size = np.array([2.0, 3.1, 4.5]), np.array([2, 3, 4])
    best = max(a * 2 + b * 3.1 + c * 4.5 for a in range(7) for b in range(5) for c in range(4) if 2 * a + 3 * b + 4 * c <= 13)
    got, counts = packing.knapsack(value, size, 13)
    assert got == pytest.approx(best) and (counts * value).sum() == pytest.approx(best) and (counts * size).sum() <= 13


def test_code_lengths():
    counts = np.array([0, 5, 1, 1, 100, 40, 0, 3])
    bits = tokenfile.code_lengths(counts, 18)
    assert (bits[[0, 6]] == 0).all() and sum(2.0 ** -int(b) for b in bits if b) == 1
    fib = [1, 1]
    while len(fib) < 30:
        fib.append(fib[-1] + fib[-2])
    limited = tokenfile.code_lengths(np.array(fib), 8)
    assert limited.max() == 8 and sum(2.0 ** -int(b) for b in limited) <= 1
    assert tokenfile.code_lengths(np.array([0, 7])).tolist() == [0, 1] and not tokenfile.code_lengths(np.zeros(3)).any()


def test_bits_round_trip():
    rng = np.random.default_rng(2)
    ids = np.minimum(rng.geometric(0.01, 5000), 900).astype(np.uint32)
    offsets = np.array([0, 0, 1, 700, 701, 5000])
    bits = tokenfile.code_lengths(np.bincount(ids))
    data, base, marks, n = tokenfile.write_bits(ids, offsets, tokenfile.canonical(bits), bits)
    block = tokenfile.make_block([5, 6, 7, 8, 9], np.diff(offsets).tolist(), np.split(marks, np.cumsum(n)[:-1]), [data[a:b].tobytes() for a, b in zip(base[:-1], base[1:])])
    docs, tokens, back = tokenfile.read_block(block, tokenfile.lookup(bits))
    assert docs.tolist() == [5, 6, 7, 8, 9] and tokens.tolist() == np.diff(offsets).tolist() and np.array_equal(back, ids)


def test_token_files(spark, odd_docs):
    docs = odd_docs.dropDuplicates(["doc_id"])
    rows = sorted(rows_of(tokenfile.round_trip(docs, P.path(FILES["spaced"]))), key=lambda r: r["doc_id"])
    texts = dict(docs.select("doc_id", "text").collect())
    at = 0
    for r, (d, ids) in zip(rows, zip(sorted(texts), plain("spaced", [texts[d] for d in sorted(texts)], 0)), strict=True):
        assert (r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) == (d, at, len(ids), crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    assert tokenfile.round_trip(docs.limit(0), P.path(FILES["spaced"])).count() == 0
    assert tokenfile.round_trip(odd_docs, P.path(FILES["spaced"])).count() == odd_docs.count()


def test_token_files_with_rows_without_id_and_a_repeated_id(spark):
    rows = [(None, f"none {k}") for k in range(40)] + [(7, f"seven {k}") for k in range(60)] + [(k, f"own text {k}") for k in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(rows_of(tokenfile.round_trip(docs, P.path(FILES["spaced"]))), key=lambda r: r["start"])
    assert [r["doc_id"] is None for r in got] == [True] * 40 + [False] * 80
    ids = [r["doc_id"] for r in got[40:]]
    assert ids == sorted(ids) and ids.count(7) == 61
    at = 0
    for r in got:
        assert r["start"] == at
        at += r["n_tokens"]
    want = sorted(crc32(np.array(x, "<u4").tobytes()) for x in plain("spaced", [t for _, t in rows], 0))
    assert sorted(r["ids_crc32"] for r in got) == want


def test_a_length_of_no_whole_units_never_overflows(spark):
    docs = spark.createDataFrame([(i, "word " * (31 if i % 2 else 62)) for i in range(40)], "doc_id long, text string")
    rows = rows_of(packing.pack(docs, P.path(FILES["words"]), length=63, unit=16))
    check_packing(rows, {}, 63)
    with pytest.raises(ValueError):
        packing.pack(docs, P.path(FILES["words"]), length=8, unit=16)
