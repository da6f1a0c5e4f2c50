"""Filter audit against filters applied one after the other, document by document."""

import re
from collections import Counter
from itertools import permutations

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from docketloom.llm import filteraudit


def fails(rows):
    """For each row (doc_id, text, lang) the set of filters that it fails, by the rules as they are written."""
    out = []
    for doc_id, text, _ in rows:
        t = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        f = {"A"} if len(words) < 200 else set()
        f |= {"B"} if 100 * len(set(words)) < 50 * len(words) else set()
        f |= {"C"} if 100 * len(re.findall("[A-Z]", t)) > 3 * len(t) else set()
        f |= {"D"} if re.search(r"[#$%&*|]", t) else set()
        f |= {"E"} if doc_id is not None and any(d is not None and d < doc_id and (u or "") == t for d, u, _ in rows) else set()
        out.append(f)
    return out


def plain(rows, labels):
    """Every row of the report by running each order over the documents."""
    failed, out = fails(rows), {}
    good, toxic = ({d for d, q, t in labels if (q, t)[k] == 1 and d is not None} for k in (0, 1))
    for part in {lang or "" for *_, lang in rows}:
        mine = [k for k, r in enumerate(rows) if (r[2] or "") == part]
        share = Counter()
        for order in map("".join, permutations("ABCDE")):
            left, gone = mine, []
            for step, f in enumerate(order, 1):
                removed = [k for k in left if f in failed[k]]
                left = [k for k in left if f not in failed[k]]
                share[f] += len(removed)
                ids = [rows[k][0] for k in removed]
                out[part, order, step] = [len(left), len(removed), sum(f in failed[k] for k in gone), sum(failed[k] == {f} for k in mine), sum(i in good for i in ids), sum(i in toxic for i in ids)]
                gone += removed
        for (p, order, step), row in out.items():
            if p == part:
                row.append(share[order[step - 1]])
    return out


WORDS = " ".join(f"w{k}" for k in range(200))
TEXT = st.one_of(st.none(), st.sampled_from(["", "a", WORDS, WORDS + " #", WORDS.upper(), "same " * 250, "same " * 99 + WORDS, "a\x85b\xa0c", "É" * 3 + "A", WORDS + "\x00|", "x\x1cy " * 200]))
ROWS = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 12)), TEXT, st.sampled_from([None, "", "en", "de"])), max_size=25)
LABELS = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 12)), st.sampled_from([None, 0, 1]), st.sampled_from([None, 0, 1])), max_size=10)


def got(spark, rows, labels):
    docs = spark.createDataFrame([(*r, "extra") for r in rows], "doc_id long, text string, lang string, part string")
    said = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    found = filteraudit.audit(docs, said).collect()
    assert len({r[:3] for r in found}) == len(found)
    return {(r.part, r.filter_order, r.step): [r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley] for r in found}


@settings(max_examples=4, deadline=None)
@given(ROWS, LABELS)
def test_against_the_orders_themselves(spark, rows, labels):
    assert got(spark, rows, labels) == plain(rows, labels)


def test_odd_frames(spark, odd_docs):
    rows = [(r.doc_id, r.text, r.lang) for r in odd_docs.collect()]
    labels = [(9, 1, 0), (9, 0, 1), (3, 1, None), (None, 1, 1)]
    assert got(spark, rows, labels) == plain(rows, labels)
    assert got(spark, [], labels) == {} and len(got(spark, rows, [])) == 2 * 600
    docs = spark.createDataFrame([(k, "t", f"part {k % 700}") for k in range(1500)], "doc_id long, text string, lang string")
    many = filteraudit.audit(docs, spark.createDataFrame([], "doc_id long, quality int, toxic int")).filter("filter_order = 'EABCD' and step = 1").collect()
    assert len(many) == 700 and sum(r.removed for r in many) == 1499 and sum(r.kept for r in many) == 1


def test_the_table_and_its_arrays(monkeypatch):
    assert filteraudit.FIRST.shape == (32, 120) and (filteraudit.FIRST[0] == 5).all()
    for bits in range(32):
        for o, order in enumerate(filteraudit.ORDERS):
            at = [s for s, f in enumerate(order) if bits >> "ABCDE".index(f) & 1]
            assert filteraudit.FIRST[bits, o] == (at[0] if at else 5)

    class Task:
        def partitionId(self):  # noqa: N802
            return 5

    monkeypatch.setattr(filteraudit.TaskContext, "get", staticmethod(Task))
    monkeypatch.setattr(filteraudit, "PARTS_HELD", 3)
    rng = np.random.default_rng(1)
    batches = [pa.RecordBatch.from_pydict({"part": [f"p{x}" for x in rng.integers(0, 9, 50)], "bits": pa.array(rng.integers(0, 32, 50), pa.int32()), "good": rng.random(50) < 0.3, "toxic": rng.random(50) < 0.1}) for _ in range(6)]
    arrays = sorted((p, s) for b in filteraudit.counted(iter(batches)) for p, s in zip(b.column("part").to_pylist(), b.column("sums").to_pylist()))
    assert len(arrays) > 9  # arrays were given away in between
    sums = dict(filteraudit._added(iter(arrays)))
    assert sum(int(a[-1]) for a in sums.values()) == 300 and len(sums) == 9
