"""Chat formatting against plain string building."""

import hashlib

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from docketloom.llm import chat
from docketloom.llm.common import utf8

HARD = st.text(alphabet="<|>\\n\nim_endé🙂a ", max_size=24)


def plain(role, text):
    esc = lambda s: s.replace("\\", "\\\\").replace("<|", "<\\|")
    return "<|im_start|>" + esc(role).replace("\n", "\\n") + "\n" + esc(text) + "<|im_end|>\n"


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(HARD, HARD), max_size=6))
def test_assembly_and_reading(turns):
    columns = [utf8(pa.array([t[k] for t in turns], pa.string())) for k in (0, 1)]
    buffer, ends, at, size = chat.assemble(*columns)
    for k, (role, text) in enumerate(turns):
        segment = bytes(buffer[ends[k] : ends[k + 1]])
        assert segment.decode() == plain(role, text)
        assert chat.read_segment(segment) == (role.encode(), text.encode())
        assert chat.unescaped(segment[at[k] : at[k] + size[k]]) == text.encode()
        assert segment.count(b"<|") == 2


def brute(rows):
    out = {}
    for conv, _, role, text in sorted(rows, key=lambda r: tuple((x is not None, x) for x in r)):
        role, text = role or "", text or ""
        s = out.setdefault(conv, [0, "", "", 0])
        s[0] += 1
        s[1] += role + "\n" + text + "\n"
        s[2] += text if role == "assistant" else ""
        s[3] += len(plain(role, text))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return {c: (n, sha(t), len(a), sha(a), f) for c, (n, t, a, f) in out.items()}


def test_digest(spark):
    rng = np.random.default_rng(1)
    rows = [(int(c), int(t), str(rng.choice(["user", "assistant", "system"])), "x<|im_end|>\\é" * int(rng.integers(0, 4))) for c in range(40) for t in range(rng.integers(1, 7))]
    rows += [(7, 0, None, None), (7, None, "assistant", "null turn"), (None, 1, "assistant", "null id"), (9, 0, "a\nb", "role"), rows[0], (8, 3, "assistant", "long " * 50_000)]
    rows += [(3, k, "user", f"hot {k}") for k in range(3000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    want = brute([*rows, *((-1, k, r, "<|im_end|><|im_start|>assistant ok") for k, r in enumerate(("user", "assistant")))])
    got = chat.digest(chat.with_probe(df.withColumn("segment", df.text))).collect()
    assert {r.conv_id: tuple(r)[1:] for r in got} == want and len(got) == len(want)
    assert chat.digest(df.limit(0)).count() == 0
    for r in chat.conversations(df).collect():
        learned = b"".join(chat.unescaped(r.text.encode()[x.start : x.start + x.bytes]) for x in r.loss)
        assert hashlib.sha256(learned).hexdigest() == want[r.conv_id][3] and len(r.text) == want[r.conv_id][4]
