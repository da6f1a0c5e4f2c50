"""Toxicity: folding, exceptions, learning, held-out accuracy, odd texts."""

from zlib import crc32

import numpy as np

from docketloom.llm import toxicity
from docketloom.llm.toxicity import EXCEPTIONS, FIXED, SEED, Lexicon, _term, fold


def lexicon(terms=SEED):
    return Lexicon({_term(w) + " ": 1.0 for w in terms}, tuple(_term(p) + " " for p in EXCEPTIONS), FIXED)


def matches(text):
    made = lexicon()
    return int(made.sums([text], made.automaton())[1][0])


def test_fold():
    assert fold(["A b"]) == " a b \n" and fold([None, ""]) == " \n \n"
    assert fold(["𝐈𝐝𝐢𝐨𝐭 🙂"]) == fold(["idiot "]) and fold(["𝟏𝖉𝟏𝟎𝖳"]) == fold(["idiot"])
    assert fold(["1D10T"]) == fold(["idiot"]) == fold(["ІDІОТ"]) == fold(["ｉｄｉｏｔ"]) == fold(["ídïöt"])


def test_disguises_and_exceptions():
    for text in ("you idiot", "1d10t!", "m0r0n", "Stuріd", "PATHETIC.", "w0rth1e$$"):
        assert matches(text) == 1, text
    for text in ("idiotic proof", "the patheticism", "a sore loser", "Pond scum grows", "s t u p i d", None, ""):
        assert matches(text) == 0, text
    assert matches("a sore loser and a loser") == 1


def test_slices_keep_texts_apart():
    made = lexicon()
    total, n, words = made.sums(["idiot", "", None, "fine words", "moron idiot"], made.automaton())
    assert n.tolist() == [1, 0, 0, 0, 2] and words.tolist() == [1, 0, 0, 2, 2]


def corpus(n=400):
    rng = np.random.default_rng(3)
    docs, labels = [], []
    for i in range(n):
        toxic = i % 5 == 1
        words = ["".join(rng.choice(list("abcdefg"), rng.integers(3, 8))) for _ in range(rng.integers(20, 120))]
        if toxic:
            for _ in range(max(2, len(words) // 30)):
                words[rng.integers(len(words))] = "zukro" + "".join(rng.choice(list("abcdefg"), 3))
        docs.append((i, " ".join(words), "en", "s"))
        labels.append((i, 0, int(toxic)))
    return docs, labels


def test_learns_word_beginnings_and_holds_out(spark):
    docs, labels = corpus()
    d = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string")
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in toxicity.digest(d, lab).collect()}
    truth = {i: t for i, _, t in labels}
    held = [i for i in truth if crc32(str(i).encode()) % 5 == 0]
    assert {i for i, r in got.items() if r.held_out} == set(held)
    assert np.mean([got[i].predicted == truth[i] for i in held]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())
    flipped = spark.createDataFrame([(i, q, 1 - t if i in set(held) else t) for i, q, t in labels], "doc_id long, quality int, toxic int")
    assert {r.doc_id: r.score for r in toxicity.digest(d, flipped).collect()} == {i: r.score for i, r in got.items()}


def test_odd_documents(spark, odd_docs):
    labels = spark.createDataFrame([(0, 1, None), (None, 1, 1), (3, 1, 0), (3, 1, 1), (5, 0, 0)], "doc_id long, quality int, toxic int")
    for lab in (labels, labels.limit(0), labels.filter("toxic = 0")):
        rows = toxicity.digest(odd_docs, lab).collect()
        assert len(rows) == odd_docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert toxicity.digest(odd_docs.limit(0), labels).count() == 0
    scored = toxicity.add_scores(odd_docs.withColumn("score", toxicity.F.lit("clash")), lexicon())
    assert sorted(scored.columns) == sorted([*odd_docs.columns, "score", "predicted", "matches"])


def test_repeated_ids_and_labels_without_documents(spark):
    docs, labels = corpus()
    d = spark.createDataFrame([*docs, *[(1, docs[1][1] + f" {k}", "en", "s") for k in range(3000)]], "doc_id long, text string, lang string, source string")
    far = [(10_000 + i, 0, i % 2) for i in range(2000)]
    lab = spark.createDataFrame(labels + far, "doc_id long, quality int, toxic int")
    plain = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    assert toxicity.fit(d, lab, most=60) == toxicity.fit(d, plain, most=60)
    seen = toxicity.add_scores(d.withColumn("_toxicity", toxicity.F.lit("clash")), toxicity.fit(d, lab))
    assert "_toxicity" in seen.columns and seen.filter("_toxicity = 'clash'").count() == 3400
