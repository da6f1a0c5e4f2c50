"""Language identification: held-out accuracy, codes, odd texts."""

from zlib import crc32

import numpy as np

from docketloom.llm import langid

ALPHABETS = {"aa": "abcde", "bb": "defgh", "cc": "xyzñé", "dd": "абвгд"}


def corpus(n=160, seed=1):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        lang = list(ALPHABETS)[i % 4]
        text = " ".join("".join(rng.choice(list(ALPHABETS[lang]), rng.integers(2, 7))) for _ in range(rng.integers(4, 40)))
        rows.append((i, text, lang))
    return rows


def test_codewords():
    assert langid.codewords(1).shape == (1, 0)
    for n in (2, 3, 4, 5):
        code = langid.codewords(n)
        assert code.shape == (n, 2 ** (n - 1) - 1)
        assert len({tuple(c) for c in code.T.tolist()} | {tuple(-x for x in c) for c in code.T.tolist()}) == 2 * code.shape[1]
    many = langid.codewords(12)
    assert min((many[a] != many[b]).sum() for a in range(12) for b in range(a)) > many.shape[1] // 4


def test_features_fold_and_mark_letters():
    x, known = langid.features(["Abc", "aBC!", None, "123 --", "漢字", "ab c"])
    assert np.array_equal(x[0], x[1]) and not np.array_equal(x[0], x[5])
    assert known.tolist() == [True, True, False, False, True, True]
    assert np.allclose((x**2).sum(1)[[0, 4]], 1)


def test_held_out_accuracy(spark):
    rows = corpus()
    docs = spark.createDataFrame([(i, t, None if i % 7 == 0 else lang, "s") for i, t, lang in rows], "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r for r in langid.digest(docs).collect()}
    assert all(r.held_out == (crc32(str(i).encode()) % 4 == 2) for i, r in got.items())
    assert all(got[i].lang_pred == lang and 0 <= got[i].score <= 1 for i, _, lang in rows)
    changed = docs.withColumn("lang", langid.F.when(langid.fold_of(langid.F.col("doc_id"), 4) == 2, "zz").otherwise(langid.F.col("lang")))
    assert {r.doc_id: (r.lang_pred, r.score) for r in langid.digest(changed).collect()} == {i: (r.lang_pred, r.score) for i, r in got.items()}


def test_six_languages(spark):
    rng = np.random.default_rng(2)
    rows = [(i, "".join(rng.choice(list("abcdefghijklmnopqr"[3 * (i % 6) : 3 * (i % 6) + 3] + " "), 60)), f"l{i % 6}") for i in range(240)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = langid.identify(docs, langid.fit(docs)).collect()
    assert all(r.lang_pred == r.lang for r in got)


def test_odd_documents(spark, odd_docs):
    docs = odd_docs.withColumn("score", langid.F.lit("clash"))
    rows = langid.identify(docs, langid.fit(docs)).collect()
    assert len(rows) == docs.count() and {r.lang_pred for r in rows} <= {"en", "und"}
    assert all((r.lang_pred == "und") == (not r.text or not any(c.isalpha() for c in r.text)) for r in rows)
    none = docs.withColumn("lang", langid.F.lit(None).cast("string"))
    assert {r.lang_pred for r in langid.digest(none).collect()} == {"und"}
    assert langid.digest(docs.limit(0)).count() == 0


def test_a_repeated_id_keeps_the_sample_bounded(spark):
    rows = corpus() + [(0, "abc cde", "aa")] * 10_000 + [(4, f"abc {'abcde'[k % 5] * (k % 40 + 1)}", "aa") for k in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    seen = []
    train = langid.train
    langid.train = lambda x, language, near: seen.append((len(x), language)) or train(x, language, near)
    try:
        model = langid.fit(docs, per_language=20)
    finally:
        langid.train = train
    [(n, language)] = seen
    assert n == 80 and all(language.count(v) == 20 for v in ALPHABETS)
    got = langid.identify(docs.withColumns({"_language": langid.F.lit(1), "_LANGUAGE_": langid.F.lit(2)}), model)
    assert {"_language", "_LANGUAGE_"} < set(got.columns) and got.filter("_language = 1 and _LANGUAGE_ = 2 and lang_pred = lang").count() > 12_000


def test_large_languages_are_sampled_too():
    for n in (1, 1200, 5000, 10**6, 1_258_291_201, 10**10, 10**11):
        share = langid.sample_bound(n, 500) / (1 << 63)
        assert abs(share * n - min(n, 1200)) < 1e-3 * n + 1e-6 if n <= 1200 else abs(share * n - 1200) < 1


def test_decoding_against_every_codeword():
    rng = np.random.default_rng(5)
    rows = corpus(80)
    x, _ = langid.features([t for _, t, _ in rows])
    model = langid.train(x.astype(np.float32), [v for *_, v in rows], 0.2)
    texts = ["".join(rng.choice(list("abcdefghxyzñéабвгд  "), 40)) for _ in range(60)]
    got, score, _ = model.predict(texts)
    margins, _ = langid.features(texts)
    for k, t in enumerate(texts):
        loss = []
        for word in model.code.tolist():  # bit by bit, in plain numbers
            margin = [sum(float(a) * float(b) for a, b in zip(margins[k], w) if a) + float(b0) for w, b0 in zip(model.weights.T, model.bias)]
            loss.append(sum(float(r) * np.log1p(np.exp(-bit * m)) for bit, m, r in zip(word, margin, model.trust)))
        best = sorted(loss)
        if best[1] - best[0] > 1e-3:
            assert got[k] == model.languages[loss.index(best[0])]
            assert abs(score[k] - 1 / sum(np.exp(best[0] - v) for v in loss)) < 1e-2
