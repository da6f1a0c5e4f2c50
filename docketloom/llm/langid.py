"""Language identification by error-correcting output codes.

Every language has a codeword of bits; for each bit a logistic classifier over character n-grams (one to three characters of
the folded text, hashed) says on which side a text lies. Up to five languages have the exhaustive code (every split of the
languages once); more have random codewords, the set with the largest least distance of ``tries``. A text is given to the
codeword with the smallest loss, the sum over bits of log(1 + exp(-bit * margin)) weighted by how reliable each bit was in
training; the score is the softmax of the negated losses, and a text whose second codeword comes within ``near`` of the
first is flagged ambiguous.

The model is fitted on a bounded sample: at most ``per_language`` distinct training rows for each language, those with the
smallest hash of their id and text; rows of one id, language and features count once. A bound on the hash (63 bits), from the
approximate number of rows of each language, leaves about twice as many before they are ranked, however large the language and
however many rows share an id, so no language is sorted in one task. Only the sample's features (8 KB a row) reach the driver. All texts are scored, whole, without a shuffle.

Defined cases: null texts and texts without a letter are ``und`` with score 0; with one language every other text is that
language; with no labelled row all are ``und``. Repeated rows are scored each; null ids are training rows of no fold and are
left out of it. Extra columns pass through :func:`identify`, whatever their names; columns named as its results are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache
from itertools import combinations
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import per_batch, prepare, slices, unused

FEATURES = 4096
UNKNOWN = "und"


@cache
def _fold_table() -> np.ndarray:
    """Lower-case letter of each code point; 0 for what is no letter."""
    out = np.zeros(0x10000, np.uint32)
    for c in range(0x10000):
        x = chr(c)
        if x.isalpha():
            low = x.lower()
            out[c] = ord(low) if len(low) == 1 else c
    return out


def features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(square roots of the n-grams' shares, does the text have a letter?) for each text."""
    texts = [t or "" for t in texts]
    ends = np.cumsum([len(t) + 1 for t in texts])
    points = np.frombuffer("".join(t + "\n" for t in texts).encode("utf-32-le", "surrogatepass"), "<u4")
    table = _fold_table()
    high = points > 0xFFFF
    folded = table[np.minimum(points, 0xFFFF)].astype(np.uint32)
    if high.any():
        folded[high] = [c if chr(c).isalpha() else 0 for c in points[high].tolist()]
    keep = np.ones(len(folded), bool)
    keep[1:] = (folded[1:] > 0) | (folded[:-1] > 0)  # one gap between words
    doc = np.searchsorted(ends, np.flatnonzero(keep), "right")
    one = folded[keep].astype(np.uint64)
    letter = one > 0
    counts = np.zeros(len(texts) * FEATURES)
    two, three = one[:-1] * np.uint64(0x9E3779B1) + one[1:], None
    three = two[:-1] * np.uint64(0x85EBCA6B) + one[2:]
    for n, grams in ((1, one), (2, two), (3, three)):
        if not len(grams):
            continue
        own = doc[n - 1 :]
        real = (letter[: len(grams)] | letter[n - 1 :]) & (doc[: len(grams)] == own)
        h = (grams[real] + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(52)
        counts += np.bincount(own[real] * FEATURES + h.astype(np.int64), minlength=len(counts))
    counts = counts.reshape(len(texts), FEATURES)
    total = counts.sum(1, keepdims=True)
    return np.sqrt(counts / np.maximum(total, 1)).astype(np.float32), np.bincount(doc[letter], minlength=len(texts)) > 0


def codewords(n: int, tries: int = 200) -> np.ndarray:
    """A row of +1 and -1 for each of ``n`` languages."""
    if n <= 5:
        splits = [s for k in range(1, n) for s in combinations(range(n), k) if 0 in s]
        return np.array([[1 if lang in s else -1 for s in splits] for lang in range(n)], np.int64).reshape(n, len(splits))
    rng, best = np.random.default_rng(7), None
    bits = int(np.ceil(10 * np.log2(n)))
    for _ in range(tries):
        code = rng.choice([-1, 1], (n, bits))
        code = code[:, np.abs(code.sum(0)) < n]  # a bit that is the same for all says nothing
        least = min(int((code[a] != code[b]).sum()) for a, b in combinations(range(n), 2))
        if best is None or least > best[0]:
            best = least, code
    return best[1]


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    trust: np.ndarray
    near: float

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """(language, score, ambiguous) of each text."""
        x, known = features(texts)
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(len(texts), bool)
        margin = x @ self.weights + self.bias
        loss = np.stack([(np.logaddexp(0, -word * margin) * self.trust).sum(1) for word in self.code], 1)
        order = np.argsort(loss, 1, kind="stable")
        best = order[:, 0]
        share = np.exp(loss.min(1, keepdims=True) - loss)
        score = np.where(known, 1 / share.sum(1), 0.0)
        ranked = np.sort(loss, 1)
        close = known & (ranked[:, 1] - ranked[:, 0] < self.near) if len(self.languages) > 1 else np.zeros(len(texts), bool)
        return [self.languages[b] if k else UNKNOWN for b, k in zip(best.tolist(), known.tolist(), strict=True)], score, close


def train(x: np.ndarray, language: list[str], near: float = 0.2, rounds: int = 300, penalty: float = 1e-5) -> Model:
    """Logistic classifiers for all bits at once, by accelerated gradient steps over the sample."""
    languages = sorted(set(language))
    code = codewords(len(languages))
    if len(languages) < 2:
        return Model(languages, code, np.zeros((FEATURES, 0), np.float32), np.zeros(0), np.zeros(0), near)
    of = np.array([languages.index(v) for v in language])
    target = code[of].astype(np.float32)
    share = (1 / np.bincount(of, minlength=len(languages)))[of].astype(np.float32)[:, None] / len(languages)
    w, b = np.zeros((x.shape[1], code.shape[1]), np.float32), np.zeros(code.shape[1], np.float32)
    vw, vb = np.zeros_like(w), np.zeros_like(b)
    for _ in range(rounds):
        aw, ab = w + 0.9 * vw, b + 0.9 * vb
        g = -share * target / (1 + np.exp(np.clip(target * (x @ aw + ab), -30, 30)))
        vw = 0.9 * vw - 6.0 * (x.T @ g + penalty * aw)
        vb = 0.9 * vb - 6.0 * g.sum(0)
        w, b = w + vw, b + vb
    right = (share * (target * (x @ w + b) > 0)).sum(0) / share.sum()
    return Model(languages, code, w, b, np.maximum(0.05, 2 * right - 1), near)


def fold_of(doc_id: Column, folds: int) -> Column:
    return F.pmod(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")), F.lit(folds))


def sample_bound(n: int, per_language: int) -> int:
    """The largest of 63 bits of a hash that about 2 * ``per_language`` + 200 of ``n`` rows lie within; all rows if ``n`` is smaller."""
    return min((1 << 63) - 1, (1 << 63) * (2 * per_language + 200) // max(1, n))


def fit(docs: DataFrame, per_language: int = 500, folds: int = 4, held: int = 2, near: float = 0.2) -> Model:
    """Train on rows (doc_id, text, lang) outside the held-out fold."""
    prepare(docs.sparkSession)
    rows = docs.filter(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & (fold_of(F.col("doc_id"), folds) != held)).select("doc_id", "text", "lang")
    # A row's place is 63 bits of a hash of its id and text, so rows that repeat an id are sampled one by one.
    placed = rows.withColumn("place", F.shiftrightunsigned(F.xxhash64("doc_id", "text"), 1))
    sizes = {r.lang: r.n for r in placed.groupBy("lang").agg(F.approx_count_distinct("place").alias("n")).collect()}  # one row a language
    if not sizes:
        return train(np.zeros((0, FEATURES), np.float32), [], near)
    bound = F.create_map(*(F.lit(x) for lang, n in sizes.items() for x in (lang, sample_bound(n, per_language))))
    picked = placed.filter(F.col("place") <= bound[F.col("lang")])

    def counted(batch: pa.RecordBatch) -> dict:
        x, known = features(batch.column("text").to_pylist())
        made = [r.astype(np.float16).tobytes() for r in x]
        return {"doc_id": batch.column("doc_id"), "lang": batch.column("lang"), "place": batch.column("place"), "known": pa.array(known), "same": [crc32(r) for r in made], "x": made}

    sampled = per_batch(picked, counted, "doc_id long, lang string, place long, known boolean, same long, x binary").filter("known")
    distinct = sampled.groupBy("doc_id", "lang", "same").agg(F.min("place").alias("place"), F.first("x").alias("x"))  # combined before the shuffle
    first = Window.partitionBy("lang").orderBy("place", "doc_id", "same")  # some 2 * per_language + 200 rows a language
    sample = distinct.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= per_language).collect()  # at most per_language rows a language
    sample.sort(key=lambda r: (r.doc_id, r.lang, r.same))
    x = np.stack([np.frombuffer(r.x, np.float16).astype(np.float32) for r in sample]) if sample else np.zeros((0, FEATURES), np.float32)
    return train(x, [r.lang for r in sample], near)


def prediction(model: Model, text: Column, spark) -> Column:
    """A struct of lang_pred, score and ambiguous for the column ``text``."""
    shared = spark.sparkContext.broadcast(model)  # languages times bits times FEATURES numbers

    @F.pandas_udf("struct<lang_pred:string,score:double,ambiguous:boolean>")
    def predicted(texts: pd.Series) -> pd.DataFrame:
        parts = []
        batch = pa.record_batch([pa.array(texts, pa.string(), from_pandas=True)], ["text"])
        for part in slices(batch, "text"):
            lang, score, close = shared.value.predict(part.column("text").to_pylist())
            parts.append(pd.DataFrame({"lang_pred": lang, "score": score, "ambiguous": close}))
        return pd.concat(parts, ignore_index=True) if parts else pd.DataFrame({"lang_pred": [], "score": [], "ambiguous": []})

    return predicted.asNondeterministic()(text)  # else a filter on the prediction would predict a second time


def identify(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``df`` with lang_pred, score and ambiguous."""
    own = unused("language", df)
    made = df.withColumn(own, prediction(model, F.col(text), df.sparkSession))
    return made.withColumns({c: F.col(f"{own}.{c}") for c in ("lang_pred", "score", "ambiguous")}).drop(own)


def digest(docs: DataFrame, per_language: int = 500) -> DataFrame:
    """doc_id, held_out, lang_pred, score for each document."""
    model = fit(docs, per_language)
    found = identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", F.coalesce(fold_of(F.col("doc_id"), 4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score", "ambiguous")
