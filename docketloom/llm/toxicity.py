"""Toxicity by a weighted lexicon.

Texts are folded so that disguises fall together: accents go, homoglyphs (Cyrillic, Greek, full-width) become Latin letters,
digits and signs that stand for letters become those, and l and i are one letter, since 1 stands for both. What is left are
words of letters. The lexicon has word beginnings and whole words with weights, and exception phrases in which a word means
no harm; all are one Aho-Corasick automaton, run over a slice of whole texts at once. A match inside an exception phrase
doesn't count. The score is logistic in the sum of a text's weights and that sum for each hundred words.

Weights come from labels: for word beginnings of four to eight letters and whole words, how many toxic and other rows hold
them; a term is taken whose toxic rows outweigh the others clearly, and longer ones that a taken beginning covers are not.
Rows that share their smallest word hash (copies, near copies) count as one, so a copied text can't make its words look
telling. The terms of ``SEED`` are in any lexicon, with a weight that labels can lower. Labels are read for at most ``most``
toxic and ``most`` other labelled documents outside the held-out fold, those with the smallest hash of their id. Only terms that
enough toxic rows hold, and for the curve three numbers a row, reach the driver; texts and words don't.

Defined cases: null and empty texts have no match and score as such; without labelled rows of both kinds the seed terms have
weight 1 and a fixed curve; a doc_id labelled twice counts once, as toxic if one of them says so; of the texts of one doc_id
one is learnt from; repeated documents are scored each; other columns pass through, whatever their names, those named as the
results are replaced.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, per_batch, prepare, slices, unused
from .langid import fold_of

SEED = ("disgusting", "dumbass", "idiot", "imbecile", "loser", "moron", "pathetic", "retard", "scum", "scumbag", "stupid", "worthless")
EXCEPTIONS = ("sore loser", "scum of algae", "pond scum", "flame retardant", "fire retardant", "graceful loser", "idiot proof")
#: The curve where labels give none: constant, sum, sum for each hundred words.
FIXED = (-4.0, 2.0, 2.0)
#: Letters of other scripts that look like Latin ones, and signs that stand for letters. Fixed values.
HOMOGLYPHS = dict(zip("аеорсухіјѕԁӏһкмтвнгпαβεηικνορτυχωɡıł", "aeopcyxijsdlhkmtbhrnabenikvoptuxwgil", strict=True))
SIGNS = dict(zip("0134578@$€", "oleastbase", strict=True))


def folded(c: str) -> int:
    """The folded letter of a character; a space for what is none, 0 for what goes without a trace."""
    if unicodedata.combining(c):
        return 0
    x = c.lower()
    x = HOMOGLYPHS.get(x, x)
    x = unicodedata.normalize("NFKD", x)[:1].lower()
    x = HOMOGLYPHS.get(x, x)
    x = SIGNS.get(x, x)
    return ord("i" if x == "l" else x) if len(x) == 1 and x.isalpha() else 32


@cache
def _fold_table() -> np.ndarray:
    return np.array([folded(chr(c)) for c in range(0x10000)], np.uint32)


def fold(texts: list[str | None]) -> str:
    """All texts folded: words with a space on either side, and a line feed behind each text."""
    texts = [t or "" for t in texts]
    ends = np.cumsum([len(t) + 2 for t in texts])
    points = np.frombuffer("".join(" " + t + "\n" for t in texts).encode("utf-32-le", "surrogatepass"), "<u4")
    out = _fold_table()[np.minimum(points, 0xFFFF)].copy()
    high = points > 0xFFFF
    if high.any():
        own, at = np.unique(points[high], return_inverse=True)
        out[high] = np.array([folded(chr(c)) for c in own.tolist()], np.uint32)[at]
    out[ends - 1] = 10
    keep = out > 0
    keep[1:] &= ~((out[1:] == 32) & (out[:-1] == 32))
    out = out[keep]
    before = np.flatnonzero((out[1:] == 10) & (out[:-1] != 32)) + 1
    return np.insert(out, before, 32).astype("<u4").tobytes().decode("utf-32-le")


@dataclass
class Lexicon:
    """Terms end with a space if they are whole words; every term and phrase begins with one."""

    weights: dict[str, float]
    exceptions: tuple[str, ...]
    curve: tuple[float, float, float]

    def automaton(self):
        import ahocorasick

        made = ahocorasick.Automaton()
        for phrase in self.exceptions:
            made.add_word(phrase, (len(phrase), None))
        for term, weight in self.weights.items():
            made.add_word(term, (len(term), weight))
        if len(made):
            made.make_automaton()
        return made

    def sums(self, texts: list[str | None], automaton) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(sum of weights, number of matches, words) of each text."""
        folded = fold(texts)
        points = np.frombuffer(folded.encode("utf-32-le"), "<u4")
        ends = np.flatnonzero(points == 10)
        at = np.searchsorted(ends, np.flatnonzero(points == 32))
        words = np.bincount(at, minlength=len(texts))[: len(texts)] - 1
        found = [(end + 1 - size, end + 1, weight) for end, (size, weight) in automaton.iter(folded)] if len(automaton) else []
        spared = [(a, b) for a, b, weight in found if weight is None]
        if spared:
            a, b = np.array(sorted(spared)).T
            reach = np.maximum.accumulate(b)
            found = [f for f in found if f[2] is not None and not ((k := int(np.searchsorted(a, f[0], "right"))) and reach[k - 1] >= f[1])]
        best: dict[int, float] = {}
        for start, _, weight in found:  # of terms that begin a word together the heaviest counts
            best[start] = max(best.get(start, weight), weight)
        doc = np.searchsorted(ends, np.fromiter(best, np.int64, len(best)))
        total = np.bincount(doc, weights=np.fromiter(best.values(), float, len(best)), minlength=len(texts))
        return total, np.bincount(doc, minlength=len(texts)), words

    def score(self, total: np.ndarray, words: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(shaped(total, words) @ np.array(self.curve), -30, 30)))


def shaped(total: np.ndarray, words: np.ndarray) -> np.ndarray:
    """What the curve weighs: a constant, the sum, and the sum for each hundred words."""
    return np.stack([np.ones(len(total)), np.log1p(total), np.log1p(100 * total / np.maximum(words, 1))], 1)


def _term(word: str) -> str:
    return fold([word]).rstrip("\n").rstrip(" ")


def terms_of(words: str) -> set[str]:
    """Word beginnings of four to eight letters, and whole words with a space behind."""
    out = set()
    for w in words.split():
        out.update(w[:k] for k in range(4, min(len(w), 8) + 1))
        out.add(w + " ")
    return out


def learn(toxic: dict[str, float], other: dict[str, float], n: tuple[int, int], least: float) -> Lexicon:
    """A lexicon, its curve yet to be fitted, from how many toxic and other rows hold each term (of ``n`` of each kind)."""
    exceptions = tuple(_term(p) + " " for p in EXCEPTIONS)
    seeds = {_term(w): 1.0 for w in SEED}
    if not all(n):
        return Lexicon({t + " ": w for t, w in seeds.items()}, exceptions, FIXED)
    taken: dict[str, float] = {}
    for term in sorted((t for t, c in toxic.items() if c >= least), key=lambda t: (len(t), t)):
        if any(" " + term[:k] in taken for k in range(4, len(term))):
            continue
        a, b = toxic[term] / n[0], other.get(term, 0) / n[1]
        if a >= 20 * b:
            taken[" " + term] = float(min(3.0, np.log(((toxic[term] + 0.5) / (n[0] + 1)) / ((other.get(term, 0) + 0.5) / (n[1] + 1)))) / 3)
    for term, weight in seeds.items():
        own = term[1:]
        if own + " " in toxic:
            a, b = toxic[own + " "] / n[0], other.get(own + " ", 0) / n[1]
            weight = 1.0 if a >= 3 * b else 0.3 if a >= b else 0.0
        if weight and not any(term.startswith(t.rstrip()) for t in taken):
            taken[term + " "] = weight
    return Lexicon(taken, exceptions, FIXED)


def fit(docs: DataFrame, labels: DataFrame, most: int = 3000, folds: int = 5, held: int = 0, rows: int = 5, share: float = 0.004) -> Lexicon:
    """Learn from the labels (doc_id, toxic) of ``docs`` (doc_id, text) outside the held-out fold. A term must stand in at least
    ``rows`` toxic rows and in the ``share`` of them."""
    prepare(docs.sparkSession)
    known = labels.filter("doc_id is not null and toxic is not null").filter(fold_of(F.col("doc_id"), folds) != held).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = cut(known.join(docs.select("doc_id"), "doc_id", "left_semi"))
    sizes = {int(r.toxic): r["count"] for r in known.groupBy("toxic").count().collect()}
    picks = [known.filter(F.col("toxic") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most) for k in (0, 1)]
    chosen = picks[0].union(picks[1]).select(F.col("doc_id").alias("_id"), F.col("toxic").alias("_toxic"))
    picked = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("_id")).select("doc_id", "text", "_toxic")  # at most 2 * most ids

    def bags(batch: pa.RecordBatch) -> dict:
        groups, bag = [], []
        for words in fold(batch.column("text").to_pylist()).split("\n")[:-1]:
            own = set(words.split())
            groups.append(min(map(_stable, own), default=0))
            bag.append(" ".join(sorted(own)))
        return {"doc_id": batch.column("doc_id"), "toxic": batch.column("_toxic").cast(pa.int32()), "group": groups, "bag": bag, "text": batch.column("text")}

    made = per_batch(picked, bags, "doc_id long, toxic int, group long, bag string, text string")
    held_rows = cut(made.groupBy("doc_id").agg(F.min(F.struct("group", "bag", "text", "toxic")).alias("r")).select("doc_id", "r.*"))
    copies = {(r.toxic, r.group): r["count"] for r in held_rows.groupBy("toxic", "group").count().collect()}  # at most 2 * most rows
    n = tuple(sum(1 for t, _ in copies if t == k) for k in (1, 0))
    least = max(rows, share * n[0])
    names = [_term(w)[1:] for w in SEED]

    def counted(kind: int, wanted: set[str] | None):
        def count(batch: pa.RecordBatch) -> dict:
            out: Counter = Counter()
            for group, bag in zip(batch.column("group").to_pylist(), batch.column("bag").to_pylist(), strict=True):
                own = terms_of(bag)
                for t in own if wanted is None else own & wanted:
                    out[t] += 1 / copies[kind, group]
            return {"term": list(out), "n": list(out.values())}

        return per_batch(held_rows.filter(F.col("toxic") == kind).select("group", "bag"), count, "term string, n double", "bag").groupBy("term").agg(F.round(F.sum("n"), 6).alias("n"))

    own = [x + end for x in names for end in ("", " ")]
    toxic = {r.term: r.n for r in counted(1, None).filter((F.col("n") >= least) | F.col("term").isin(own)).collect()} if all(n) else {}  # at most 1 / share times a row's terms
    other = {r.term: r.n for r in counted(0, set(toxic)).collect()} if toxic else {}
    lexicon = learn(toxic, other, n, least)
    if not all(n):
        return lexicon

    def summed(batch: pa.RecordBatch) -> dict:
        total, _, words = lexicon.sums(batch.column("text").to_pylist(), lexicon.automaton())
        return {"doc_id": batch.column("doc_id"), "toxic": batch.column("toxic"), "total": total, "words": words}

    got = per_batch(held_rows.select("doc_id", "toxic", "text"), summed, "doc_id long, toxic int, total double, words long").orderBy("doc_id").collect()  # at most 2 * most rows
    y = np.array([r.toxic for r in got], float)
    weight = np.where(y == 1, sizes.get(1, 0) / max(1, y.sum()), sizes.get(0, 0) / max(1, (1 - y).sum()))
    lexicon.curve = tuple(curve(shaped(np.array([r.total for r in got]), np.array([r.words for r in got])), y, weight / weight.mean()).tolist())
    return lexicon


def curve(x: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 30) -> np.ndarray:
    """Weighted logistic regression by Newton steps, with a small penalty; the slopes are kept from being negative."""
    beta = np.zeros(x.shape[1])
    live = np.ones(x.shape[1], bool)
    for _ in range(2):
        beta[:] = 0
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
            g = x.T @ (weight * (y - p)) - 1e-2 * beta
            h = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(x.shape[1])
            step = np.zeros(x.shape[1])
            step[live] = np.linalg.solve(h[np.ix_(live, live)], g[live])
            beta += np.clip(step, -2, 2)
        if (beta[1:] >= 0).all():
            break
        live[1:] &= beta[1:] >= 0
    return beta


def _stable(word: str) -> int:
    from zlib import crc32

    data = word.encode()
    return crc32(data, 0x5BD1E995) << 31 | crc32(data) >> 1


def add_scores(df: DataFrame, lexicon: Lexicon, text: str = "text") -> DataFrame:
    """``df`` with score, predicted and matches."""
    made: list = []

    @F.pandas_udf("struct<score:double,predicted:int,matches:int>")
    def scored(texts: pd.Series) -> pd.DataFrame:
        if not made:
            made.append(lexicon.automaton())
        parts = []
        for part in slices(pa.record_batch([pa.array(texts, pa.string(), from_pandas=True)], ["text"]), "text"):
            total, matches, words = lexicon.sums(part.column("text").to_pylist(), made[0])
            score = lexicon.score(total, words)
            parts.append(pd.DataFrame({"score": score, "predicted": (score >= 0.5).astype(np.int32), "matches": matches.astype(np.int32)}))
        return pd.concat(parts, ignore_index=True) if parts else pd.DataFrame({"score": [], "predicted": [], "matches": []})

    own = unused("toxicity", df)
    scored_df = df.withColumn(own, scored.asNondeterministic()(F.col(text)))
    return scored_df.withColumns({c: F.col(f"{own}.{c}") for c in ("score", "predicted", "matches")}).drop(own)


def digest(docs: DataFrame, labels: DataFrame, most: int = 3000) -> DataFrame:
    lexicon = fit(docs, labels, most)
    scored = add_scores(docs.select("doc_id", "text"), lexicon)
    return scored.select("doc_id", F.coalesce(fold_of(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out"), "score", "predicted", "matches")
