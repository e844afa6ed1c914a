"""Toxicity by a weighted lexicon.

Texts are folded: lower case, homoglyphs and accents to plain letters, digits and signs that stand
for letters to those letters. The lexicon and its weights are learned from labelled documents: a
folded word enters it when toxic documents hold it significantly more often than others. Phrases of
a term and a neighbour that speak against toxicity are exceptions and do not count. An Aho-Corasick
automaton finds the terms; the weights found, alone and by length, make a score that a logistic
function calibrates.

Defined results: null and empty texts get the score of a text without hits; with no labelled rows,
or none toxic, every score is 0; null labels are skipped; of several labels of a document the larger counts; repeated rows
get equal results, and a score at the threshold counts as toxic; an empty table gives no rows; columns
besides doc_id and text (and toxic in labels) are ignored. Texts of any length are scanned whole.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltlake.llm.common import cut, each, fraction, held_out, per_text, table, texts

#: Expected number of labelled documents to learn from: the bound on the sample.
TRAIN_DOCS = 20_000
#: A term needs this many toxic documents and this z-score.
LEAST_DOCS, LEAST_Z = 4, 5.0
#: It must follow this many different words for each toxic document: copies of one text do not.
LEAST_CONTEXTS = 0.25
#: A phrase is an exception with so many documents and at most this share of the term's toxic rate.
EXCEPTION_DOCS, EXCEPTION_SHARE = 5, 0.25
THRESHOLD = 0.3
SCHEMA = "score double, n_hits long, n_exceptions long, matched string"

#: Signs read as letters; l is folded with i, as 1 stands for either.
SIGNS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "i", "l": "i"}
#: Letters of other scripts that look like Latin ones.
LOOKALIKES = dict(zip("авекмнорстухіјѕԁһӏԛԝαβεικνορτυχωѵɑɡıʟց", "abekmhopctyxijsdhiqwabeikvoptuxwvagiig"))
GAPS = "​‌‍⁠﻿­"
WORD = re.compile(r"[^\W_]+")


def folding() -> dict[int, str | None]:
    """The table for str.translate."""
    out: dict[int, str | None] = {}
    for a in (*range(0xC0, 0x250), *range(0x1E00, 0x1F00), *range(0xFF01, 0xFF5F), *range(0x1D400, 0x1D800)):
        plain = "".join(c for c in unicodedata.normalize("NFKD", chr(a)).lower() if not unicodedata.combining(c))
        if plain.isascii() and plain:
            out[a] = "".join(SIGNS.get(c, c) for c in plain)
    out |= {ord(a): SIGNS.get(b, b) for a, b in LOOKALIKES.items()} | {ord(a): b for a, b in SIGNS.items()}
    out |= {a: None for a in (*map(ord, GAPS), *range(0x300, 0x370))}
    return out


FOLDING = folding()


def fold(text: str) -> str:
    return text.lower().translate(FOLDING)


@dataclass
class Lexicon:
    weights: dict[str, float] = field(default_factory=dict)
    exceptions: set[tuple[str, str]] = field(default_factory=set)
    coefficients: tuple[float, float, float] = (0.0, 0.0, 0.0)
    bias: float = -100.0

    def automaton(self) -> ahocorasick.Automaton | None:
        if not self.weights:
            return None
        found = ahocorasick.Automaton()
        for term in self.weights:
            found.add_word(term, term)
        found.make_automaton()
        return found

    def score(self, x: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.bias + np.dot(self.coefficients, x), -500, 500))))


def neighbour(text: str, at: int, step: int) -> str:
    """The word before (step -1) or after (step 1) the place in a folded text, however far and long it is."""
    if step > 0:
        met = WORD.search(text, at)
        return met[0] if met else ""
    end = at
    while end and not text[end - 1].isalnum():
        end -= 1
    begin = end
    while begin and text[begin - 1].isalnum():
        begin -= 1
    return text[begin:end]


def hits(text: str, automaton, exceptions: set[tuple[str, str]]) -> Iterator[tuple[str, str, str, bool]]:
    """Each term that stands as a whole word: with the words before and after, and whether it is excepted."""
    if automaton is None:
        return
    for last, term in automaton.iter(text):
        begin, end = last + 1 - len(term), last + 1
        if (begin and (text[begin - 1].isalnum())) or (end < len(text) and text[end].isalnum()):
            continue
        before, after = neighbour(text, begin, -1), neighbour(text, end, 1)
        yield term, before, after, (before, term) in exceptions or (term, after) in exceptions


def features(text: str, lexicon: Lexicon, automaton) -> tuple[np.ndarray, list[str], int]:
    folded = fold(text or "")
    found, excepted = [], 0
    for term, _, _, free in hits(folded, automaton, lexicon.exceptions):
        if free:
            excepted += 1
        else:
            found.append(term)
    weight = sum(lexicon.weights[t] for t in found)
    n_words = folded.count(" ") + folded.count("\n") + 1
    return np.array([float(bool(found)), np.log1p(weight), 100 * weight / (n_words + 100)]), found, excepted


def word_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        n: Counter = Counter()
        for text, toxic in zip(batch["text"], batch["toxic"]):
            n.update((w, toxic) for w in set(WORD.findall(fold(text or ""))) if len(w) > 2)
        yield pd.DataFrame([(w, t, c) for (w, t), c in n.items()], columns=["word", "toxic", "n"])


def phrase_batches(lexicon: Lexicon):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        automaton = lexicon.automaton()
        for batch in batches:
            n: Counter = Counter()
            for text, toxic in zip(batch["text"], batch["toxic"]):
                pairs = {p for term, a, b, _ in hits(fold(text or ""), automaton, set()) for p in ((a, term, -1), (term, b, 1)) if p[0] and p[1]}
                n.update((*p, toxic) for p in pairs)
            yield pd.DataFrame([(*k, c) for k, c in n.items()], columns=["first", "second", "side", "toxic", "n"])

    return run


def feature_batches(lexicon: Lexicon):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        automaton = lexicon.automaton()
        for batch in batches:
            rows = [(*map(float, features(t, lexicon, automaton)[0]), int(y)) for t, y in zip(batch["text"], batch["toxic"])]
            yield pd.DataFrame(rows, columns=["a", "b", "c", "y"])

    return run


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 40) -> np.ndarray:
    """Newton's method; the last coefficient is the bias."""
    x = np.column_stack([x, np.ones(len(x))])
    b = np.zeros(x.shape[1])
    b[-1] = np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6))
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(b))
        step = np.linalg.solve(h, x.T @ (y - p) - ridge * b)
        b = b + step
        if np.abs(step).max() < 1e-6:
            break
    return b


def learn(docs: DataFrame, labels: DataFrame, train_docs: int = TRAIN_DOCS) -> Lexicon:
    """Fits lexicon, exceptions and calibration on a sample of about train_docs labelled documents, none held out."""
    marked = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where(F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id")))
    n = marked.count()
    if not n:
        return Lexicon()
    marked = marked.where(fraction(F.col("doc_id"), 6) < min(1.0, train_docs / n)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    # At most about train_docs rows of 12 bytes: small enough to go everywhere.
    rows = cut(texts(docs).join(F.broadcast(marked), "doc_id").select("text", "toxic"))
    sizes = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    bad, good = sizes.get(1, 0), sizes.get(0, 0)
    if not bad or not good:
        return Lexicon()
    words = rows.mapInPandas(word_batches, "word string, toxic int, n long").groupBy("word").agg(F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("b"), F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("g"))
    pooled = (F.col("b") + F.col("g")) / float(bad + good)
    z = (F.col("b") / bad - F.col("g") / good) / F.sqrt(pooled * (1 - pooled) * (1 / bad + 1 / good) + 1e-12)
    ratio = F.log((F.col("b") + 0.5) / (bad + 1.0)) - F.log((F.col("g") + 0.5) / (good + 1.0))
    terms = words.where((F.col("b") >= LEAST_DOCS) & (z >= LEAST_Z) & (ratio > 0.7)).select("word", ratio.alias("w")).collect()
    lexicon = Lexicon({r["word"]: float(r["w"]) for r in terms})
    if not lexicon.weights:
        return Lexicon(bias=float(np.log(bad / good)))
    rate = bad / (bad + good)
    phrases = rows.mapInPandas(phrase_batches(lexicon), "first string, second string, side int, toxic int, n long").groupBy("first", "second", "side").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("b"))
    phrases = cut(phrases)
    varied = phrases.where((F.col("side") == -1) & (F.col("b") > 0)).groupBy("second").agg(F.count(F.lit(1)).alias("contexts"), F.sum("b").alias("b")).where((F.col("contexts") >= LEAST_DOCS) & (F.col("contexts") >= LEAST_CONTEXTS * F.col("b")))
    diverse = {r["second"] for r in varied.collect()}
    lexicon.weights = {t: w for t, w in lexicon.weights.items() if t in diverse}
    free = phrases.where((F.col("n") >= EXCEPTION_DOCS) & (F.col("b") <= F.col("n") * EXCEPTION_SHARE * rate)).select("first", "second").collect()
    lexicon.exceptions = {(r["first"], r["second"]) for r in free}
    fitted = np.array(rows.mapInPandas(feature_batches(lexicon), "a double, b double, c double, y int").collect(), float)
    *lexicon.coefficients, lexicon.bias = map(float, logistic(fitted[:, :3], fitted[:, 3]))
    return lexicon


def scorer(lexicon: Lexicon):
    automaton = lexicon.automaton()

    def score(text: str | None) -> tuple[float, int, int, str]:
        x, found, excepted = features(text, lexicon, automaton)
        return lexicon.score(x), len(found), excepted, ",".join(sorted(set(found)))

    return score


def toxicity(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """Score and matched terms for every row of docs."""
    return per_text(texts(docs), each(lambda: scorer(lexicon)), SCHEMA)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = toxicity(docs, learn(docs, table(spark, sf_dir, "labels")))
    return found.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "n_hits", "n_exceptions", "matched")
