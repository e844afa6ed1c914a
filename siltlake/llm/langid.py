"""Language identification with interpolated Kneser-Ney character models.

A word, lower-cased and framed by a start and an end mark, is spelled by a character model of
each language. Spark counts the n-grams and fits each language in a task of its own; the model is a
row for each n-gram that a language has, with its interpolated log-probability and its back-off
weight, in one array sorted by 64-bit hash. What a language lacks is backed off from what it has. A document
gets the language with the lowest cross-entropy per character; it is rejected when that entropy
lies further above the language's own mean than calibration allows. Mean and spread come from a
part of the sample that the models are not fitted on, at every size of the table.

Defined results: a null text or one without a letter is `und`, with score 0, and is rejected; a
corpus with nothing to learn from gives `und` everywhere; a language without documents to calibrate on
rejects nothing; ties go to the first language in
alphabetical order; repeated rows get equal results; an empty table gives no rows; columns besides
doc_id, text and lang are ignored. Texts of any length are read whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltlake.llm.common import WordTable, cut, fraction, held_out, mixed, per_text, table, texts

ORDER = 5
#: Expected number of documents a language's model is fitted on: the bound on the sample.
TRAIN_DOCS = 1_500
#: Part of that sample kept for calibrating rejection.
CALIBRATION = 0.2
#: Standard deviations of a language's own cross-entropy beyond which a text is rejected.
REJECT_Z = 8.0
#: Nats a character beyond the language's mean that are never rejected.
REJECT_LEAST = 1.2
#: Characters of the texts whose words a worker looks up together, but for a longer text.
TOGETHER = 300_000
START, END = "\u0002", "\u0003"
#: Words of letters alone; letters next to digits, as in keys, say nothing about a language.
WORD = re.compile(r"\b[^\W\d_]+\b")
LETTERS = re.compile(r"[^\W\d_]+")
SCHEMA = "lang_pred string, score double, cross_entropy double, rejected boolean"


def combined(codes: list[np.ndarray]) -> np.ndarray:
    """Hash of the n-grams whose characters stand at the same place of each array."""
    out = np.zeros(len(codes[0]), np.uint64)
    for c in codes:
        out = out * np.uint64(0x9E3779B97F4A7C15) + c
    return mixed(out + np.uint64(len(codes)))


def gram_hashes(codes: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n codes that end at each place; places before n-1 are meaningless."""
    out = np.zeros(len(codes), np.uint64)
    if len(codes) >= n:
        out[n - 1 :] = combined([codes[k : len(codes) - n + 1 + k] for k in range(n)])
    return out


def rows_of(known: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of wanted are in the sorted array known, and where."""
    if not len(known):
        return np.zeros(len(wanted), bool), np.zeros(len(wanted), np.int64)
    at = np.minimum(np.searchsorted(known, wanted), len(known) - 1)
    return known[at] == wanted, at


def fit_language(grams: list[str], counts: list[int], order: int, uniform: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Sorted hashes of a language's n-grams, their log-probabilities and back-off weights, and the log-probability of a character it lacks.

    grams are all n-grams of 1 to order characters of the framed words, with how often they occur.
    """
    of_size: list[list[int]] = [[] for _ in range(order + 1)]
    for i, g in enumerate(grams):
        of_size[len(g)].append(i)
    n_of = np.array(counts, float)
    code, count = [None] * (order + 1), [np.zeros(0)] * (order + 1)
    for n in range(1, order + 1):
        flat = np.frombuffer("".join(grams[i] for i in of_size[n]).encode("utf-32-le"), np.uint32).astype(np.uint64).reshape(-1, n)
        by = np.argsort(combined(list(flat.T)), kind="stable")
        code[n], count[n] = flat[by], n_of[of_size[n]][by]
    hashed = [None, *(combined(list(code[n].T)) for n in range(1, order + 1))]
    # Below the highest order a gram counts the characters seen before it, unless it starts a word.
    used = [None, *count[1:]]
    for n in range(1, order):
        after, kinds = np.unique(combined(list(code[n + 1][:, 1:].T)), return_counts=True)
        met, at = rows_of(after, hashed[n])
        used[n] = np.where(met & (code[n][:, 0] != ord(START)), kinds[at] if len(kinds) else 0, count[n])
    used[1] = np.where(code[1][:, 0] == ord(START), 0, used[1])  # no character: it only begins contexts
    out_h, out_p, out_b = [], [], []
    lower, missing = np.full(len(code[1]), np.exp(uniform)), uniform
    for n in range(1, order + 1):
        live = used[n] > 0
        once, twice = (int((used[n] == k).sum()) for k in (1, 2))
        d = min(0.95, max(0.1, once / (once + 2 * twice) if once + twice else 0.5))
        if n > 1:
            _, at = rows_of(hashed[n - 1], combined(list(code[n][:, 1:].T)))
            lower = out_p[-1][at]
            context = combined(list(code[n][:, :-1].T))
        else:
            context = np.zeros(len(code[1]), np.uint64)
        known, of = np.unique(context, return_inverse=True)
        total, kinds = np.bincount(of, used[n], len(known)), np.bincount(of[live], minlength=len(known))
        p = (np.maximum(used[n] - d, 0) + d * kinds[of] * lower) / np.maximum(total[of], 1)
        out_p.append(np.maximum(np.where(total[of] > 0, p, lower), 1e-12))
        out_h.append(hashed[n])
        out_b.append(np.zeros(len(hashed[n])))
        weight = np.log(d * np.maximum(kinds, 1) / np.maximum(total, 1))
        if n > 1:
            met, at = rows_of(hashed[n - 1], known)
            out_b[n - 2][at[met]] = weight[met]
        elif len(weight):
            missing = uniform + float(weight[0])
    hashes, logp, back = np.concatenate(out_h), np.log(np.concatenate(out_p)), np.concatenate(out_b)
    by = np.argsort(hashes, kind="stable")
    return hashes[by], logp[by].astype(np.float32), back[by].astype(np.float32), missing


class Model:
    """Kneser-Ney models of several languages over one array of n-grams sorted by hash; each n-gram has the rows of the languages that know it."""

    def __init__(self, fitted: dict[str, tuple[np.ndarray, np.ndarray, np.ndarray, float]], order: int = ORDER):
        """fitted: what fit_language gives, by language."""
        self.langs, self.order = sorted(fitted), order
        parts = [fitted[name] for name in self.langs]
        hashes = np.concatenate([p[0] for p in parts])
        by = np.argsort(hashes, kind="stable")
        self.lang = np.repeat(np.arange(len(parts), dtype=np.int32), [len(p[0]) for p in parts])[by]
        self.logp, self.back = (np.concatenate([p[k] for p in parts])[by] for k in (1, 2))
        self.missing = np.array([p[3] for p in parts], np.float32)
        self.hashes, first = np.unique(hashes[by], return_index=True)
        self.first = np.append(first, len(hashes))
        self.mean, self.spread, self.noise = np.full(len(parts), np.inf), np.ones(len(parts)), np.ones(len(parts))

    def _rows(self, place: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The flat place of each place and language that knows the n-gram wanted there, and its row."""
        met, at = rows_of(self.hashes, wanted)
        at = at[met]
        low, n = self.first[at], self.first[at + 1] - self.first[at]
        row = np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())
        return np.repeat(place[met] * len(self.langs), n) + self.lang[row], row

    def spell(self, words: list[str]) -> np.ndarray:
        """Log-probability of each word in each language, and in the last column its characters."""
        framed = "".join(f"{START}{w}{END}" for w in words)
        codes = np.frombuffer(framed.encode("utf-32-le"), np.uint32).astype(np.uint64)
        starts = np.flatnonzero(codes == ord(START))
        length = np.diff(np.append(starts, len(codes)))
        place = np.arange(len(codes)) - np.repeat(starts, length)
        hashes = [None, *(gram_hashes(codes, n) for n in range(1, self.order + 1))]
        width = len(self.langs)
        # Flat over places and languages: what is spelled so far, and whether a place is still to be spelled.
        got, todo = np.zeros(len(codes) * width, np.float32), np.repeat(place > 0, width)
        for n in range(self.order, 0, -1):
            now = np.flatnonzero((place >= max(1, n - 1)) & todo.reshape(-1, width).any(axis=1))
            at, row = self._rows(now, hashes[n][now])
            new = todo[at]
            at, row = at[new], row[new]
            got[at] += self.logp[row]
            todo[at] = False
            if n > 1:
                now = now[todo.reshape(-1, width)[now].any(axis=1)]
                at, row = self._rows(now, hashes[n - 1][now - 1])
                new = todo[at]
                got[at[new]] += self.back[row[new]]
        got = got.reshape(-1, width)
        got += todo.reshape(-1, width) * self.missing
        out = np.zeros((len(words), width + 1), np.float32)
        out[:, :-1] = np.add.reduceat(got, starts, axis=0)
        out[:, -1] = length - 1
        return out

    def calibrate(self, rows: list[tuple[str, float, int]]) -> None:
        """rows: language, cross-entropy under its own model, characters."""
        for j, lang in enumerate(self.langs):
            x = np.array([(e, n) for own, e, n in rows if own == lang and n], float).reshape(-1, 2)
            if len(x):
                self.mean[j] = np.average(x[:, 0], weights=x[:, 1])
                off = x[:, 0] - self.mean[j]
                self.spread[j] = max(0.05, np.sqrt(np.average(off**2, weights=x[:, 1])))
                self.noise[j] = max(1.0, np.sqrt(np.mean(off**2 * x[:, 1])))


def scorer(model: Model):
    """lang_pred, score, cross_entropy and rejected of each of a list of texts; words of some texts are looked up together."""
    known = WordTable(model.spell, len(model.langs) + 1, np.float32)

    def score(texts: list[str | None]) -> list[tuple[str, float, float | None, bool]]:
        out: list[tuple] = [("und", 0.0, None, True)] * len(texts)
        found, chars = [], 0
        for i, text in enumerate(texts):
            low = text.lower() if text else ""
            words = WORD.findall(low) or LETTERS.findall(low)
            if words and any(map(str.isalpha, text)):
                found.append((i, words))
                chars += len(text)
            if found and (chars > TOGETHER or i == len(texts) - 1):
                for (k, _), row in zip(found, verdicts([words for _, words in found])):
                    out[k] = row
                found, chars = [], 0
        return out

    def verdicts(spelled: list[list[str]]) -> Iterator[tuple[str, float, float, bool]]:
        known.room()
        at = known.indexes([w for words in spelled for w in words])
        starts = np.cumsum([0, *map(len, spelled[:-1])])
        sums = np.add.reduceat(known.rows[at], starts, axis=0, dtype=np.float64)
        n, entropy = sums[:, -1], -sums[:, :-1] / sums[:, -1:]
        best = entropy.argmin(axis=1)
        least = entropy.min(axis=1)
        sure = 1 / np.exp((least[:, None] - entropy) * np.minimum(n, 40)[:, None]).sum(axis=1)
        limit = np.maximum(REJECT_LEAST, REJECT_Z * np.maximum(model.spread[best], model.noise[best] / np.sqrt(n)))
        rejected = least - model.mean[best] > limit
        return zip([model.langs[b] for b in best.tolist()], sure.tolist(), least.tolist(), rejected.tolist())

    return score


def fit_batch(order: int, uniform: float):
    def run(rows: pa.Table) -> pa.Table:
        hashes, logp, back, missing = fit_language(rows["gram"].to_pylist(), rows["n"].to_pylist(), order, uniform)
        n = len(hashes)
        return pa.table({
            "lang": pa.array([rows["lang"][0].as_py()] * n, pa.string()), "hash": pa.array(hashes.view(np.int64)), "logp": pa.array(logp), "back": pa.array(back),
            "missing": pa.array(np.full(n, missing)),
        })

    return run


def learn(docs: DataFrame, order: int = ORDER, train_docs: int = TRAIN_DOCS) -> Model | None:
    """Fits the models on a sample of about train_docs documents of each language, none held out.

    The sample's bound also bounds what a task fits and the rows that come to the driver, so many bytes
    for each n-gram of each language. A language with no letters in its sample has no model; with none at all there is no model.
    """
    rows = docs.select("doc_id", "text", "lang").where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~F.coalesce(held_out(F.col("doc_id")), F.lit(False)))
    apart = fraction(F.col("doc_id"), 11) < CALIBRATION
    sizes = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.count_if(~apart).alias("n_fit")).collect()  # one row for each language
    if not sizes:
        return None
    rate = F.create_map(*[F.lit(x) for r in sizes for x in (r["lang"], min(1.0, train_docs / r["n"]))])
    sample = rows.where(fraction(F.col("doc_id"), 10) < rate[F.col("lang")])
    calibration = apart & F.col("lang").isin([r["lang"] for r in sizes if r["n_fit"]])
    word = F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"(?<![\p{L}\p{N}_])(\p{L}++)(?![\p{N}_])"), 1)).alias("word")
    words = sample.where(~calibration).select("lang", word).groupBy("lang", "word").count()
    framed = F.concat(F.lit(START), "word", F.lit(END))
    sizes_of = F.sequence(F.lit(1), F.least(F.lit(order), F.length("framed")))
    grams = F.flatten(F.transform(sizes_of, lambda n: F.transform(F.sequence(F.lit(1), F.length("framed") - n + 1), lambda i: F.substring(F.col("framed"), i, n))))
    counted = words.select("lang", framed.alias("framed"), "count").select("lang", "count", F.explode(grams).alias("gram"))
    counted = cut(counted.groupBy("lang", "gram").agg(F.sum("count").alias("n")))
    n_characters = counted.where(F.length("gram") == 1).agg(F.count_distinct("gram")).first()[0]
    if not n_characters:
        return None
    found = counted.groupBy("lang").applyInArrow(fit_batch(order, -float(np.log(1 + n_characters))), "lang string, hash long, logp float, back float, missing double").toArrow()
    fitted = {}
    names = found["lang"].to_numpy(zero_copy_only=False)
    columns = [found[c].to_numpy() for c in ("hash", "logp", "back", "missing")]
    for name in sorted(set(names)):
        mine = names == name
        hashes, logp, back, missing = (c[mine] for c in columns)
        fitted[name] = (hashes.view(np.uint64), logp, back, float(missing[0]))
    model = Model(fitted, order)
    model.calibrate([tuple(r) for r in sample.where(calibration).select("text", "lang").mapInArrow(own_entropy(model), "lang string, entropy double, n long").collect()])
    return model


def own_entropy(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordTable(model.spell, len(model.langs) + 1, np.float32)
        for batch in batches:
            out = []
            for text, lang in zip(batch["text"].to_pylist(), batch["lang"].to_pylist()):
                known.room()
                if lang in model.langs and (words := WORD.findall(text.lower())):
                    total = known.take(words).sum(axis=0, dtype=np.float64)
                    out.append((lang, -total[model.langs.index(lang)] / total[-1], int(total[-1])))
            names, entropy, n = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(entropy, pa.float64()), pa.array(n, pa.int64())], ["lang", "entropy", "n"])

    return run


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, lang_pred, score, cross_entropy and rejected for every row of docs."""
    if model is None:
        return texts(docs).select("doc_id", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(None).cast("double").alias("cross_entropy"), F.lit(True).alias("rejected"))
    return per_text(texts(docs), lambda: scorer(model), SCHEMA)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = identify(docs, learn(docs))
    return found.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "lang_pred", "score", "cross_entropy", "rejected")
