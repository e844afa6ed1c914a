"""Quality rules: base counts of a text, and the fertility of public tokenizers on it.

Base counts follow their definitions literally. The method tokenises each distinct word with
two public vocabularies, a byte-level BPE and a BPE with byte fallback, and measures over the
whole text: characters per token of both, the share of byte-fallback tokens, and the entropy
of the tokens. Each measure has a band per script; a text outside a band is rejected. A band is taken
from the table: the quantiles of the measure at the tail share TAIL on both sides, over all texts of the
script that pass the base rules, widened by the greater of their distances from the median. Junk of up to
that share of a script does not move its bands. The fixed BANDS hold as well; a script's own edges lie between
those and its quantiles' by the number n of such texts, as n / (n + EVEN_DOCS), so that a few texts say little and no number of
texts switches a rule on. As bands come from the table, documents that are added may change the verdict of others.

Defined results: null or blank texts have no words, so every count is 0 and base_failed is true;
texts that pass the base rules are judged by the bands, however short; a measure on a band's edge is inside; repeated rows get
equal results and count once each for the bands; an empty table gives no rows; columns besides doc_id and text are ignored. Texts of
any length are read whole.
"""

from __future__ import annotations

import base64
import re
import unicodedata
from collections import Counter

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltlake.llm.common import WordTable, cut, each, mixed, per_text, rolled, table, texts

#: Names of the public vocabularies: with byte fallback, and byte-level.
VOCABULARIES = ("piece_bpe_32k.model", "byte_bpe_50k.tiktoken")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
ASCII_LETTER = re.compile(r"[A-Za-z]")
SYMBOLS = "#*$%&|<>"
WINDOW = 5
MIN_WORDS = 10
MOST_REPEATED = 20  # per cent of words
#: Distinct words whose tokens a worker remembers.
WORDS = 600_000
#: Share of a script's texts that may lie beyond either quantile, and how many texts make its own edges count as much as the fixed ones.
TAIL, EVEN_DOCS = 0.05, 25
#: Least widening of a band: characters per token, byte-fallback share, share of the even entropy.
LEAST_WIDENING = {"chars_per_token": 0.25, "chars_per_byte_bpe_token": 0.25, "byte_share": 0.1, "token_entropy": 0.1}
#: Ids of the byte-fallback tokens in the vocabulary with byte fallback.
BYTE_IDS = (3, 259)
#: Outermost bands by script: least and most characters per token (byte fallback BPE, byte-level
#: BPE), most byte-fallback share, least share of the entropy that evenly used tokens would have.
BANDS = {
    "LATIN": ((1.3, 9.0), (1.2, 9.0), 0.20, 0.35),
    "CYRILLIC": ((0.8, 9.0), (0.4, 9.0), 0.30, 0.35),
    "GREEK": ((0.5, 9.0), (0.3, 9.0), 0.50, 0.35),
    "CJK": ((0.3, 4.0), (0.2, 4.0), 0.80, 0.35),
    "HIRAGANA": ((0.3, 4.0), (0.2, 4.0), 0.80, 0.35),
    "HANGUL": ((0.2, 4.0), (0.2, 4.0), 0.95, 0.35),
    "other": ((0.2, 9.0), (0.15, 9.0), 0.98, 0.30),
    "none": ((0.5, 9.0), (0.4, 9.0), 0.20, 0.30),
}
SCHEMA = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, script string, chars_per_token double, chars_per_byte_bpe_token double, byte_share double, token_entropy double, reason string"


class Tokens:
    """Token counts of words under two vocabularies, and the ids under the first."""

    def __init__(self, where: tuple[str, str] | None = None):
        import sentencepiece
        import tiktoken
        from public_tokenizers import PATTERN, path

        pieces, ranked = where or map(path, VOCABULARIES)
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=pieces)
        with open(ranked, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.bytes = tiktoken.Encoding("byte_bpe_50k", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.ids: list[bytes] = []

    def make(self, words: list[str]) -> np.ndarray:
        """By word: a random code, characters, tokens of the byte-level BPE."""
        ids = self.pieces.encode(words, num_threads=1)
        self.ids += [np.array(x, np.uint16).tobytes() for x in ids]
        n = len(self.ids)
        code = mixed(np.arange(n - len(words) + 1, n + 1, dtype=np.uint64)).view(np.int64)
        length = np.fromiter(map(len, words), np.int64, len(words))
        fine = np.fromiter((len(self.bytes.encode_ordinary(w)) for w in words), np.int64, len(words))
        return np.stack([code, length, fine], axis=1)


def script(text: str) -> str:
    """The script of most of the text's letters."""
    if text.isascii():
        return "LATIN" if ASCII_LETTER.search(text) else "none"
    found: dict[str, int] = {}
    for c, n in Counter(text).items():
        if c.isalpha():
            name = unicodedata.name(c, "other").split()[0]
            name = name if name in BANDS else "other"
            found[name] = found.get(name, 0) + n
    return max(sorted(found), key=found.get) if found else "none"


def repeated_words(codes: np.ndarray, window: int = WINDOW) -> int:
    """Words inside windows that occur twice or more, the first occurrence included."""
    windows = rolled(codes, window)
    if len(windows) < 2:
        return 0
    _, which, times = np.unique(windows, return_inverse=True, return_counts=True)
    again = times[which] > 1
    if not again.any():
        return 0
    edge = np.zeros(len(codes) + 1, np.int64)
    edge[: len(windows)] += again
    edge[window : window + len(windows)] -= again
    return int((edge.cumsum()[:-1] > 0).sum())


def duplicate_lines(text: str) -> int:
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(lines) - len(set(lines))


def verdict(name: str, coarse: float, fine: float, share: float, entropy: float, n: int) -> str:
    """The first band that the measures leave, else an empty string."""
    (low, high), (low2, high2), most, least = BANDS[name]
    if not low <= coarse <= high:
        return "chars_per_token"
    if not low2 <= fine <= high2:
        return "chars_per_byte_bpe_token"
    if share > most:
        return "byte_share"
    if entropy < least * np.log2(min(n, 1000)):
        return "token_entropy"
    return ""


def scorer(where: tuple[str, str] | None = None):
    """Counts and measures of a text, and the verdict of the fixed bands."""
    tokens = Tokens(where)
    known = WordTable(tokens.make, 3, np.int64, WORDS)

    def measure(text: str | None) -> tuple:
        if len(known.at) > known.most:
            known.clear()
            tokens.ids.clear()
        text = text or ""
        words = WORD.findall(text)
        at = known.indexes(words)
        codes, length, fine = known.rows[at].T
        chars, n_fine = int(length.sum()), int(fine.sum())
        repeats = repeated_words(codes.view(np.uint64).copy())
        used = np.bincount(np.frombuffer(b"".join(map(tokens.ids.__getitem__, at.tolist())), np.uint16), minlength=BYTE_IDS[1])
        n, in_bytes = int(used.sum()), int(used[slice(*BYTE_IDS)].sum())
        p = used[used > 0] / max(n, 1)
        entropy = float(-(p * np.log2(p)).sum()) if n else 0.0
        failed = len(words) < MIN_WORDS or 100 * repeats > MOST_REPEATED * len(words)
        name = script(text)
        measures = (chars / max(n, 1), chars / max(n_fine, 1), in_bytes / max(n, 1), entropy)
        reason = "base" if failed else verdict(name, *measures, n)
        return len(words), chars, sum(map(text.count, SYMBOLS)), duplicate_lines(text), repeats, failed, not reason, name, *measures, reason

    return measure


def banded() -> dict[str, Column]:
    """The measures that bands are taken of; entropy as a share of what evenly used tokens would have."""
    n = F.round(F.col("word_chars") / F.col("chars_per_token"))
    even = F.greatest(F.lit(1.0), F.log2(F.least(n, F.lit(1000.0))))
    return {m: F.col(m) / even if m == "token_entropy" else F.col(m) for m in LEAST_WIDENING}


def bands_of(measured: DataFrame) -> DataFrame:
    """script, and for each measure low_ and high_: the bands by the texts that pass the base rules."""
    live = measured.where(~F.col("base_failed"))
    # On a grid, so that a group holds a bounded number of distinct values and the result depends on no order.
    quantiles = [F.percentile(F.round(x, 3), F.array(F.lit(TAIL), F.lit(0.5), F.lit(1 - TAIL))).alias(m) for m, x in banded().items()]
    found = live.groupBy(F.col("script").alias("of")).agg(F.count(F.lit(1)).alias("n_docs"), *quantiles)
    own = F.col("n_docs") / (F.col("n_docs") + EVEN_DOCS)
    fixed = lambda edge: F.create_map(*[F.lit(x) for name, band in BANDS.items() for x in (name, float(edge(band)))])[F.col("of")]
    outer = {
        "chars_per_token": (fixed(lambda b: b[0][0]), fixed(lambda b: b[0][1])), "chars_per_byte_bpe_token": (fixed(lambda b: b[1][0]), fixed(lambda b: b[1][1])),
        "byte_share": (F.lit(0.0), fixed(lambda b: b[2])), "token_entropy": (fixed(lambda b: b[3]), F.lit(1.0)),
    }
    out = [F.col("of")]
    for m, least in LEAST_WIDENING.items():
        low, middle, high = (F.col(m)[k] for k in range(3))
        wide = F.greatest(middle - low, high - middle, F.lit(least))
        least_of, most_of = outer[m]
        out += [(own * (low - wide) + (1 - own) * least_of).alias(f"low_{m}"), (own * (high + wide) + (1 - own) * most_of).alias(f"high_{m}")]
    return found.select(*out)


def judged(measured: DataFrame, bands: DataFrame) -> DataFrame:
    """measured with the verdict of bands where no fixed band and no base rule rejects a text."""
    joined = measured.join(F.broadcast(bands), F.col("script") == F.col("of"), "left")
    reason = F.lit("")
    for m, x in reversed(banded().items()):
        low, high = x < F.col(f"low_{m}"), x > F.col(f"high_{m}")
        out = {"byte_share": high, "token_entropy": low}.get(m, low | high)
        reason = F.when(out, F.lit(m)).otherwise(reason)
    joined = joined.withColumn("reason", F.when(F.col("reason") == "", reason).otherwise(F.col("reason")))
    return joined.withColumn("kept", F.col("reason") == "").select(measured.columns)


def quality(docs: DataFrame, vocabularies: tuple[str, str] | None = None) -> DataFrame:
    """Counts, measures and verdict for every row of docs. vocabularies are two files' places, the public ones' if not given."""
    measured = cut(per_text(texts(docs), each(lambda: scorer(vocabularies)), SCHEMA))
    return judged(measured, bands_of(measured))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"))
