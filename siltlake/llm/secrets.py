"""Secret scans with a linear-chain conditional random field.

Tokens are runs of letters and digits, and single signs; a field tags each as the beginning of a secret, inside one or
outside. Secrets do not contain white space, and white space counts as outside: so a text falls into chunks
between white space that decode on their own, with the same result as decoding the whole text. Only chunks
that a secret could stand in are free; these are of LEAST_LENGTH characters or more and have a digit, a
capital after a small letter, or a name of a secret with `:` or `=` in or just before them. All tokens
of other chunks are outside by constraint. So what the field cannot tag is a secret in plain letters of one case
without such a name, and one that white space parts.

Features are a token's shape, length and place in its chunk, the shape, length and entropy of its run of letters,
digits and `+/_.=-`, the two tokens before and after it wherever they stand, and what the file is like. The
weights are learned on a bounded sample, with tags from the base patterns: weak labels only. So that the
field does not just repeat the patterns, every example comes again with what they go by hidden (names of secrets and other
neighbours, characters, exact length), and a run that looks like a key but matches no pattern is not labelled:
training sums over all its tags. Viterbi decodes.

Base patterns are matched literally, each kind from the left and without overlap; their spans always
stay, and the field's spans (kind `crf`) are added where they do not overlap one of them. Spans
are in code points, the end exclusive.

Defined results: null and empty texts have no spans; spans are ordered by start, then kind; ties between taggings go to
the first tag in the order outside, beginning, inside; with nothing to learn from, no spans are added; repeated rows
get equal results; an empty table gives no rows; columns besides doc_id and text are ignored. Texts of any length are
scanned whole, in time that grows with their length and spans.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltlake.llm.common import each, fraction, held_out, per_text, table, texts

#: Expected number of documents with digits to learn from, and of chunks taken from each, by hash: the bound on the sample.
TRAIN_DOCS, TRAIN_CHUNKS = 2_000, 12
#: Tokens of a chunk that one training example has at most; of a longer one a window at a place by hash.
TRAIN_TOKENS = 60
EPOCHS, FEATURES = 25, 1 << 13
#: Least length of a secret that only the field finds, and the least mean odds for its tags over "outside".
LEAST_LENGTH, LEAST_MARGIN = 8, 1.0
#: A run that looks like a key: its least length and its least bits a character.
KEY_LENGTH, KEY_ENTROPY = 16, 3.2
O, B, I = 0, 1, 2  # noqa: E741

#: The base patterns, in the order that spans are listed.
ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "crf")
NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")

TOKEN = re.compile(r"[A-Za-z0-9]+|[^\sA-Za-z0-9]")
RUN = re.compile(r"[A-Za-z0-9+/_.=-]+")
CHUNK = re.compile(r"\S+")
#: A chunk with a digit or a capital after a small letter.
FREE = re.compile(rf"(?<!\S)(?=\S{{{LEAST_LENGTH}}})(?=\S*(?:[0-9]|[a-z][A-Z]))\S+")
#: What names a secret; with it and a sign of assignment the chunk that follows, or the rest of this one, is free.
NAMED = re.compile(r"(?ai:pass(?:word|wd|phrase|code)?|pwd|secret|token|credential|api_?key|access_?key|private_?key|auth|bearer)s?[\"']?\s?[:=]\s?[\"']?(?=\S)")
NAME_PARTS = ("pass", "pwd", "secret", "token", "credential", "key", "auth", "bearer")
NAME_TOKENS = frozenset(NAME_PARTS) | {"password", "passwd", "passphrase", "passcode", "credentials", "apikey", "accesskey", "privatekey"}
SCHEMA = "n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_crf long"
Span = tuple[int, int]


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the base patterns, by start and kind."""
    out = []
    low = text.lower()
    if any(n in low for n in NAMES):
        out += [(*m.span(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [(*m.span(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(*m.span(), "hex") for m in HEX.finditer(text)]
    return sorted(out, key=lambda x: (x[0], KINDS.index(x[2]), x[1]))


def secret_values(text: str, base: list[tuple[int, int, str]]) -> list[Span]:
    """What is secret of each base span, by start: the value alone, of an assignment."""
    return sorted(ASSIGN.match(text, a).span(2) if kind == "assign" else (a, b) for a, b, kind in base)


def shape(token: str) -> str:
    """Runs of character classes, at most eight of them."""
    out = re.sub(r"[a-f]+", "h", re.sub(r"[0-9]+", "0", re.sub(r"[A-Z]+", "X", re.sub(r"[g-z]+", "x", token))))
    return out[:8]


def classes(token: str) -> str:
    return "".join(k for k, p in (("0", "[0-9]"), ("h", "[a-f]"), ("x", "[g-z]"), ("X", "[A-Z]"), ("s", "[^A-Za-z0-9]")) if re.search(p, token))


def entropy(token: str) -> float:
    return -sum(n / len(token) * math.log2(n / len(token)) for n in Counter(token).values())


def free_chunks(text: str) -> list[Span]:
    """The chunks that a secret could stand in."""
    found = {m.start(): m.end() for m in FREE.finditer(text)}
    low = text.lower()
    if any(n in low for n in NAME_PARTS):
        end = 0  # of the chunk looked at last; of its names the first leaves the most behind it
        for m in NAMED.finditer(text):
            if m.end() < end:
                continue
            begin = m.end()
            while begin > end and not text[begin - 1].isspace():
                begin -= 1
            end = CHUNK.match(text, begin).end()
            if end - m.end() >= LEAST_LENGTH:
                found.setdefault(begin, end)
    return sorted(found.items())


def tokens_before(text: str, at: int) -> list[str]:
    """The two tokens before a place, however far off; none where the text begins."""
    for reach in (48, 4096, at):
        low = max(0, at - reach)
        found = TOKEN.findall(text, low, at)
        if len(found) > 2 or not low:  # the first may be cut
            return ["", "", *found][-2:]
    return ["", "", *found][-2:]


def word(token: str) -> str:
    """A neighbour as a feature: a name of a secret, one sign, or its classes."""
    if not token:
        return "-"
    if len(token) == 1 and not token.isalnum():
        return token
    if token.lower().rstrip("s") in NAME_TOKENS or token.lower() in NAME_TOKENS:
        return "NAME"
    return classes(token)


def file_features(text: str) -> list[str]:
    n = len(text) + 1
    return [f"lines{min(9, text.count(chr(10)) * 400 // n)}", f"signs{min(9, (text.count('=') + text.count('{') + text.count(';')) * 500 // n)}", f"long{n.bit_length() // 3}"]


def form(run: str) -> list[str]:
    """What a run is like whatever its characters: how mixed, how even, how wordy."""
    size = len(run)
    digits = sum(c.isdigit() for c in run)
    bits = min(8, int(2 * entropy(run)))
    mix = min(4, len(re.findall(r"[0-9](?=[A-Za-z])|[A-Za-z](?=[0-9])|[a-z](?=[A-Z])|[A-Z](?=[a-z])", run)) * 10 // size)
    wordy = min(5, max(map(len, re.findall("[A-Z]?[a-z]+|[A-Z]+", run)), default=0) // 2)
    share, long = 5 * digits // size, (size >= 12) + (size >= 16) + (size >= 24)
    return [f"mix:{mix}", f"bits:{bits}", f"digits:{share}", f"wordy:{wordy}", f"mb:{mix}:{bits}", f"md:{mix}:{share}", f"mw:{mix}:{wordy}", f"long:{long}:{mix > 1}", f"lw:{long}:{wordy}:{bits > 6}", f"lb:{long}:{bits}"]


def features(text: str, chunk: Span, file: list[str], hide: bool = False) -> tuple[list[Span], list[list[int]]]:
    """Places and hashed features of a chunk's tokens. hide leaves out what the base patterns go by."""
    spans = [m.span() for m in TOKEN.finditer(text, *chunk)]
    words = [*tokens_before(text, chunk[0]), *(text[a:b] for a, b in spans), *[m[0] for m in islice(TOKEN.finditer(text, chunk[1]), 2)], "", ""]
    near = [word(w) for w in words[: len(spans) + 4]]
    runs = {m.start(): m for m in RUN.finditer(text, *chunk)}
    out, of_run, until = [], ["no run"], 0
    for k, (a, b) in enumerate(spans):
        token = text[a:b]
        if a in runs:
            run, until = runs[a][0], runs[a].end()
            of_run = form(run)
            if not hide:
                size = min(len(run), 64)
                of_run += [f"rc:{classes(run)}", f"rl:{size // 4}", f"rcl:{classes(run)}:{size // 8}", f"hex:{size >= 24 and set(run) <= set('0123456789abcdef')}", f"h:{run[:4] if run[:4].isupper() else ''}"]
        elif a >= until:
            of_run = ["no run"]
        kind = "sign" if not token.isalnum() else "digits" if token.isdigit() else "letters" if token.isalpha() else "mixed"
        p2, p1, _, n1, n2 = near[k : k + 5]
        names = ["bias", f"k:{kind}", f"first:{a in runs}:{kind}", *of_run, *(f"{x}:{kind == 'sign'}:{a in runs}" for x in of_run[:4])]
        if not hide:
            names += [f"s:{shape(token)}", f"c:{classes(token)}", *(f"{f}:{kind}" for f in file)]
            names += [f"p1:{p1}", f"p2:{p2}", f"n1:{n1}", f"n2:{n2}", f"p:{p2}:{p1}", f"pk:{p2}:{p1}:{a in runs}"]
        out.append([zlib.crc32(x.encode()) % FEATURES for x in names])
    return spans, out


@dataclass
class Field:
    """Weights of a linear chain over the tags O, B and I."""

    unary: np.ndarray
    chain: np.ndarray  # from tag, to tag

    def potentials(self, rows: list[list[int]]) -> np.ndarray:
        return np.array([self.unary[r].sum(axis=0) for r in rows])

    def viterbi(self, rows: list[list[int]]) -> list[int]:
        """The best tags of a chunk; it is preceded and followed by O."""
        p = self.potentials(rows)
        best, back = p[0] + self.chain[O], []
        for x in p[1:]:
            through = best[:, None] + self.chain
            back.append(through.argmax(axis=0))
            best = through.max(axis=0) + x
        tags = [int((best + self.chain[:, O]).argmax())]
        for step in reversed(back):
            tags.append(int(step[tags[-1]]))
        return tags[::-1]

    def margin(self, rows: list[list[int]], tags: list[int]) -> float:
        """By how much the tags' own potentials exceed those of O, on average."""
        return float(np.mean([self.unary[r][:, t].sum() - self.unary[r][:, O].sum() for r, t in zip(rows, tags)]))


def log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def marginals(p: np.ndarray, chain: np.ndarray, real: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Expected tags of each token, and expected pairs of tags in all, of a batch of padded chunks."""
    longest = p.shape[1]
    alpha, beta = np.zeros_like(p), np.zeros_like(p)
    alpha[:, 0] = p[:, 0] + chain[O]
    for t in range(1, longest):
        alpha[:, t] = p[:, t] + log_sum(alpha[:, t - 1, :, None] + chain, 1)
    beta[:, -1] = chain[:, O]
    for t in range(longest - 2, -1, -1):
        beta[:, t] = log_sum(chain + (p[:, t + 1] + beta[:, t + 1])[:, None, :], 2)
    whole = log_sum(alpha[:, -1] + chain[:, O], 1)
    single, pairs = np.exp(alpha + beta - whole[:, None, None]) * real[..., None], np.zeros((3, 3))
    for t in range(1, longest):
        pair = alpha[:, t - 1, :, None] + chain + (p[:, t] + beta[:, t])[:, None, :] - whole[:, None, None]
        pairs += np.exp(pair[real[:, t]]).sum(axis=0)
    return single, pairs


def fit(examples: list[tuple[list[list[int]], list[int]]], epochs: int = EPOCHS, rate: float = 0.3, ridge: float = 1e-4) -> Field:
    """Maximum conditional likelihood by AdaGrad over batches of padded chunks.

    examples: each token's features, and its tag or -1 where it has none; of a chunk without all its tags all
    taggings that have the rest count. Forward and backward sums run over a batch at once.
    """
    field = Field(np.zeros((FEATURES, 3)), np.zeros((3, 3)))
    field.chain[O, I] = -1e9  # a secret begins with B
    seen_u, seen_c = np.full((FEATURES, 3), 1e-6), np.full((3, 3), 1e-6)
    examples = sorted(examples, key=lambda e: len(e[0]))
    batches = [examples[k : k + 64] for k in range(0, len(examples), 64)]
    for epoch in range(epochs):
        for batch in batches[epoch % 2 :: 2] or batches:
            n, longest, width = len(batch), len(batch[-1][0]), max(len(r) for e in batch for r in e[0])
            rows = np.full((n, longest, width), FEATURES, np.int64)  # padded with a feature of weight 0
            real, gold = np.zeros((n, longest), bool), np.zeros((n, longest), np.int64)
            for k, (r, tags) in enumerate(batch):
                for t, x in enumerate(r):
                    rows[k, t, : len(x)] = x
                real[k, : len(r)], gold[k, : len(r)] = True, tags
            weights = np.vstack([field.unary, np.zeros((1, 3))])
            p = weights[rows].sum(axis=2)
            p[~real] = (0, -1e9, -1e9)  # past its end a chunk stays outside
            allowed = np.where((gold[..., None] == np.arange(3)) | (gold[..., None] < 0), p, -1e9)
            single, pairs = marginals(p, field.chain, real)
            single_gold, pairs_gold = marginals(allowed, field.chain, real)
            grad = np.zeros_like(weights)
            np.add.at(grad, rows[real], (single_gold - single)[real][:, None, :])
            grad = grad[:-1] / n - ridge * field.unary
            grad_c = (pairs_gold - pairs) / n
            seen_u += grad**2
            seen_c += grad_c**2
            field.unary += rate * grad / np.sqrt(seen_u)
            field.chain += rate * grad_c / np.sqrt(seen_c)
            field.chain[O, I] = -1e9
    return field


def looks_like_a_key(run: str) -> bool:
    return len(run) >= KEY_LENGTH and bool(re.search("[0-9]", run) and re.search("[A-Za-z]", run)) and entropy(run) >= KEY_ENTROPY


class Overlaps:
    """Whether spans asked in order of start overlap one of a sorted list."""

    def __init__(self, spans: list[Span]):
        self.spans, self.at, self.reach = spans, 0, -1

    def any(self, a: int, b: int) -> bool:
        while self.at < len(self.spans) and self.spans[self.at][0] < b:
            self.reach = max(self.reach, self.spans[self.at][1])
            self.at += 1
        return self.reach > a


def window(tags: list[int], number: int) -> int:
    """Where TRAIN_TOKENS of a chunk's tokens begin: by number, but not inside a secret."""
    at = number % (max(0, len(tags) - TRAIN_TOKENS) + 1)
    while tags[at] == I:
        at -= 1
    return at


def tagged(text: str, most: int | None = None) -> Iterator[tuple[list[list[int]], list[int]]]:
    """Training examples of a text, each with and without what the base patterns go by; of at most so many chunks, by hash."""
    values = secret_values(text, base_spans(text))
    file = file_features(text)
    chunks = free_chunks(text)
    if most is not None and len(chunks) > most:
        chunks = sorted(sorted(chunks, key=lambda c: (zlib.crc32(text[slice(*c)].encode()), c))[:most])
    at = 0
    for chunk in chunks:
        while at < len(values) and values[at][1] <= chunk[0]:
            at += 1
        inside = []
        for k in range(at, len(values)):
            if values[k][0] >= chunk[1]:
                break
            inside.append(values[k])
        keys = [m.span() for m in RUN.finditer(text, *chunk) if looks_like_a_key(m[0])]
        for hide in (False, True):
            spans, rows = features(text, chunk, file, hide)
            tags, before, k, j = [], None, 0, 0
            for a, b in spans:
                while k < len(inside) and inside[k][1] <= a:
                    k += 1
                while j < len(keys) and keys[j][1] <= a:
                    j += 1
                of = inside[k] if k < len(inside) and inside[k][0] < b else None
                unknown = of is None and j < len(keys) and keys[j][0] < b
                tags.append(-1 if unknown else O if of is None else I if of == before else B)
                before = of
            at_token = window(tags, zlib.crc32(text[slice(*chunk)].encode()))
            yield rows[at_token : at_token + TRAIN_TOKENS], tags[at_token : at_token + TRAIN_TOKENS]


def example_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        out = [(rows, tags) for text in batch["text"] for rows, tags in tagged(text, TRAIN_CHUNKS)]
        yield pd.DataFrame(out, columns=["rows", "tags"])


def learn(docs: DataFrame, train_docs: int = TRAIN_DOCS) -> Field | None:
    """Fits the field on a sample of about train_docs documents with digits, none held out; half of them, where there are enough, match a base pattern."""
    rows = texts(docs).where(F.col("text").rlike("[0-9]{3}") & ~F.coalesce(held_out(F.col("doc_id")), F.lit(False)))
    strong = F.col("text").rlike(r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]|[0-9a-f]{24}") | F.col("text").rlike("AKIA[A-Z0-9]{16}")
    rows = rows.select("text", strong.alias("strong"), fraction(F.col("doc_id"), 4).alias("u"))
    sizes = {r["strong"]: r["count"] for r in rows.groupBy("strong").count().collect()}
    if not sizes.get(True):
        return None
    rate = F.when(F.col("strong"), train_docs / 2 / sizes[True]).otherwise(train_docs / 2 / max(1, sizes.get(False, 0)))
    found = rows.where(F.col("u") < rate).select("text").mapInPandas(example_batches, "rows array<array<int>>, tags array<int>").collect()
    examples = [([list(r) for r in x["rows"]], list(x["tags"])) for x in found]
    return fit(sorted(examples, key=repr)) if examples else None


def field_spans(text: str, field: Field, base: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Secrets by the field that do not overlap a base span."""
    out = []
    file, taken = None, Overlaps([x[:2] for x in base])
    for chunk in free_chunks(text):
        file = file or file_features(text)
        spans, rows = features(text, chunk, file)
        tags = field.viterbi(rows)
        k = 0
        while k < len(tags):
            if tags[k] == B:
                end = k + 1
                while end < len(tags) and tags[end] == I:
                    end += 1
                a, b = spans[k][0], spans[end - 1][1]
                if b - a >= LEAST_LENGTH and field.margin(rows[k:end], tags[k:end]) >= LEAST_MARGIN and not taken.any(a, b):
                    out.append((a, b, "crf"))
                k = end
            else:
                k += 1
    return out


def redacted(text: str | None, field: Field | None, mark: str) -> str | None:
    """The text with every secret value replaced by mark."""
    if not text:
        return text
    base = base_spans(text)
    values = secret_values(text, base) + [x[:2] for x in (field_spans(text, field, base) if field else [])]
    out, at = [], 0
    for a, b in sorted(values):
        if a >= at:
            out += [text[at:a], mark]
        at = max(at, b)
    return "".join(out) + text[at:] if out else text


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in sorted(spans, key=lambda x: (x[0], KINDS.index(x[2]), x[1])))


def scanner(field: Field | None):
    def scan_text(text: str | None) -> tuple[int, int, int, str, str, int]:
        base = base_spans(text) if text else []
        more = field_spans(text, field, base) if field and text else []
        n = Counter(x[2] for x in base)
        return n["assign"], n["access"], n["hex"], hashlib.sha256(joined(base).encode()).hexdigest(), joined(base + more), len(more)

    return scan_text


def scan(docs: DataFrame, field: Field | None) -> DataFrame:
    """Counts and spans for every row of docs."""
    return per_text(texts(docs), each(lambda: scanner(field)), SCHEMA)


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return scan(docs, learn(docs))
