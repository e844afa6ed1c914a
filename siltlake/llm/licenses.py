"""Licence scans by ordered signature rules.

A text is lower-cased in A-Z and split into words; the rules of license_rules run over the words,
one space apart, and only those whose keyword is among the words. Detections are intervals of
words. They are settled by priority, then length, then the rules' order: a detection inside the
interval of one already kept is suppressed. The base phrases are counted apart and their labels
are never suppressed.

Defined results: null and empty texts have no words, no labels, null first_word and last_word and
score 0; ties between rules go to the earlier one; repeated rows get equal results; an empty table gives
no rows; columns besides doc_id and text are ignored. Texts of any length are scanned whole, in time that grows
with their words and detections.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from siltlake.llm.common import each, per_text, table, texts
from siltlake.llm.license_rules import RULES

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {a: a + 32 for a in range(ord("A"), ord("Z") + 1)}
#: Phrases and their labels.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
DETECTIONS = "array<struct<label:string,rule:int,priority:int,start:long,end:long>>"
SCHEMA = f"n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, detections {DETECTIONS}"
ARROW = {DETECTIONS: pa.list_(pa.struct([("label", pa.string()), ("rule", pa.int32()), ("priority", pa.int32()), ("start", pa.int64()), ("end", pa.int64())]))}


@dataclass(frozen=True)
class Rule:
    number: int
    label: str
    priority: int
    keyword: str
    pattern: re.Pattern


def rules(source: str = RULES) -> list[Rule]:
    out, label = [], ""
    for line in source.splitlines():
        if not line.strip() or line.lstrip().startswith("#"):
            continue
        if not line.startswith(" "):
            label = line.strip()
            continue
        priority, keyword, pattern = line.split(maxsplit=2)
        out.append(Rule(len(out), label, int(priority), keyword, re.compile(rf"(?<= ){pattern}(?= )")))
    return out


def settle(found: list[tuple[int, int, Rule]]) -> list[tuple[int, int, Rule]]:
    """What interval containment leaves of (start, end, rule), in order of start."""
    kept: list[tuple[int, int, Rule]] = []
    # The kept intervals that lie in no other, by start and thus by end: the last one that starts early enough reaches furthest.
    starts: list[int] = []
    ends: list[int] = []
    for start, end, rule in sorted(found, key=lambda x: (-x[2].priority, x[0] - x[1], x[0], x[2].number)):
        before = bisect_right(starts, start)
        if before and ends[before - 1] >= end:
            continue
        kept.append((start, end, rule))
        low, high = bisect_left(starts, start), bisect_right(ends, end)
        starts[low : max(low, high)], ends[low : max(low, high)] = [start], [end]
    return sorted(kept, key=lambda x: (x[0], x[1], x[2].number))


class Scanner:
    def __init__(self, all_rules: list[Rule] | None = None):
        self.by_keyword: dict[str, list[Rule]] = {}
        for rule in rules() if all_rules is None else all_rules:
            self.by_keyword.setdefault(rule.keyword, []).append(rule)
        self.keywords = frozenset(self.by_keyword)
        self.base = [(p.split()[0], re.compile(rf" (?={p} )"), label) for p, label in BASE.items()]
        self.base_words = frozenset(x[0] for x in self.base)

    def scan(self, text: str | None) -> tuple:
        words = WORD.findall((text or "").translate(LOWER)) if text and not text.isascii() else WORD.findall((text or "").lower())
        seen = self.keywords.intersection(words) | self.base_words.intersection(words)
        if not seen:
            return len(words), 0, None, None, "", "", 0.0, []
        line = f" {' '.join(words)} "
        spaces: list[int] = []

        def word_at(at: int) -> int:
            """The number of spaces before a place in line."""
            if not spaces:
                spaces.extend(m.start() for m in re.finditer(" ", line))
            return bisect_left(spaces, at)

        places, base = [], set()
        for first, phrase, label in self.base:
            if first in seen:
                for m in phrase.finditer(line):
                    places.append(word_at(m.start() + 1) - 1)
                    base.add(label)
        hits = []
        for keyword in sorted(seen & self.keywords):
            for rule in self.by_keyword[keyword]:
                for m in rule.pattern.finditer(line):
                    start = word_at(m.start()) - 1
                    hits.append((start, start + m.group().count(" ") + 1, rule))
        kept = settle(hits)
        labels = base | {x[2].label for x in kept}
        score = max([x[2].priority / 100 for x in kept] + [0.5] * bool(base), default=0.0)
        return (len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), score,
                [{"label": r.label, "rule": r.number, "priority": r.priority, "start": a, "end": b} for a, b, r in kept])


def scan(docs: DataFrame) -> DataFrame:
    """Counts, labels and detections for every row of docs."""
    return per_text(texts(docs), each(lambda: Scanner().scan), SCHEMA, ARROW)


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))
