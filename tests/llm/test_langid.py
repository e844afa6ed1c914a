import random
import zlib
from collections import Counter

import numpy as np

from siltlake.llm import langid

SYLLABLES = {"aa": ["ka", "lu", "mi", "ro", "té"], "bb": ["sch", "ung", "er", "keit", "ö"], "cc": ["tion", "ing", "the", "ed", "ble"]}


def corpus(n=300, seed=1):
    rng = random.Random(seed)
    rows = []
    for d in range(n):
        lang = rng.choice(list(SYLLABLES))
        words = ["".join(rng.choices(SYLLABLES[lang], k=rng.randint(1, 3))) for _ in range(rng.randint(1, 60))]
        rows.append((d, " ".join(words).capitalize() + ".", lang, "s"))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")


def test_held_out_accuracy(spark):
    rows = corpus()
    docs = frame(spark, rows)
    out = {r["doc_id"]: r for r in langid.identify(docs, langid.learn(docs)).collect()}
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 4 == 2]
    assert sum(out[d]["lang_pred"] == lang for d, _, lang, _ in held) / len(held) > 0.97
    assert not any(out[d]["rejected"] for d, *_ in rows) and all(0 <= r["score"] <= 1 for r in out.values())


def test_nothing_of_held_out_rows_is_learned(spark):
    rows = corpus()
    other = [(d, "zzzz qqqq", "xx", s) if zlib.crc32(str(d).encode()) % 4 == 2 else (d, t, lang, s) for d, t, lang, s in rows]
    one, two = langid.learn(frame(spark, rows)), langid.learn(frame(spark, other))
    assert one.langs == two.langs and np.array_equal(one.hashes, two.hashes) and np.allclose(one.logp, two.logp)


def counts_of(words):
    n = {}
    for w in words:
        w = langid.START + w + langid.END
        for size in range(1, langid.ORDER + 1):
            for i in range(len(w) - size + 1):
                n[w[i : i + size]] = n.get(w[i : i + size], 0) + 1
    return n


def fitted(words, n_characters):
    n = counts_of(words)
    return langid.fit_language(list(n), list(n.values()), langid.ORDER, -np.log(1 + n_characters))


def by_definition(words, n_characters):
    """p(context, character) of interpolated Kneser-Ney, from dictionaries."""
    raw, order = counts_of(words), langid.ORDER
    left = Counter(g[1:] for g in raw if len(g) > 1)
    used = {g: n if len(g) == order or g[0] == langid.START else left.get(g, n) for g, n in raw.items() if g != langid.START}
    seen = {}
    for g, n in used.items():
        seen.setdefault(g[:-1], []).append(n)

    def discount(size):
        once, twice = (sum(n == k and len(g) == size for g, n in used.items()) for k in (1, 2))
        return min(0.95, max(0.1, once / (once + 2 * twice) if once + twice else 0.5))

    def p(context, c):
        lower = p(context[1:], c) if context else 1 / (1 + n_characters)
        if context not in seen:
            return lower
        d = discount(len(context) + 1)
        return (max(used.get(context + c, 0) - d, 0) + d * len(seen[context]) * lower) / sum(seen[context])

    return p


def test_against_the_definition():
    one, two = ["banana", "band", "ban", "nab", "an", "anna"], ["zebra", "zoo", "bone"]
    letters = sorted({c for w in one + two for c in w} | {langid.END})
    n_characters = len(letters) + 1
    model = langid.Model({"x": fitted(one, n_characters), "y": fitted(two, n_characters)})
    for j, words in enumerate((one, two)):
        p = by_definition(words, n_characters)
        for context in ("", "a", "an", "ban", langid.START, langid.START + "ba", "q"):
            assert abs(sum(p(context, c) for c in letters) - 1) < 0.2  # what is left goes to characters never seen
        for word in ("banana", "zoo", "nope", "ann", "é", "bananazebra"):
            framed = langid.START + word + langid.END
            expected = sum(np.log(p(framed[max(0, i - langid.ORDER + 1) : i], framed[i])) for i in range(1, len(framed)))
            got = model.spell([word, "other"])[0]
            assert abs(got[j] - expected) < 1e-3 and got[-1] == len(word) + 1


def test_rejection_of_what_no_model_knows(spark):
    docs = frame(spark, corpus())
    model = langid.learn(docs)
    of = langid.scorer(model)
    assert [r[3] for r in of(["xqzj " * 50 + "wvxk " * 50, None, "kalumi rotéka", "12"])] == [True, True, False, True]


def test_rejection_of_planted_junk(spark):
    """Languages no model knows, keys, shuffled letters: rejected. Held-out documents: kept."""
    rows = corpus(600)
    of, rng = langid.scorer(langid.learn(frame(spark, rows))), random.Random(5)
    held = [t for d, t, *_ in rows if zlib.crc32(str(d).encode()) % 4 == 2]
    assert sum(r[3] for r in of(held)) <= 0.01 * len(held)
    assert [of([t])[0] for t in held[:50]] == of(held[:50])
    alphabets = ["bcdfghjklmnpqrstvwxz", "абвгдежзиклмнопрст", "αβγδεζηθικλμνξοπρ", "กขคงจฉชซญฎฏฐฑ"]
    junk = [" ".join("".join(rng.choices(a, k=rng.randint(3, 9))) for _ in range(rng.randint(10, 60))) for a in alphabets for _ in range(50)]
    assert sum(r[3] for r in of(junk)) >= 0.95 * len(junk)


def test_edge_rows(spark):
    docs = frame(spark, corpus())
    model = langid.learn(docs)
    odd = spark.createDataFrame([(1, None, "aa"), (2, "", None), (3, "12 345 ½²", None), (4, "kalu " * 50_000, None), (5, "the", None), (5, "the", None), (None, "kalu", None)], "doc_id long, text string, lang_pred string")
    out = {r["doc_id"]: r for r in langid.identify(odd, model).collect()}
    assert all((out[k]["lang_pred"], out[k]["score"], out[k]["rejected"]) == ("und", 0.0, True) for k in (1, 2, 3))
    assert out[4]["lang_pred"] == out[None]["lang_pred"] == "aa"
    assert langid.identify(odd.limit(0), model).count() == 0
    none = frame(spark, [(1, "text", None, "s"), (2, None, "aa", "s")])
    assert langid.learn(none) is None
    assert {r["lang_pred"] for r in langid.identify(none, None).collect()} == {"und"}
    big = spark.createDataFrame([(9007199254740993, "kalu"), (None, "kalu")], "doc_id long, text string")
    assert {r["doc_id"] for r in langid.identify(big, model).collect()} == {9007199254740993, None}
