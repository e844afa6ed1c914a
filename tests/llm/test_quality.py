import base64
import random
import re
import string

from hypothesis import given, settings
from hypothesis import strategies as st

from siltlake.llm import quality
from siltlake.llm.common import shape
from siltlake.llm.quality import WORD


def plain(text):
    """Base results straight from their definitions."""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, marked = {}, set()
    for i in range(len(words) - 4):
        seen.setdefault(tuple(words[i : i + 5]), []).append(i)
    for places in seen.values():
        if len(places) > 1:
            marked |= {i + k for i in places for k in range(5)}
    lines, dup = [], 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in lines
            lines.append(line)
    failed = len(words) < 10 or 100 * len(marked) > 20 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(marked), failed


def scored(texts):
    import pandas as pd

    of = quality.scorer()
    return pd.DataFrame([of(t) for t in texts], columns=shape(quality.SCHEMA).names)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["a", "b", "#x", "é", "\n", "\xa0", "<|>", "\x0b", "long\x85er"]), max_size=40).map(" ".join), min_size=1, max_size=6))
def test_base_is_its_definition(texts):
    out = scored(texts)
    for text, (_, r) in zip(texts, out.iterrows()):
        assert tuple(r[["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]]) == plain(text)
        assert not (r["base_failed"] and r["kept"])


def test_verdicts():
    words = "the quick brown fox jumped over a lazy dog near river bank while seven people watched it from their old house".split()
    clean = " ".join(random.Random(1).choices(words, k=150))
    noise = " ".join(chr(0xE000 + i % 900) + chr(0xF000 + i % 300) for i in range(200))
    out = scored([clean, noise])
    assert out["reason"].tolist() == ["", "chars_per_token"] and out["byte_share"][1] > 0.5 and out["kept"].tolist() == [True, False]


def test_measures_match_the_tokenizers():
    tokens = quality.Tokens()
    text = "Tokenizers split rare words like zxqv into pieces \U0001f9ff"
    r = scored([text]).iloc[0]
    ids = [i for w in text.split() for i in tokens.pieces.encode(w)]
    assert r["chars_per_token"] == sum(map(len, text.split())) / len(ids)
    assert r["byte_share"] == sum(3 <= i < 259 for i in ids) / len(ids)


def test_script():
    assert quality.script("Привет мир and") == "CYRILLIC" and quality.script("123 !") == "none" and quality.script("été") == quality.script("abc") == "LATIN"


def test_edge_rows(spark):
    rows = [(1, None, True), (2, "", True), (3, " \n\t", True), (4, "word " * 100_000, True), (5, "x", True), (5, "x", True), (None, "y", True)]
    out = {r["doc_id"]: r for r in quality.quality(spark.createDataFrame(rows, "doc_id long, text string, kept boolean")).collect()}
    assert all(out[k]["base_failed"] and not out[k]["kept"] and out[k]["n_words"] == 0 for k in (1, 2, 3))
    assert (out[4]["n_words"], out[4]["n_repeat_words"], out[4]["base_failed"]) == (100_000, 100_000, True)
    assert quality.quality(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def junk(rng, n):
    """Texts of n runs each of base64, hex, printable ASCII and letters, all by chance."""
    runs = {
        "base64": lambda: base64.b64encode(rng.randbytes(rng.randint(12, 40))).decode(),
        "hex": lambda: rng.randbytes(rng.randint(4, 20)).hex(),
        "ascii": lambda: "".join(chr(rng.randint(33, 126)) for _ in range(rng.randint(5, 30))),
        "letters": lambda: "".join(rng.choices(string.ascii_lowercase, k=rng.randint(3, 12))),
    }
    return {f"{k} {n}": " ".join(f() for _ in range(n)) for k, f in runs.items()}


PROSE = {
    "LATIN": "the quick brown fox jumped over a lazy dog near the river bank while seven people watched it from their old house and talked about weather",
    "CYRILLIC": "быстрая лиса прыгнула через ленивую собаку у берега реки пока семь человек смотрели на неё из старого дома и говорили о погоде",
    "GREEK": "η γρήγορη αλεπού πήδηξε πάνω από το τεμπέλικο σκυλί κοντά στην όχθη του ποταμού ενώ επτά άνθρωποι κοίταζαν από το παλιό σπίτι",
    "CJK": "敏捷的 狐狸 跳过 懒狗 在 河岸 附近 七个 人 从 老房子 里 看着 它 并且 谈论 天气 今天 很好 我们 明天 再去",
    "HANGUL": "빠른 갈색 여우가 강둑 근처에서 게으른 개를 뛰어넘었고 일곱 사람이 오래된 집에서 그것을 보며 날씨에 대해 이야기했다",
}


def test_bands_reject_encoded_data_and_keep_prose(spark):
    rng = random.Random(4)
    rows = [f"prose {name}" for name in PROSE for _ in range(400)]  # so that junk is within the tail share
    rows = [(kind, " ".join(rng.choices(PROSE[kind[6:]].split(), k=rng.choice([15, 60, 200])))) for kind in rows]
    bad = {k: t for n in (12, 60, 400) for k, t in junk(rng, n).items() if k != "letters 12"}
    rows += list(bad.items())
    docs = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(rows)], "doc_id long, text string")
    out = {r["doc_id"]: r for r in quality.quality(docs).collect()}
    kept = {kind: [] for kind, _ in rows}
    for i, (kind, _) in enumerate(rows):
        if not out[i]["base_failed"]:
            kept[kind].append(out[i]["kept"])
    assert not any(any(v) for k, v in kept.items() if k in bad and not k.startswith("letters"))
    assert not kept["letters 400"][0] and not kept["letters 60"][0]
    assert all(sum(v) >= 0.99 * len(v) and len(v) > 20 for k, v in kept.items() if k.startswith("prose"))


def test_bands_move_gradually_with_the_number_of_texts(spark):
    """A script at 1, 24, 99 and 100 texts of the same kinds: its edges go from the fixed ones to its own, without a jump."""
    rng = random.Random(8)
    texts = [" ".join(rng.choices(PROSE["LATIN"].split(), k=60)) for _ in range(100)]
    measured = quality.per_text(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), quality.each(lambda: quality.scorer(None)), quality.SCHEMA).where("NOT base_failed").cache()
    edges = {n: quality.bands_of(measured.where(f"doc_id < {n}")).first() for n in (2, 24, 99, 100)}
    low, (fixed, _) = [edges[n]["low_chars_per_token"] for n in (2, 24, 99, 100)], quality.BANDS["LATIN"][0]
    assert fixed < low[0] < low[1] < low[2] and abs(low[3] - low[2]) < 0.02
    assert all(e["high_chars_per_token"] < 9.0 and e["low_token_entropy"] > 0.3 for e in edges.values())


def test_small_tables_reject_encoded_data_too():
    bad = {k: t for n in (12, 60) for k, t in junk(random.Random(5), n).items() if "letters" not in k}
    assert not scored(list(bad.values()))["kept"].any()
