import random

import corpus_pipeline
from siltlake.llm import decontaminate

SHAPE = "doc_id long, text string, lang string, source string, n_chars long"


def corpus():
    rng = random.Random(3)
    vocabulary = ["".join(rng.choices(["ka", "lu", "mi", "ro", "te"], k=rng.randint(1, 4))) for _ in range(600)]
    items = [" ".join(rng.choices(vocabulary, k=30)) for _ in range(5)]
    texts = {d: " ".join(rng.choices(vocabulary, k=80)) for d in range(100)}
    copies = {200 + d: texts[d] + " end" for d in range(10)}
    leaks = {300 + d: texts[20 + d].replace("a", "u") + " " + items[d] for d in range(5)}
    secret = {400: texts[30].replace("i", "o") + ' token = "0123456789abcdef0123456789abcdef"'}
    texts |= copies | leaks | secret | {500: "123 456", 501: ""}
    rows = [(d, t, "xx", "s", len(t)) for d, t in texts.items()] + [(502, None, None, None, None)]
    return rows, [(i, t) for i, t in enumerate(items)]


def test_stages(spark, tmp_path):
    rows, items = corpus()
    where = str(tmp_path)
    spark.createDataFrame(rows, SHAPE).write.parquet(f"{where}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{where}/benchmark.parquet")
    docs = spark.read.parquet(f"{where}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, where)
        assert out.columns == docs.columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
        out.write.parquet(f"{where}/{name}")
        docs = spark.read.parquet(f"{where}/{name}")
        seen[name] = {r["doc_id"]: r for r in docs.collect()}
    everything = {r[0] for r in rows}
    assert set(seen["language_id"]) == everything - {500, 501, 502}
    assert set(seen["near_duplicates"]) == set(seen["language_id"]) - {200 + d for d in range(10)}
    assert set(seen["decontamination"]) == set(seen["near_duplicates"]) - {300 + d for d in range(5)}
    assert set(seen["secrets"]) == set(seen["decontamination"])
    clean = seen["secrets"][400]
    assert clean["text"].endswith(' token = "<SECRET>"') and clean["n_chars"] == len(clean["text"])
    assert all(seen["secrets"][d] == r for d, r in seen["decontamination"].items() if d != 400)
    packed = corpus_pipeline.run(spark, where).collect()
    assert {r["doc_id"] for r in packed} == set(seen["secrets"])
    assert sum(r["length"] for r in packed) <= 4096 * len({r["sequence_id"] for r in packed})


def test_repeated_and_clashing_rows(spark, tmp_path):
    rows, items = corpus()
    where = str(tmp_path)
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{where}/benchmark.parquet")
    docs = spark.createDataFrame([(*r, 1.5, None) for r in rows + rows[:3]], SHAPE + ", score double, class_id string")
    out = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = decontaminate.cut(stage(spark, out, where))
        assert out.columns == docs.columns
    ids = [r["doc_id"] for r in out.collect()]
    assert len(ids) == len(set(ids)) and {0, 1, 2} <= set(ids)


def test_nulls_ties_and_very_long_texts(spark, tmp_path):
    """Null doc_ids, equal texts under several ids, an empty benchmark and texts of 100 000 words."""
    rows, _ = corpus()
    where = str(tmp_path)
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{where}/benchmark.parquet")
    rng = random.Random(8)
    words = rows[0][1].split()
    long = " ".join(rng.choices(words, k=100_000))
    more = [(None, rows[1][1], "xx", "s", 1), (None, rows[2][1] + " other", None, None, None), (600, long, "xx", "s", 1), (601, long, "xx", "s", 1), (602, rows[3][1], "xx", "s", 1)]
    spark.createDataFrame([*rows, *more], SHAPE).write.parquet(f"{where}/documents.parquet")
    docs = spark.read.parquet(f"{where}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = decontaminate.cut(stage(spark, docs, where))
    ids = sorted((r["doc_id"] for r in docs.collect()), key=lambda d: (d is None, d))
    # With nothing to decontaminate, all classes but those of copies keep a row: the one of the least doc_id, a null one last.
    kept = {r[0] for r in rows} - {500, 501, 502} - {200 + d for d in range(10)}
    assert ids == sorted(kept | {600})
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, where).collect()
    assert {r["doc_id"] for r in packed} == kept | {600} and max(r["piece"] for r in packed if r["doc_id"] == 600) > 20


def test_empty_table(spark, tmp_path):
    rows, items = corpus()
    where = str(tmp_path)
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{where}/benchmark.parquet")
    spark.createDataFrame([], SHAPE).write.parquet(f"{where}/documents.parquet")
    assert corpus_pipeline.run(spark, where).count() == 0
