"""The pipeline's stages on a small corpus: each decision takes effect, clean documents stay."""

import random

from pyspark.sql import functions as F

import corpus_pipeline as P
from squall.llm import decontam, minhash


def corpus(spark, documents):
    g = random.Random(2)
    parts = {"en": ["the", "ing", "tion", "and", "er", "wh"], "es": ["ción", "os", "que", "ña", "do", "ar"]}
    item = " ".join("benchmark question words of item number one appear here in full".split() * 2)
    rows = []
    for i in range(60):
        lang = "en" if i % 2 else "es"
        rows.append((i, " ".join("".join(g.choice(parts[lang]) for _ in range(g.randint(1, 3))) for _ in range(g.randint(30, 120))), lang, f"s{i % 3}"))
    own = " ".join("".join(g.choice(parts["en"]) for _ in range(3)) for _ in range(50))
    rows += [(100, rows[3][1], "en", "s0"), (101, rows[3][1] + " more", "en", "s1"), (102, "12345 678 ...", "en", "s1"), (103, None, None, None),
             (104, own + " " + item, "en", "s2"), (105, "дом и сад " * 20, None, "s2")]
    return documents(rows), spark.createDataFrame([(1, item)], "item_id long, text string")


def test_stages(spark, documents, tmp_path):
    docs, bench = corpus(spark, documents)
    bench.write.parquet(f"{tmp_path}/benchmark.parquet")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    stages = dict(P.STAGES)
    assert list(stages) == ["language ID", "near-dedup", "decontamination", "mixing", "sharding"]
    kept = stages["language ID"](spark, docs, str(tmp_path))
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in docs.collect()} - {r["doc_id"] for r in kept.collect()} == {102, 103, 105}
    one = stages["near-dedup"](spark, kept, str(tmp_path))
    assert {r["doc_id"] for r in kept.collect()} - {r["doc_id"] for r in one.collect()} == {100, 101}
    clean = stages["decontamination"](spark, one, str(tmp_path))
    assert clean.columns == docs.columns and {r["doc_id"] for r in one.collect()} - {r["doc_id"] for r in clean.collect()} == {104}
    mixed = stages["mixing"](spark, clean, str(tmp_path))
    assert mixed.columns == docs.columns
    whole = {r["doc_id"]: r["text"] for r in clean.collect()}
    assert all(r["text"] in whole[r["doc_id"]] for r in mixed.collect())
    words, source = mixed.count(), sum(len(t.split()) for t in whole.values())
    assert words and abs(sum(len(r["text"].split()) for r in mixed.collect()) - 1.5 * source) < 0.2 * source
    out = P.run(spark, str(tmp_path))
    assert sorted(out.columns) == sorted([*docs.columns, "shard", "slot"])
    sizes = [r["count"] for r in out.groupBy("shard").count().collect()]
    assert sum(sizes) == words and max(sizes) - min(sizes) <= 1
    assert decontam.contaminated(clean, bench).count() == 0 and minhash.near_duplicates(one).where("not kept").count() == 0


def test_empty_documents(spark, documents, tmp_path):
    docs, bench = corpus(spark, documents)
    bench.write.parquet(f"{tmp_path}/benchmark.parquet")
    docs.where("false").write.parquet(f"{tmp_path}/documents.parquet")
    assert P.run(spark, str(tmp_path)).count() == 0


def test_rows_are_told_apart_without_their_ids(spark, documents, tmp_path):
    docs, bench = corpus(spark, documents)
    bench.write.parquet(f"{tmp_path}/benchmark.parquet")
    item, clean = bench.first()["text"], [r["text"] for r in docs.where("doc_id in (3, 5, 7)").orderBy("doc_id").collect()]
    extra = documents([(None, clean[0] + " " + item, "en", "s0"), (9, clean[1] + " " + item, "en", "s1"), (9, clean[2], "en", "s1"), (None, clean[1], "en", "s2"), (None, clean[1], "en", "s2")])
    clash = {c: F.lit(c) for c in ("mark", "row", "__doc", "doc", "guess", "rank")}
    rows = extra.withColumns(clash)
    stages = dict(P.STAGES)
    texts = lambda df: sorted((str(r["doc_id"]), r["text"]) for r in df.collect())
    cleaned = stages["decontamination"](spark, rows, str(tmp_path))
    assert texts(cleaned) == sorted([("9", clean[2]), ("None", clean[1]), ("None", clean[1])]) and cleaned.columns == rows.columns
    one = stages["near-dedup"](spark, rows.where(f"not contains(text, '{item}')"), str(tmp_path))
    assert texts(one) == sorted([("9", clean[2]), ("None", clean[1])]) and one.columns == rows.columns
    labelled = docs.withColumns(clash)
    for name in ("language ID", "mixing", "sharding"):
        out = stages[name](spark, labelled, str(tmp_path))
        assert out.columns[:len(rows.columns)] == rows.columns and {r["__doc"] for r in out.collect()} == {"__doc"}
