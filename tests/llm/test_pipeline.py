import random

import numpy as np
import public_tokenizers
import pytest
from helpers import rows_of
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as p
from tidemark.llm import near_dedup, toxicity

DOCS = "doc_id long, text string, lang string, source string, n_chars long, __bucket string, places string, score string"
TOXIC_WORDS = ["vile", "scumbag", "wretched"]


def corpus(seed=8):
    rng, rows, labels = random.Random(seed), [], []
    vocabulary = [f"plain{i}" for i in range(3000)]
    for i in range(300):
        words = rng.choices(vocabulary, k=rng.randint(20, 90))
        toxic = i % 6 == 0
        for _ in range(5 if toxic else 0):
            words.insert(rng.randrange(len(words)), rng.choice(TOXIC_WORDS))
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    clean = [r for r in rows if r[0] % 6]
    rows += [(1000, clean[3][1]), (1001, clean[3][1]), (1002, clean[9][1] + " plain5"), (1003, clean[20][1] + " " + ITEM), (1004, None), (1005, ""),
             (1006, "mail jo.do@mail1.example.com and 4539578763621486"), (None, "a row without an id has words of its own to keep here")]
    return rows, labels


ITEM = "Which town lies by the wide green river under the hills? The answer is old Ruhm by the bridge."


def write(spark, path, rows, labels, items):
    docs = spark.createDataFrame([(k, t, "en", "s", len(t or ""), "b", "p", "x") for k, t in rows], DOCS)
    docs.repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return docs


def test_stages_decide_and_keep_columns(spark, tmp_path):
    rows, labels = corpus()
    path = str(tmp_path / "sf")
    docs = write(spark, path, rows, labels, [(1, ITEM)])
    seen, kept = spark.read.parquet(f"{path}/documents.parquet"), {}
    for name, stage in p.STAGES:
        out = stage(spark, seen, path)
        if name != "packing":
            assert out.columns == docs.columns, name
        out.write.parquet(str(tmp_path / name))
        seen = spark.read.parquet(str(tmp_path / name))
        kept[name] = {r["doc_id"] for r in seen.select("doc_id").collect()}
    clean = {k for k, _ in rows if k is None or k >= 1000 or k % 6}
    assert kept["toxicity"] == clean
    # 1000 and 1001 equal an earlier text, 1002 nearly does, 1005 equals 1004
    assert kept["near_duplicates"] == clean - {1000, 1001, 1002, 1005}
    assert kept["decontamination"] == kept["near_duplicates"] - {1003}
    texts = {r["doc_id"]: (r["text"], r["n_chars"]) for r in spark.read.parquet(str(tmp_path / "pseudonyms")).collect()}
    assert "4539578763621486" not in texts[1006][0] and "jo.do@" not in texts[1006][0] and len(texts[1006][0]) == texts[1006][1]
    assert all(texts[k][0] == t for k, t in rows if k in texts and k != 1006)
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces = rows_of(seen)
    for k, (text, _) in texts.items():
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 1])
        own = sorted((r["start"], r["length"]) for r in pieces if r["doc_id"] == k)
        assert [s for s, _ in own] == [sum(n for _, n in own[:i]) for i in range(len(own))] and sum(n for _, n in own) == len(ids)
    again = p.run(spark, path)
    assert sorted(map(tuple, again.drop("sequence_id", "offset").collect()), key=str) == sorted(map(tuple, seen.drop("sequence_id", "offset").collect()), key=str)


@pytest.mark.parametrize("empty", ["documents", "labels", "benchmark"])
def test_empty_tables(spark, tmp_path, empty):
    rows, labels = corpus()
    rows, labels = rows[:40], labels[:40]
    write(spark, str(tmp_path), [] if empty == "documents" else rows, [] if empty == "labels" else labels, [] if empty == "benchmark" else [(1, ITEM)])
    got = p.run(spark, str(tmp_path))
    assert (got.count() == 0) == (empty == "documents")


def test_stage_decisions_match_the_operators(spark):
    rows, labels = corpus(3)
    docs = spark.createDataFrame([(k, t, "en", "s", len(t or ""), "b", "p", "x") for k, t in rows if k is not None], DOCS)
    model = toxicity.train(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    by_passages = {r["doc_id"] for r in toxicity.toxic_passages(docs, model).where("score >= 0.5").collect()}
    by_column = {r["doc_id"] for r in docs.where(toxicity.score_column(model) >= 0.5).collect()}
    assert by_passages == by_column
    groups = near_dedup.near_duplicates(docs).groupBy("component_id").agg(F.count("*").alias("n")).where("n > 1").collect()
    assert {r["component_id"] for r in groups} >= {4, 1004}
