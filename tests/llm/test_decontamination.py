import math
import random
import re
from collections import Counter

from helpers import TEXTS, awkward, nothing, rows_of

from tidemark.llm import decontamination as d


def brute(words, shard, share, stride):
    """item -> best share over all windows of two strides, every item scored against every window"""
    best = {}
    for at in range(0, max(1, len(words)), stride):
        inside = {shard.vocabulary[w] for w in words[at:at + 2 * stride] if w in shard.vocabulary}
        for j in range(len(shard.item)):
            score = float(shard.impact[sorted(inside), j].sum())
            if score >= share:
                best[j] = max(best.get(j, 0), score)
    return best


def test_pruning_loses_nothing():
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(60)] + ["the", "of"]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(1, 90)))) for i in range(40)]
    counts = {}
    for _, t in items:
        for w in set(t.split()):
            counts[w] = counts.get(w, 0) + 1
    shard = d.build_shard(items, counts, len(items), 30.0, 16, 4)
    matcher = d._Matcher(shard, 0.5, 0.8, 0.8, 5, 16)
    for _ in range(60):
        words = rng.choices(vocabulary + ["other"] * 40, k=rng.randint(0, 200))
        got = {k: round(v[0], 4) for k, v in matcher.retrieve(words).items()}
        assert got == {k: round(v, 4) for k, v in brute(words, shard, 0.5, 16).items()}


ITEMS = [(1, "Which river runs near the old town of Ruhm? The answer lies in the long green valley."),
         (2, "Name three colours of a flag seen over harbours in winter. Answer: red white and deep blue"),
         (3, None), (4, ""), (None, "ignored"), (5, " ".join(f"token{i}" for i in range(200)) + ".")]


def test_leaks_are_found_and_clean_texts_left(spark):
    pad = " ".join(f"filler{i}" for i in range(150))
    docs = awkward(spark, [*TEXTS, (20, f"{pad} {ITEMS[0][1]} {pad}"), (21, ITEMS[1][1].upper()), (22, f"{pad} {ITEMS[5][1]}"),
                           (23, "Which river runs near the old town of Ruhm? Nobody knows."), (24, "the old town of the long winter flag"), (20, f"{pad} {ITEMS[0][1]} {pad}")])
    items = spark.createDataFrame([*ITEMS, ITEMS[0]], "item_id long, text string")
    got = sorted((r["doc_id"], r["item_id"]) for r in rows_of(d.contaminated(docs, items)))
    assert got == [(20, 1), (20, 1), (21, 2), (22, 5)]
    kept = d.drop_contaminated(docs, items)
    assert kept.columns == docs.columns
    assert kept.count() == docs.count() - 4 and not {20, 21, 22} & {r["doc_id"] for r in kept.select("doc_id").collect()}
    none = spark.createDataFrame([], "item_id long, text string")
    assert d.contaminated(docs, none).count() == 0 and d.drop_contaminated(docs, none).count() == docs.count()
    assert d.contaminated(nothing(spark), items).count() == 0


def test_shards_give_the_same_rows(spark):
    docs = awkward(spark, [(i, f"start {t} end") for i, (_, t) in enumerate(ITEMS)])
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    shards = list(d.index_shards(items, shard_items=2))
    assert len(shards) > 1
    found = {(i, s.item[p]) for s in shards for i, (_, t) in enumerate(ITEMS) for p in d._Matcher(s, 0.6, 0.8, 0.8, 5, 64).retrieve(d.WORD.findall((t or "").lower()))}
    assert {(0, 1), (1, 2), (5, 5)} <= found and docs.count() == len(ITEMS)


def test_question_and_answer():
    assert d.question_and_answer("A b? C d.") == (["a", "b"], ["c", "d"])
    assert d.question_and_answer("A b. Answer: c") == (["a", "b"], ["c"])
    assert d.question_and_answer("a b c") == (["a", "b"], ["c"])
    assert d.question_and_answer("") == ([], [])


def test_impacts_count_words_of_any_script(spark):
    texts = [(i, f"¿Dónde está el niño número {i}? Está en la montaña{i} ДОМ 日本" + " más allá" * (40 * (i % 2))) for i in range(12)]
    shard, = d.index_shards(spark.createDataFrame(texts, "item_id long, text string"))
    words = {i: re.findall(r"\w+", t.lower()) for i, t in texts}
    parts = [ws[at:at + 64] for ws in words.values() for at in range(0, len(ws), 64)]
    mean = sum(map(len, parts)) / len(parts)
    frequency = Counter(w for ws in words.values() for w in set(ws))
    want = []
    for part in parts:
        raw = {w: math.log(1 + (12 - frequency[w] + 0.5) / (frequency[w] + 0.5)) * tf * (d.K1 + 1) / (tf + d.K1 * (1 - d.B + d.B * len(part) / mean))
               for w, tf in Counter(part).items()}
        want.append(sorted((w, round(x / sum(raw.values()), 4)) for w, x in raw.items()))
    names = sorted(shard.vocabulary, key=shard.vocabulary.get)
    got = [sorted((names[i], round(float(x), 4)) for i, x in enumerate(column) if x > 0) for column in shard.impact.T]
    key = lambda part: [w for w, _ in part]
    for a, b in zip(sorted(got, key=key), sorted(want, key=key), strict=True):
        assert key(a) == key(b) and all(abs(x - y) < 2e-4 for (_, x), (_, y) in zip(a, b, strict=True))
