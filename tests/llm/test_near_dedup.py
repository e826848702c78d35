import random
import re
import time

import numpy as np
import pyarrow as pa
import xxhash
from helpers import TEXTS, awkward, nothing, rows_of
from pyspark.sql import functions as F

from tidemark.llm import near_dedup
from tidemark.llm.common import components


def brute_fingerprint(text, width=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    runs = [words[i:i + width] for i in range(max(1, len(words) - width + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(" ".join(r).encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(values, bits=4):
    """value -> smallest member of its component, by comparing all pairs"""
    values, parent = sorted(set(values)), {}
    for v in values:
        parent[v] = v

    def root(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for i, a in enumerate(values):
        for b in values[i + 1:]:
            if (a ^ b).bit_count() <= bits:
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {v: root(v) for v in values}


def test_whole_operator_on_awkward_rows(spark):
    got = rows_of(near_dedup.near_duplicates(awkward(spark)).withColumn("hex", near_dedup.hex_fingerprint()))
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in got) == sorted((k is None, k or 0) for k, _ in TEXTS)
    fps = {t: brute_fingerprint(t) for _, t in TEXTS}
    of = brute_components(fps.values())
    least = {}
    for k, t in TEXTS:
        if k is not None:
            least[of[fps[t]]] = min(k, least.get(of[fps[t]], k))
    want = sorted((f"{fps[t]:016x}", least.get(of[fps[t]]) or -1) for k, t in TEXTS)
    assert sorted((r["hex"], r["component_id"] or -1) for r in got) == want
    assert near_dedup.near_duplicates(nothing(spark)).count() == 0


def test_links_match_brute_force_on_dense_values(spark):
    rng = random.Random(5)
    values = set()
    for _ in range(40):  # clusters with members up to six bits from a centre, and loners
        centre = rng.getrandbits(64)
        for _ in range(rng.choice([1, 2, 30])):
            v = centre
            for bit in rng.sample(range(64), rng.randint(0, 6)):
                v ^= 1 << bit
            values.add(v)
    values |= {0, 1, 2**64 - 1, 2**63}
    signed = [(int(np.uint64(v).astype(np.int64)),) for v in values]
    fps = spark.createDataFrame(signed, "fp long")
    for block in (4096, 8):  # 8: almost every key is dealt in blocks
        roots = {r["node"]: r["root"] for r in components(near_dedup.fingerprint_links(fps, block=block)).collect()}
        of = brute_components(values)
        sets = {}
        for v in values:
            sets.setdefault(of[v], set()).add(int(np.uint64(v).astype(np.int64)))
        got = {}
        for (v,) in signed:
            got.setdefault(roots.get(v, v), set()).add(v)
        assert sorted(map(sorted, got.values())) == sorted(map(sorted, sets.values()))


def test_components_of_paths_hubs_and_nothing(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, 100 + i) for i in range(1, 60)] + [(7, 7), (None, 3), (5, None)]
    got = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {**{i: 0 for i in range(51)}, **{i: 100 for i in range(100, 160)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_keep_one_of_each(spark):
    docs = awkward(spark)
    kept = near_dedup.keep_one_each(docs)
    assert kept.columns == docs.columns
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in kept.collect())
    # 1 and 2 are equal, 13 differs in its last word (similarity 9/11), 3, 4, 5 and a null id have no words, 8 stands twice
    assert got == [(False, k) for k in (1, 3, 6, 7, 8, 9, 10, 11, 12)] + [(True, 0)] or got == [(False, k) for k in (1, 3, 6, 7, 8, 9, 10, 11, 12, 13)] + [(True, 0)]
    assert near_dedup.keep_one_each(nothing(spark)).count() == 0


def jaccard(a, b, width=5):
    x, y = (({tuple(w[i:i + width]) for i in range(max(1, len(w) - width + 1))}) for w in (a.lower().split(), b.lower().split()))
    return len(x & y) / len(x | y)


def test_near_copies_go_and_others_stay(spark):
    rng = random.Random(9)
    vocabulary = [f"word{i}" for i in range(4000)]
    rows, source = [], {}
    for i in range(60):
        base = rng.choices(vocabulary, k=rng.randint(60, 900))
        rows.append((i, " ".join(base)))
        for k in range(rng.choice([0, 1, 6])):
            copy = list(base)
            for at in rng.sample(range(len(copy)), max(1, len(copy) // rng.choice([60, 120, 25, 6]))):
                copy[at] = "changed"
            rows.append((1000 + 10 * i + k, " ".join(copy)))
            source[rows[-1][0]] = jaccard(" ".join(base), " ".join(copy))
    kept = {r["doc_id"] for r in near_dedup.keep_one_each(awkward(spark, rows)).collect()}
    assert set(range(60)) <= kept
    assert not [k for k, j in source.items() if j >= 0.9 and k in kept]
    assert not [k for k, j in source.items() if j < 0.55 and k not in kept]
    close = [k for k, j in source.items() if j >= 0.8]
    assert len(close) > 20 and sum(k in kept for k in close) <= 0.1 * len(close)


def test_links_are_decided_by_the_exact_similarity(spark):
    rng, rows, pairs = random.Random(12), [], {}
    for i in range(240):
        base = [f"w{i}x{k}" for k in range(rng.randint(60, 400) if i % 4 else rng.randint(12, 60))]
        copy = base[:round(len(base) * rng.uniform(0.74, 0.9))] + [f"v{i}x{k}" for k in range(len(base) // 40)]
        rows += [(2 * i, " ".join(base)), (2 * i + 1, " ".join(copy))]
        apart = (near_dedup.simhash(rows[-1][1], 5) ^ near_dedup.simhash(rows[-2][1], 5)) & (2**64 - 1)
        pairs[i] = jaccard(rows[-1][1], rows[-2][1]), apart.bit_count()
    kept = {r["doc_id"] for r in near_dedup.keep_one_each(awkward(spark, rows)).collect()}
    close, other = [i for i, (j, _) in pairs.items() if j >= 0.8], [i for i, (j, bits) in pairs.items() if j < 0.8 and bits > 4]
    assert min(len(close), len(other)) > 80
    assert sum(2 * i + 1 in kept for i in close) <= 1
    assert all(2 * i + 1 in kept for i in other)


def test_one_hot_key_in_blocks(spark):
    rng = random.Random(2)
    base = rng.choices([f"w{i}" for i in range(300)], k=200)
    texts = []
    for i in range(300):
        copy = list(base)
        copy[rng.randrange(200)] = f"x{i}"
        texts.append((i, " ".join(copy)))
    marks = awkward(spark, texts).select(near_dedup._marks_column("text", 5, 42).alias("m")).select("m.*")
    for block in (4096, 40):
        roots = components(near_dedup.similar_links(marks, 0.8, block=block)).collect()
        assert len({r["root"] for r in roots}) == 1 and len({r["node"] for r in roots}) == marks.select("node").distinct().count()


def test_plan_has_no_cross_join(spark):
    plan = near_dedup.fingerprint_links(spark.range(10).select(F.col("id").alias("fp")))._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_keys_are_not_broadcast_by_the_size_of_the_fingerprints(spark):
    """Spark sizes the keys by the fingerprints they are made from, a fortieth of their rows."""
    rng = random.Random(9)
    fps = spark.createDataFrame([(rng.getrandbits(63),) for _ in range(1000)], "fp long")
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "60k")  # 16 kB of fingerprints, over a megabyte of keys
    try:
        links = near_dedup.fingerprint_links(fps)
        links.collect()
        assert "BroadcastExchange" not in links._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)


def broadcast_unmeasured(plan):
    """The rows made of others (keys of bands or of fingerprints) that a plan broadcasts before their own size is known."""
    lines = plan.split("== Initial Plan ==")[0].split("\n")
    deep = [re.match(r"[\s:+\-]*", line).end() for line in lines]
    found = []
    for i, line in enumerate(lines):
        if line[deep[i]:].startswith("BroadcastExchange"):
            for k in range(i + 1, len(lines)):
                if deep[k] <= deep[i] or "Exchange" in lines[k]:
                    break
                found += [lines[k]] if "MapInArrow" in lines[k] or "posexplode" in lines[k] else []
    return found


def test_the_stage_broadcasts_no_keys_by_the_size_of_their_nodes(spark, monkeypatch):
    rng = random.Random(10)
    texts = [" ".join(f"w{rng.randrange(500)}" for _ in range(30)) for _ in range(1000)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts + texts[:100])], "doc_id long, text string")
    plans, kept = [], spark.conf.get("spark.sql.autoBroadcastJoinThreshold")

    def watched(edges):
        edges.collect()
        plans.append(edges._jdf.queryExecution().executedPlan().toString())
        return components(edges)

    monkeypatch.setattr(near_dedup, "components", watched)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "300k")
    try:
        assert near_dedup.keep_one_each(docs).count() == 1000
        assert len(plans) > 1 and [x for p in plans for x in broadcast_unmeasured(p)] == []
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)


def classes(n, edges):
    """The smallest member of each one's component."""
    of = list(range(n))
    for a, b in edges:
        of = [min(of[a], of[b]) if x in (of[a], of[b]) else x for x in of]
    return of


def pairs_of(batches):
    return [e for b in batches for e in zip(b.column("a").to_pylist(), b.column("b").to_pylist(), strict=True)]


def alike(a, b, similarity):
    return len(a & b) >= similarity * len(a | b) - 1e-9


def test_short_sets_are_linked_as_by_brute_force():
    rng = random.Random(11)
    for _ in range(120):
        wide, similarity, sets = rng.choice([8, 30, 300]), rng.choice([0.8, 0.5, 0.9, 1.0, 0.75]), []
        for _ in range(rng.randrange(2, 40)):
            one = set(rng.choice(sets)) if sets and rng.random() < 0.6 else {rng.randrange(wide) for _ in range(rng.randrange(1, 40))}
            for _ in range(rng.randrange(6)):
                one ^= {rng.randrange(wide)}
            sets.append(one or {0})
        links = {(i, j) for i in range(len(sets)) for j in range(len(sets)) if i != j and alike(sets[i], sets[j], similarity)}
        got = pairs_of(near_dedup._short_tree(list(range(len(sets))), [np.array(sorted(s), "<u8") for s in sets], similarity))
        assert set(got) <= links and classes(len(sets), got) == classes(len(sets), links)


def test_a_component_of_short_texts_is_not_compared_pair_by_pair():
    """Short texts are candidates by one band, so their component grows with the table; 4,000 took 64 s when all pairs were compared."""
    rng, n = random.Random(12), 4000
    words = [rng.getrandbits(63) for _ in range(3000)]
    sets = [np.unique(np.array(rng.sample(words, 40), "<u8")) for _ in range(n - 1)]
    sets.append(sets[0][:-1])
    rows = pa.RecordBatch.from_pydict({"root": [1] * n, "short": [True] * n, "part": [0] * n, "node": list(range(n)), "places": [bytes(near_dedup.BINS)] * n,
                                       "shingles": [s.tobytes() for s in sets], "number": list(map(len, sets))})
    began = time.process_time()
    assert pairs_of(near_dedup._link_exact(iter([rows]), 0.8)) == [(0, n - 1)]
    assert time.process_time() - began < 10


def test_texts_between_short_and_long_are_linked(spark):
    """Pairs with fewer than FEW shingles together are sought apart from the others; texts of 178 to 221 shingles are in both."""
    rng, width = random.Random(13), 5
    texts = []
    for size in (150, 177, 178, 182, 200, 215, 221, 222, 260, 300):
        base = [f"w{rng.randrange(100_000)}" for _ in range(size + width - 1)]
        texts += [" ".join(base), " ".join([*base, *(f"x{rng.random()}" for _ in range(size // 7))]), " ".join(base[size // 6:])]
    marks = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, text string").select("i", near_dedup._marks_column("text", width, 42).alias("m"))
    rows = marks.select("i", "m.node", "m.bands", "m.places", "m.number", "m.shingles")
    place = {r["node"]: r["i"] for r in rows.collect()}
    runs = [{" ".join(t.split()[i:i + width]) for i in range(len(t.split()) - width + 1)} for t in texts]
    links = {(i, j) for i in range(len(runs)) for j in range(len(runs)) if i != j and alike(runs[i], runs[j], 0.8)}
    assert min(len(runs[i]) + len(runs[j]) for i, j in links) < near_dedup.FEW < max(len(runs[i]) + len(runs[j]) for i, j in links)
    for block in (4096, 4):
        got = [(place[r["a"]], place[r["b"]]) for r in near_dedup.similar_links(rows, 0.8, block).collect()]
        assert set(got) <= links and classes(len(runs), got) == classes(len(runs), links)
