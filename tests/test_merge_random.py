"""Both merge plans against a row-by-row merge in plain Python, on random small tables."""

import random

import pytest
from pyspark.sql import types as T

from tidemark.operators.upsert import MergeRules, merge_upsert

SCHEMA = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType()), T.StructField("v", T.StringType()),
                       T.StructField("n", T.LongType()), T.StructField("seq", T.LongType())])
KEYS = ("a", "b")


def rows(rng, count, tag, unique):
    out, seen = [], set()
    for i in range(count):
        key = (rng.choice([None, 1, 1, 2, 3, 4]), rng.choice([None, 1, 2, 3]))
        if unique and key in seen and None not in key:
            continue
        seen.add(key)
        out.append((*key, f"{tag}{i}", rng.choice([None, 1, 2, 3]), i))
    return out


def newest(source):
    best = {}
    for row in source:
        rank = tuple((x is not None, x or 0) for x in (row[3], row[4]))
        if row[:2] not in best or rank > best[row[:2]][0]:
            best[row[:2]] = (rank, row)
    return [row for _, row in best.values()]


def brute(target, source, guarded):
    matched, out = set(), []
    for t in target:
        hit = [(i, s) for i, s in enumerate(source) if None not in t[:2] and s[:2] == t[:2]]
        for i, s in hit:
            matched.add(i)
            out.append(s if not guarded or (s[3] or 0) > (t[3] or 0) else t)
        if not hit:
            out.append(t)
    return out + [s for i, s in enumerate(source) if i not in matched]


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("strategy", ["full_outer", "lookup"])
def test_random_merges(spark, seed, strategy):
    rng = random.Random(seed)
    target, source = rows(rng, 12, "t", True), rows(rng, 25, "s", False)
    t, s = spark.createDataFrame(target, SCHEMA), spark.createDataFrame(source, SCHEMA)

    def run(frame, **kw):
        out = merge_upsert(t, frame, MergeRules(keys=KEYS, op=None, updated_col="n", created_col=None, tiebreakers=["seq"],
                                                strategy=strategy, **kw))
        return sorted((tuple(r) for r in out.collect()), key=repr)

    def expect(src):
        return sorted(brute(target, src, False), key=repr)

    assert run(s) == expect(newest(source))
    known = {r[:2] for r in target}
    # repeated keys that match nothing are all inserted, matched keys come once
    loose = [r for r in source if r[:2] not in known or None in r[:2]] + [r for r in newest(source) if r[:2] in known and None not in r[:2]]
    assert run(spark.createDataFrame(loose, SCHEMA), dedupe=False) == expect(loose)
    assert run(s, dedupe=False, on_duplicate="allow") == expect(source)
