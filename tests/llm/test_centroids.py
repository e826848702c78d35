"""Dictionary-encoded k-means against whole-number brute force."""

import hashlib
import math
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import centroids

SCHEMA = "vec_id long, embedding array<double>, label int, id string, v string, cluster string, hash string"


def brute(rows, dim, k, rounds, seed="3", scale=1024):
    """(id, cluster, distance, cluster inertia, inertia, centroid digest) by plain Python integers."""
    kept = [(key, [max(-centroids.LARGEST, min(centroids.LARGEST, math.floor(scale * x))) for x in v]) for key, v in rows
            if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return []
    sha = lambda key: hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    centre = [v for _, v in sorted(kept, key=lambda r: (sha(r[0]), r[1]))[:k]]
    apart = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    nearest = lambda v: min((apart(v, c), i) for i, c in enumerate(centre))[::-1]
    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[0], []).append(v)
        for c, own in groups.items():
            centre[c] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    final = [(key, *nearest(v)) for key, v in kept]
    of = Counter()
    for _, c, d in final:
        of[c] += d
    name = lambda c: hashlib.sha256(",".join(map(str, centre[c])).encode()).hexdigest()
    return [(key, c, d, of[c], sum(of.values()), name(c)) for key, c, d in final]


def frame(spark, rows):
    return spark.createDataFrame([(k, v, 1, "i", "v", "c", "h") for k, v in rows], SCHEMA)


def found(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_blocks_lose_nothing_and_copies_share_wide_ones():
    random = np.random.default_rng(5)
    mixed = np.vstack([random.integers(-300, 300, (300, 16)), np.repeat(random.integers(-300, 300, (3, 16)), 400, 0)]).astype(np.int32)
    for values in (mixed, np.zeros((50, 16), np.int32), mixed[:1], mixed[:2], random.integers(0, 2, (500, 16)).astype(np.int32)):
        blocks = centroids.dictionary_blocks(values)
        assert (np.hstack([entries[codes] for entries, codes in blocks]) == values).all()
        assert all(len(entries) == len({tuple(e) for e in entries.tolist()}) for entries, _ in blocks)
        assert all(len(entries) <= max(1, len(values) / 2) for entries, _ in blocks if entries.shape[1] > 1)
    assert len(centroids.dictionary_blocks(mixed)) == 1  # three in four are copies: whole vectors are the entries
    assert len(centroids.dictionary_blocks(random.integers(-10 ** 6, 10 ** 6, (500, 16)).astype(np.int32))) == 16


@pytest.mark.parametrize("chunk", [1, 7, 4096])
def test_against_brute_force(spark, chunk):
    random = np.random.default_rng(chunk)
    rows = [(i, (random.normal(0, 0.2, 6) + (i % 5)).tolist()) for i in range(150)]
    rows += [(7, rows[7][1])] * 60 + [(None, [0.1] * 6), (None, None), (1000, [0.0] * 5), (1001, [0.0] * 7), (1002, [float("nan")] + [0.0] * 5),
                                      (1003, [float("-inf")] + [1.0] * 5), (1004, [None] + [1.0] * 5), (1005, []), (1006, [-0.0001] * 6),
                                      (1007, [1e300, -1e300, 1e9, -1e9, 0.5, 0.25])]
    df = frame(spark, rows).repartition(3)
    got = centroids.centroid_clusters(df, dimensions=6, clusters=4, rounds=10, chunk_rows=chunk)
    assert found(got) == sorted(brute(rows, 6, 4, 10), key=str)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_ties_few_vectors_and_empty_clusters(spark):
    same = [(i, [1.0, 1.0]) for i in range(20)]
    assert found(centroids.centroid_clusters(frame(spark, same), dimensions=2, clusters=3)) == sorted(brute(same, 2, 3, 10), key=str)
    assert {r[1] for r in found(centroids.centroid_clusters(frame(spark, same), dimensions=2, clusters=3))} == {0}  # ties: the smaller number
    few = [(1, [0.0, 0.5]), (2, [3.0, 0.5])]
    assert found(centroids.centroid_clusters(frame(spark, few), dimensions=2, clusters=8, rounds=3)) == sorted(brute(few, 2, 8, 3), key=str)


def test_nothing_kept(spark):
    for rows in ([], [(1, [1.0]), (2, None)]):
        assert centroids.centroid_clusters(frame(spark, rows), dimensions=2).collect() == []
    with pytest.raises(ValueError, match="chunk_rows"):
        centroids.centroid_clusters(frame(spark, []), chunk_rows=1 << 17)


def test_an_inertia_beyond_a_long_is_the_largest(spark):
    far = [(i, [1e9 if i % 2 else -1e9] * 64) for i in range(40)]
    got = centroids.centroid_clusters(frame(spark, far), clusters=1, rounds=1).collect()
    assert {r.inertia for r in got} == {2 ** 63 - 1} and len(got) == 40
