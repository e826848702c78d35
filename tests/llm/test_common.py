import random

from tidemark.llm import common


def test_frequent_and_top(spark):
    rng = random.Random(1)
    counts = [(f"w{i}", rng.choice([1, 1, 1, 2, 3, 7, 50, 51, 400, rng.randint(1, 3000)])) for i in range(900)]
    rows = spark.createDataFrame(counts, "w string, n long")
    order = sorted(counts, key=lambda c: (-c[1], c[0]))
    for most in (0, 1, 10, 300, 899, 5000):
        assert [tuple(r) for r in common.top(rows, "n", most, "w").collect()] == order[:most]
        got = [tuple(r) for r in common.frequent(rows, "n", most).collect()]
        assert len(got) <= most and (not got or min(n for _, n in got) > max((n for w, n in counts if (w, n) not in set(got)), default=0))
    assert common.frequent(rows.where("false"), "n", 5).count() == 0 == common.top(rows.where("false"), "n", 5).count()


def test_lowest_hashes(spark):
    rows = spark.range(5000).toDF("id")
    got = sorted(r[0] for r in common.lowest_hashes(rows, "id", 700).collect())
    hashes = {r[0]: r[1] for r in rows.selectExpr("id", "xxhash64(id)").collect()}
    assert got == sorted(sorted(hashes, key=hashes.get)[:700])
    assert common.lowest_hashes(rows, "id", 5000).count() == 5000
