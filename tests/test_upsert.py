from datetime import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.latest import current_state, dedupe_source, latest_per_key
from tidemark.operators.upsert import MergeRules, merge_upsert
from tidemark.session import estimated_bytes, stable

AS_OF = datetime(2025, 1, 1, 5, 0, 0, 123456)
TARGET = "id long, name string, price decimal(12,2), created_at timestamp_ntz, updated_at timestamp_ntz, __op string, __ts_ms timestamp_ntz"
STAGE = "id string, name string, price string, created_at string, updated_at string, extra string"


def day(n):
    return datetime(2024, 1, n)


def target(spark):
    rows = [(i, f"t{i}", None, day(1), day(10), "initial", None) for i in (1, 2, 3)]
    rows += [(4, "t4", None, day(1), None, "initial", None), (None, "tn", None, None, None, "initial", None),
             (9, "t9", None, day(1), day(10), "initial", None)]
    return spark.createDataFrame(rows, TARGET)


def stage(spark):
    return spark.createDataFrame([
        ("1", "newer", "1.234,50", "2024-01-01", " 2024-01-11 ", "x"),
        ("01", "older version", "7", "2024-01-01", "2024-01-09", "x"),
        ("2", "equal", "7", "2024-01-01", "2024-01-10", "x"),
        ("3", "no time", "7", None, "", "x"),
        ("4", "target has no time", "7", None, "1971-01-01", "x"),
        ("5", "insert", "", "2024-01-02", "2024-01-02", "x"),
        ("5", "insert older", "", "2024-01-01", "2024-01-01", "x"),
        (None, "null key", "8", "2024-01-01", "2024-01-11", "x"),
    ], STAGE)


def rules(**kw):
    return MergeRules(**{"keys": "id", "guard": "updated_at", "op": "run", "as_of": AS_OF, **kw})


def names(df):
    return sorted(((r.id, r.name) for r in df.select("id", "name").collect()), key=lambda p: (p[0] is None, p))


EXPECTED = [(1, "newer"), (2, "t2"), (3, "t3"), (4, "target has no time"), (5, "insert"), (9, "t9"),
            (None, "null key"), (None, "tn")]


@pytest.mark.filterwarnings("ignore:columns not in")
@pytest.mark.parametrize("strategy", ["auto", "full_outer", "lookup"])
def test_guarded_merge(spark, strategy):
    merged = merge_upsert(target(spark), stage(spark), rules(strategy=strategy))
    assert merged.schema.simpleString() == target(spark).schema.simpleString()
    assert names(merged) == EXPECTED
    one = merged.filter("id = 1").first()
    assert str(one.price) == "1234.50" and one["__op"] == "run"
    assert one["__ts_ms"] == datetime(2025, 1, 1, 12, 0, 0, 123000)
    assert merged.filter("id = 2").first()["__op"] == "initial"
    # merging the same source again changes nothing apart from null keys
    keyed = stage(spark).filter("id is not null")
    once = merge_upsert(target(spark), keyed, rules(strategy=strategy))
    twice = merge_upsert(once, keyed, rules(strategy=strategy))
    assert once.exceptAll(twice).isEmpty() and twice.exceptAll(once).isEmpty()


@pytest.mark.filterwarnings("ignore:columns not in")
@pytest.mark.parametrize("strategy", ["full_outer", "lookup"])
def test_merge_options(spark, strategy):
    def run(**kw):
        return merge_upsert(target(spark), stage(spark), rules(strategy=strategy, **kw))

    assert dict(names(run(guard=None)))[3] == "no time"
    keep = run(exclude_update=["name"]).filter("id = 1").first()
    assert keep.name == "t1" and str(keep.price) == "1234.50"
    extra = names(run(extra_on=["t.name <> 't1'"]))
    assert (1, "t1") in extra and (1, "newer") in extra
    assigned = run(set_={"name": "concat(t.name, '>', s.name)", "nowhere": "1"}, insert_={"name": F.lit("fresh")})
    got = dict(names(assigned.filter("id is not null")))
    assert got[1] == "t1>newer" and got[5] == "fresh"
    assert (None, "null key") not in names(run(null_keys="drop"))
    with pytest.raises(PySparkException):
        run(null_keys="error").collect()


@pytest.mark.filterwarnings("ignore:columns not in")
def test_order_by_columns_the_target_lacks(spark):
    bare = spark.createDataFrame([(1, "old")], "id long, v string")
    src = spark.createDataFrame([("1", "first", "", "2024-01-09", "5"), ("1", "second", "2024-01-10", "junk", "4"),
                                 ("2", "low", "x", "y", "1"), ("2", "high", "x", "y", "2")],
                                "id string, v string, updated_at string, created_at string, seq string")
    out = merge_upsert(bare, src, MergeRules(keys="id", updated_col="updated_at", tiebreakers=["seq"]))
    assert names(out.withColumnRenamed("v", "name")) == [(1, "second"), (2, "high")]


def test_keys_only_target(spark):
    two = spark.createDataFrame([(1,), (2,)], "id long")
    src = spark.createDataFrame([("2",), ("3",)], "id string")
    for strategy in ("full_outer", "lookup"):
        out = merge_upsert(two, src, MergeRules(keys="id", strategy=strategy))
        assert sorted(r.id for r in out.collect()) == [1, 2, 3]


@pytest.mark.filterwarnings("ignore:columns not in")
@pytest.mark.parametrize("strategy", ["full_outer", "lookup"])
def test_deletes(spark, strategy):
    src = spark.createDataFrame([("1", "d", "2024-01-11"), ("2", "d", "2024-01-09"), ("3", "d", None), ("7", "d", None),
                                 ("8", "c", "2024-01-01")], "id string, __op string, updated_at string")
    kept = merge_upsert(target(spark), src, rules(strategy=strategy, apply_deletes=True))
    assert sorted(i for i, _ in names(kept) if i) == [2, 4, 8, 9]
    plain = merge_upsert(target(spark), src, rules(strategy=strategy, op=None))
    assert plain.filter("id = 1").first()["__op"] == "d"


@pytest.mark.filterwarnings("ignore:columns not in")
@pytest.mark.parametrize("strategy", ["auto", "full_outer", "lookup"])
def test_undeduplicated_source(spark, strategy):
    def run(source, **kw):
        return merge_upsert(target(spark), source, rules(dedupe=False, strategy=strategy, **kw))

    dup = stage(spark).filter("id in ('5', '2') or id is null")
    out = names(run(dup.unionAll(dup.filter("id is null"))))
    assert [n for i, n in out if i == 5] == ["insert", "insert older"]
    assert [n for i, n in out if i is None] == ["null key", "null key", "tn"]
    assert (2, "t2") in out and len(out) == 6 + 2 + 2
    clash = stage(spark).filter("id in ('1', '01')")
    with pytest.raises(PySparkException, match="two merge source rows"):
        run(clash).collect()
    with pytest.raises(PySparkException, match="two merge source rows"):
        run(clash).count()
    assert run(clash, on_duplicate="allow").count() == 7
    once = stage(spark).filter("id in ('1', '4', '5') and name not like '%older'")
    assert names(run(once)) == names(merge_upsert(target(spark), once, rules(strategy="full_outer")))


def test_clear_errors(spark):
    bare = spark.createDataFrame([("1",)], "id string")
    with pytest.raises(ValueError, match="guard column"):
        merge_upsert(target(spark), bare, rules())
    with pytest.raises(ValueError, match="key"):
        MergeRules(keys=" , ")
    with pytest.raises(ValueError, match="lacks"):
        merge_upsert(target(spark), bare, MergeRules(keys="nope"))


def test_hot_key_is_cut_before_the_shuffle(spark):
    hot = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
                                   F.col("id").alias("updated_at"))
    last = dedupe_source(hot, "k")
    plan = last._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert plan.rindex("WindowGroupLimit") > plan.index("Exchange hashpartitioning")
    assert last.count() == 2001 and last.filter("k = 0").first().updated_at == 2997


def test_full_outer_shuffles_each_side_once(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        t = spark.range(100).select("id", F.lit("t").alias("name"))
        s = spark.range(50, 150).select("id", F.lit("s").alias("name"))
        out = merge_upsert(t, s, MergeRules(keys="id"))
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 2 and "SortMergeJoin" in plan
        assert out.count() == 150
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_small_source_leaves_the_target_unshuffled(spark, tmp_path):
    """The session's broadcast threshold decides: both sides within it, only the source, none."""
    spark.range(20000).select("id", F.lit("t").alias("name")).write.parquet(str(tmp_path / "t"))
    spark.range(19990, 20010).select("id", F.lit("s").alias("name")).write.parquet(str(tmp_path / "s"))
    t, s = (spark.read.parquet(str(tmp_path / x)) for x in "ts")
    between = (estimated_bytes(s) + estimated_bytes(t)) // 2
    assert estimated_bytes(s) < between < estimated_bytes(t)

    def merged(threshold):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        try:
            jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup())
            out = merge_upsert(t, s, MergeRules(keys="id"))
            plan = out._jdf.queryExecution().executedPlan().toString()
            assert len(spark.sparkContext.statusTracker().getJobIdsForGroup()) == jobs  # planning runs no job
            assert out.count() == 20010 and out.filter("name = 's'").count() == 20
            return plan
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")

    assert "FullOuter" in merged(100 << 20)
    lookup = merged(between)
    assert "SortMergeJoin" not in lookup and lookup.count("BroadcastHashJoin") >= 3
    assert "SortMergeJoin" in (plan := merged(-1)) and "FullOuter" in plan


def test_a_source_read_often_is_made_once_when_asked(spark):
    seen = []

    def keep(df):
        seen.append(df.columns)
        return stable(df)

    t = spark.range(100).select("id", F.lit("t").alias("name"))
    s = spark.range(50, 150).select("id", F.lit("s").alias("name"))
    for strategy, times in (("lookup", 1), ("full_outer", 0)):
        seen.clear()
        assert merge_upsert(t, s, MergeRules(keys="id", strategy=strategy), run_once=keep).filter("name = 's'").count() == 100
        assert len(seen) == times


def test_current_state(spark):
    log = spark.createDataFrame([(1, "c", day(1), 1), (1, "u", day(2), 2), (2, "c", day(1), 3), (2, "d", day(1), 4),
                                 (3, None, day(1), 5)], "id int, __op string, __ts_ms timestamp_ntz, seq int")
    state = current_state(log, "id", sequence=["seq"])
    assert sorted((r.id, r.seq) for r in state.collect()) == [(1, 2), (2, 4), (3, 5)]
    live = current_state(log, "id", sequence=["seq"], drop_deleted=True)
    assert sorted(r.id for r in live.collect()) == [1, 3]


def test_latest_is_stable_on_ties(spark):
    ties = spark.createDataFrame([(1, 1, c) for c in "abc"], "k int, o int, v string")
    picks = {latest_per_key(ties.repartition(n), "k", [F.col("o").desc()]).first().v for n in (1, 2, 3)}
    assert len(picks) == 1
