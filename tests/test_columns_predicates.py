from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import clock, rules
from tidemark.operators import columns as C
from tidemark.operators import predicates as P


@pytest.mark.parametrize("raw,expected", [
    (" Order ID ", "order_id"), ("a--b__c", "a_b_c"), ("1abc", "_1abc"), ("__op", "__op"), ("__TS_MS", "__ts_ms"),
    ("%%", "col"), ("", "col_4"), (None, "col_4"), ("_x_", "x"), ("Größe", "gr_e"),
])
def test_name_rule(raw, expected):
    assert C.normalize_name(raw, 4) == expected


def test_alignment(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["B", "a", "Extra One"])
    assert C.align_columns(df, (), ["a", "b", "__op"]).columns == ["b", "a", "extra_one"]
    assert C.align_columns(df).columns == ["b", "a", "extra_one"]
    # compat: an equal count renames by position even when the order differs
    assert C.align_columns(df, ["a", "b", "c"], by="compat").columns == ["a", "b", "c"]
    assert C.align_columns(df, ["a", "b", "extra one", "d"], ["a", "b"], by="compat").columns == ["b", "a", "extra_one"]
    # no name matches: the tail takes the names
    assert C.align_columns(df, (), ["x", "y"]).columns == ["b", "x", "y"]
    with pytest.warns(UserWarning, match="aligning the first 3"):
        assert C.align_columns(df, (), ["w", "x", "y", "z"]).columns == ["w", "x", "y"]
    with pytest.raises(ValueError, match="both become"):
        C.align_columns(spark.createDataFrame([(1, 2)], ["a b", "a_b"]))
    with pytest.raises(ValueError, match="unknown alignment"):
        C.align_columns(df, by="luck")


def test_key_helpers(spark):
    assert C.clean_keys(" a, b ,,a") == ["a", "b"]
    assert C.resolve_tiebreakers("updated_at, id, x, id", "k1,k2", "changed_at") == ["changed_at", "k1", "k2", "x"]
    assert C.resolve_tiebreakers("updated_at", "k", None) == ["updated_at"]
    df = spark.createDataFrame([(1, None, "x")], "a int, b string, c string")
    assert C.computed_key(df, "k", ["a", "b", "c"]).first().k == "1x"
    with pytest.raises(ValueError, match="lacks"):
        C.require_columns(df, ["A", "zz"])
    with pytest.warns(UserWarning, match="ignored"):
        assert C.keep_destination_columns(df, ["A", "B"]).columns == ["a", "b"]


def test_window_resolution():
    day = date(2024, 3, 1)
    midnight = datetime(2024, 3, 1)
    assert clock.resolve_window(day, date(2024, 3, 3)) == (midnight, datetime(2024, 3, 3))
    assert clock.resolve_window(start=day) == (midnight, midnight + timedelta(days=1))
    assert clock.resolve_window(target_date=day) == (midnight, midnight + timedelta(days=1))
    assert clock.resolve_window(today=day)[0] == midnight
    with pytest.raises(ValueError):
        clock.resolve_window(day, day)
    with pytest.raises(ValueError):
        clock.resolve_window(end=day)


def test_clocks(spark):
    moment = datetime(2024, 1, 1, 20, 0, 0, 999999, tzinfo=timezone.utc)
    row = spark.range(1).select(clock.wib_clock(moment).alias("w"), clock.wib_clock().alias("now"),
                                clock.utc_clock().alias("utc")).first()
    assert row.w == datetime(2024, 1, 2, 3, 0, 0, 999000)
    assert abs((row.now - row.utc) - timedelta(hours=7)) < timedelta(seconds=2)
    assert abs(row.utc - datetime.now(timezone.utc).replace(tzinfo=None)) < timedelta(minutes=2)


def test_ranges(spark):
    rows = [(i, datetime(2024, 1, 1) + timedelta(hours=i)) for i in range(6)] + [(9, None)]
    typed = spark.createDataFrame(rows, "i int, ts timestamp_ntz")
    text = typed.withColumn("ts", F.concat(F.lit(" "), F.col("ts").cast("string")))
    for df in (typed, text):
        got = P.in_range(df, "ts", datetime(2024, 1, 1, 1), "2024-01-01 03:00:00")
        assert sorted(r.i for r in got.collect()) == [1, 2]
        assert sorted(r.i for r in P.look_back(df, "ts", datetime(2024, 1, 1, 5)).collect()) == [3, 4]
        assert P.in_range(df, "ts", None, None).count() == 7
    plan = P.in_range(typed, "ts", datetime(2024, 1, 1), None)._jdf.queryExecution().optimizedPlan().toString()
    assert "cast(ts" not in plan.lower()


def test_backfill_filter(spark):
    df = spark.createDataFrame([(1, "2024-01-30"), (2, "2024-01-01 00:00:00"), (3, None), (4, "2023-12-31")], "i int, updated_at string")
    ids = lambda d: sorted(r.i for r in d.collect())
    assert ids(P.backfill_filter(df, as_of=date(2024, 1, 31))) == [1]
    assert ids(P.recent_days(df, "updated_at", date(1970, 1, 5))) == [1, 2, 3, 4]
    assert ids(P.backfill_filter(df, start="2024-01-01", end="2024-01-30")) == [2]
    with pytest.warns(UserWarning, match="range is ignored"):
        assert ids(P.backfill_filter(df, filter_col="nope", start="2024-01-01")) == [1, 2, 3, 4]
    assert ids(P.backfill_filter(df, updated_col="nope")) == [1, 2, 3, 4]


def test_check_filter_and_selection(spark):
    df = spark.createDataFrame([(1, datetime(2024, 1, 1), "a"), (2, datetime(2024, 1, 1), "b")], "i int, ts timestamp_ntz, k string")
    day = (datetime(2024, 1, 1), datetime(2024, 1, 2))
    assert P.check_filter(df, "ts", *day, "k = 'a' or i > 5").count() == 1
    logs = spark.createDataFrame([("s1", "j", 2024, 1, 5, "x/monitoring/status.json"), ("s2", "j", 2024, 1, 9, "x/log.txt")],
                                 "system string, job string, year int, month int, day int, src string")
    assert P.log_selection(logs, jobs=["j"], systems=["s1", "s2"], year=2024, month=1, days=(5, 9),
                           path_like="%/monitoring/status.json").count() == 1
    like = spark.createDataFrame([("db_source",), ("dbXsource",), ("db_source2",)], "source string")
    assert P.log_selection(like, source_like="db_source").count() == 2
    changes = spark.createDataFrame([("t", "c"), ("t", "r"), ("u", "d")], "table string, __op string")
    assert P.select_changes(changes, ["t"]).count() == 1 and P.select_changes(changes).count() == 2


def test_rules(spark):
    row = spark.range(1).select(
        rules.json_text_field(F.lit('  "a" : "x y",'), "a").alias("hit"), rules.json_text_field(F.lit('"b": 1'), "a").alias("miss"),
        rules.json_number_field(F.lit('"n": 12,'), "n").alias("n"), rules.source_of_path(F.lit("s3://b/logs/cron-batch/db/j/x")).alias("src"),
        rules.run_succeeded(F.lit("OK"), F.lit(0)).alias("ok"), rules.run_succeeded(F.lit(None).cast("string"), F.lit(0)).alias("unknown"),
        rules.check_id(F.lit(date(2024, 1, 2)), "a", "b").alias("id"),
        rules.rate_pct(F.lit(1), F.lit(0)).alias("none")).first()
    import hashlib
    assert (row.hit, row.miss, row.n, row.src, row.ok, row.unknown, row.none) == ("x y", None, "12", "db", True, None, None)
    assert row.id == hashlib.md5(b"a|b|2024-01-02").hexdigest()


def test_metadata(spark):
    df = C.add_run_metadata(spark.range(1), "op", datetime(2024, 1, 1))
    assert df.first()["__op"] == "op" and df.schema["__ts_ms"].dataType == T.TimestampNTZType()
    assert C.run_metadata({"id": T.LongType()}, "op") == {}
