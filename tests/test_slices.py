"""Backfills in slices against one pass, stopped, started again and interrupted between merge and mark."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.plans import jobs, slices
from tidemark.sinks import silver

TARGET = T.StructType([T.StructField("id", T.LongType()), T.StructField("v", T.StringType()), T.StructField("day", T.StringType()),
                       T.StructField("updated_at", T.TimestampNTZType())])
START = datetime(2024, 1, 1)


def source_view(spark, name, text="first", rows=300, null_keys=False):
    """A third of the rows share one time; the rest lie minutes apart, squared."""
    minutes = F.when(F.col("id") % 3 == 0, F.lit(900)).otherwise(F.col("id") * F.col("id") / 10).cast("int")
    at = F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(mins=minutes)
    key = F.when(F.col("id") < 250, F.col("id")) if null_keys else F.col("id")
    spark.range(rows).select(key.alias("id"), F.lit(text).alias("v"), F.date_format(at, "yyyy-MM-dd").alias("day"),
                             at.alias("updated_at")).createOrReplaceTempView(name)


def dest(spark, tmp_path, label, partitions=()):
    silver.ensure_database(spark, "slicedb", str(tmp_path))
    name = f"slicedb.{label}"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    silver.create_table(spark, name, TARGET, str(tmp_path / label), partitions=partitions)
    return name


def rows(spark, table, *columns):
    spark.catalog.refreshTable(table)
    return sorted(spark.table(table).select(*columns or ("id", "v", "day", "updated_at")).collect(), key=str)


@pytest.mark.parametrize("partitions", [(), ("day",)])
def test_stopped_backfill_goes_on_with_open_slices(spark, tmp_path, partitions):
    source_view(spark, "sliced_rows")
    table = dest(spark, tmp_path, "stopped", partitions)
    spec = jobs.BackfillSpec("sliced_rows", table, "id", filter_start="2024-01-01", filter_end="2025-01-01", options={"null_keys": "error"})
    ledger = str(tmp_path / "ledger")
    assert slices.backfill_in_slices(spark, spec, ledger, slices=4, most_slices=2) >= 1
    half = {r.id for r in rows(spark, table, "id")}
    assert 0 < len(half) < 300
    source_view(spark, "sliced_rows", "second")  # rows of finished slices would change if they were read again
    assert slices.backfill_in_slices(spark, spec, ledger, slices=99) == 0
    assert {r.id: r.v for r in rows(spark, table, "id", "v")} == {i: "first" if i in half else "second" for i in range(300)}
    assert slices.backfill_in_slices(spark, spec, ledger) == 0


def test_slices_equal_one_pass(spark, tmp_path):
    source_view(spark, "sliced_rows")
    whole, parts = dest(spark, tmp_path, "whole"), dest(spark, tmp_path, "parts")
    as_of = datetime(2024, 3, 1)
    jobs.backfill(spark, jobs.BackfillSpec("sliced_rows", whole, "id", filter_end="2024-01-04"), as_of=as_of)
    assert slices.backfill_in_slices(spark, jobs.BackfillSpec("sliced_rows", parts, "id", filter_end="2024-01-04"), str(tmp_path / "l"),
                                     rows_per_slice=50, as_of=as_of) == 0
    assert rows(spark, parts) == rows(spark, whole) and len(rows(spark, whole)) < 300


def test_slice_merged_but_not_marked_is_not_merged_twice(spark, tmp_path, monkeypatch):
    source_view(spark, "sliced_rows", null_keys=True)
    table, ledger = dest(spark, tmp_path, "lost"), str(tmp_path / "ledger")
    spec = jobs.BackfillSpec("sliced_rows", table, "id", filter_start="2024-01-01")
    with monkeypatch.context() as patch:
        patch.setattr(slices, "_mark", lambda *a: (_ for _ in ()).throw(ConnectionError("driver lost")))
        with pytest.raises(ConnectionError):
            slices.backfill_in_slices(spark, spec, ledger, slices=3)
    assert slices.backfill_in_slices(spark, spec, ledger) == 0
    found = rows(spark, table, "id")
    assert len(found) == 300 and sum(r.id is None for r in found) == 50


def test_cuts_are_balanced_and_whole(spark, tmp_path):
    source_view(spark, "sliced_rows")
    source = spark.table("sliced_rows")
    cuts = slices.quantile_cuts(source, "updated_at", 6)
    bounds = list(zip([None, *map(str, cuts)], [*map(str, cuts), None]))
    counts = [slices._within(source, "updated_at", *b).count() for b in bounds]
    assert sum(counts) == 300 and max(counts) <= 100 + 50  # the shared time's hundred rows stay together
    texts = source.withColumn("updated_at", F.col("updated_at").cast("string"))
    assert slices.quantile_cuts(texts, "updated_at", 6) == cuts
    untimed = source.withColumn("updated_at", F.when(F.col("id") > 9, F.col("updated_at")))
    assert sum(slices._within(untimed, "updated_at", *b).count() for b in bounds) == 300
    assert slices.quantile_cuts(source.limit(0), "updated_at", 6) == [] == slices.quantile_cuts(source, "updated_at", 1)
    same = source.withColumn("updated_at", F.lit(START + timedelta(days=1)).cast("timestamp_ntz"))
    assert slices.quantile_cuts(same, "updated_at", 6) == []


def test_refusals(spark, tmp_path):
    source_view(spark, "sliced_rows")
    plain, parted = dest(spark, tmp_path, "plain"), dest(spark, tmp_path, "parted", ("day",))
    spec = jobs.BackfillSpec("sliced_rows", plain, "id", filter_start="2024-01-01")
    assert slices.backfill_in_slices(spark, spec, str(tmp_path / "l"), slices=2, most_slices=0) == 2
    with pytest.raises(ValueError, match="another backfill"):
        slices.backfill_in_slices(spark, jobs.BackfillSpec("sliced_rows", plain, "id", filter_start="2024-01-02"), str(tmp_path / "l"))
    with pytest.raises(ValueError, match="time column"):
        slices.backfill_in_slices(spark, jobs.BackfillSpec("sliced_rows", plain, "id", filter_col="nope"), str(tmp_path / "m"))
    with pytest.raises(ValueError, match="null_keys"):
        slices.backfill_in_slices(spark, jobs.BackfillSpec("sliced_rows", parted, "id"), str(tmp_path / "n"))
    empty = jobs.BackfillSpec("sliced_rows", plain, "id", filter_start="2030-01-01")
    assert slices.backfill_in_slices(spark, empty, str(tmp_path / "e")) == 0 and rows(spark, plain) == []
