from decimal import Decimal
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import casting as C
from tidemark.schemas import schema_from_names, type_from_name

DEC = T.DecimalType(12, 2)
D = Decimal
# text, micro-batch int, micro-batch decimal, backfill decimal, exact (en), exact (id)
NUMBERS = [
    ("1234.56", 1234, D("123456.00"), D("1234.00"), D("1234.56"), D("1234.56")),
    ("1.234,56", 1, D("1234.56"), D("1.00"), D("1234.56"), D("1234.56")),
    ("1,234.56", 1, D("1.23"), D("1.00"), D("1234.56"), D("1234.56")),
    ("1,234", 1, D("1.23"), D("1.00"), D("1234.00"), D("1.23")),
    ("1.234.567", 1, D("1234567.00"), D("1.00"), D("1234567.00"), D("1234567.00")),
    ("Rp 1.500", 1, D("1.50"), D("1.00"), D("1.50"), D("1500.00")),
    (".5", 5, D("5.00"), D("5.00"), D("0.50"), D("0.50")),
    (",5", 5, D("0.50"), D("5.00"), D("0.50"), D("0.50")),
    ("1e5", 15, D("100000.00"), D("15.00"), D("100000.00"), D("100000.00")),
    ("12-3", 12, None, D("12.00"), None, None),
    ("--5", None, None, None, None, None),
    ("", None, None, None, None, None),
    ("  ", None, None, None, None, None),
    ("abc", None, None, None, None, None),
    ("True", None, None, None, None, None),
    (None, None, None, None, None, None),
    ("99999999999", None, None, None, None, None),
]


def _one(spark, texts, *columns):
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    rows = frame.select("i", *(c.alias(f"c{n}") for n, c in enumerate(columns))).orderBy("i").collect()
    return [tuple(r)[1:] for r in rows]


def test_worked_number_table(spark):
    t = F.col("t")
    got = _one(
        spark, [n[0] for n in NUMBERS],
        C.cast_column(t, T.IntegerType(), numeric_mode="compat_microbatch"),
        C.cast_column(t, DEC, numeric_mode="compat_microbatch"),
        C.cast_column(t, DEC, numeric_mode="compat_backfill"),
        C.cast_column(t, DEC),
        C.cast_column(t, DEC, locale="id"),
    )
    for case, row in zip(NUMBERS, got):
        assert row == case[1:], case[0]


@pytest.mark.parametrize("text,expected", [
    ("1 234,5", D("1234.50")), ("\tRp.1.234.567 ", D("1234567.00")), ("$ 12.5", D("12.50")),
    ("US$1,234.50", D("1234.50")), ("-Rp 2,5", D("-2.50")), ("+7", D("7.00")), ("1,5.2,3", None), ("1.500.000,25", D("1500000.25")),
    ("NaN", None), ("Infinity", None), ("1234.567", D("1234.57")), ("5.", D("5.00")), (".", None),
    ("0x10", None), ("1d", None), ("-1.005", D("-1.01")),
])
def test_exact_decimal(spark, text, expected):
    assert _one(spark, [text], C.exact_number(F.col("t"), DEC))[0][0] == expected


@pytest.mark.parametrize("text,kind,expected", [
    ("-1.9", T.IntegerType(), -1), ("1,999", T.IntegerType(), 1999), ("2147483648", T.IntegerType(), None),
    ("2147483648", T.LongType(), 2147483648), ("9223372036854775807", T.LongType(), 9223372036854775807),
    ("300", T.ByteType(), None), ("12.9", T.ByteType(), 12), ("1e3", T.ShortType(), 1000),
    ("1e2", T.DoubleType(), 100.0), ("0,25", T.FloatType(), 0.25),
])
def test_exact_other_numbers(spark, text, kind, expected):
    assert _one(spark, [text], C.exact_number(F.col("t"), kind))[0][0] == expected


def test_booleans_times_and_sized_text(spark):
    assert [r[0] for r in _one(spark, [" T", "yes\t", "1", "F", "No", "0", "maybe", "", None],
                               C.cast_column(F.col("t"), T.BooleanType()))] == \
        [True, True, True, False, False, False, None, None, None]
    got = _one(spark, [" 2025-01-02 03:04:05.678 ", "2025-01-02", "", " ", "x", "2025-01-01 00:00:00+07:00"],
               C.cast_column(F.col("t"), T.TimestampNTZType()), C.cast_column(F.col("t"), T.DateType()))
    assert [g[0] for g in got] == [datetime(2025, 1, 2, 3, 4, 5, 678000), datetime(2025, 1, 2), None, None, None,
                                   datetime(2025, 1, 1)]
    assert got[1][1] == date(2025, 1, 2) and got[2][1] is None
    assert _one(spark, ["abcdef"], C.cast_column(F.col("t"), T.VarcharType(3)))[0][0] == "abc"
    assert _one(spark, ["x"], C.cast_column(F.col("t"), None))[0][0] == "x"
    assert C.flag_is_set("Yes") and not C.flag_is_set("off")


def test_microbatch_leaves_tinyint_to_the_default_cast(spark):
    assert _one(spark, ["12", "12x"], C.cast_column(F.col("t"), T.ByteType(), numeric_mode="compat_microbatch")) == \
        [(12,), (None,)]


def test_typed_sources(spark):
    frame = spark.sql("select cast(1234.56 as decimal(12,2)) d, 7L n, timestamp_ntz'2025-01-01 00:00:00' ts, 'k' k")
    schema = schema_from_names({"D": "decimal(10,1)", "n": "int", "ts": "date", "k": "string"})
    exact = C.cast_to_schema(frame, schema).first()
    assert (exact.d, exact.n, exact.ts, exact.k) == (D("1234.6"), 7, date(2025, 1, 1), "k")
    assert C.cast_to_schema(frame, schema, numeric_mode="compat_backfill").first().d == D("1234.0")


def test_change_stream_decoding(spark):
    row = spark.range(1).select(
        C.decimal_text(F.lit("12.345"), 12, 3).alias("d"), C.micros_time(F.lit(1704067200000001)).alias("u"),
        C.millis_time(F.lit(1704067200001)).alias("m")).first()
    assert row.d == D("12.345") and row.u == datetime(2024, 1, 1, 0, 0, 0, 1) and row.m.microsecond == 1000


def test_type_names():
    assert type_from_name("timestamp(6) with time zone") == T.TimestampNTZType()
    assert type_from_name("numeric(10,2)") == T.DecimalType(10, 2)
    assert type_from_name("double precision") == T.DoubleType()
    assert type_from_name("varchar(5)") == T.VarcharType(5)


def test_bad_options(spark):
    with pytest.raises(ValueError):
        C.cast_column(F.col("t"), T.IntegerType(), numeric_mode="loose")
    with pytest.raises(ValueError):
        C.number_text(F.col("t"), "fr")
