"""Casting, alignment, de-duplication, upsert and backfill queries."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import casting
from tidemark.operators import columns as cols
from tidemark.operators.latest import dedupe_source, latest_per_key
from tidemark.operators.predicates import backfill_filter, look_back
from tidemark.operators.upsert import MergeRules, merge_upsert
from tidemark.schemas import schema_from_names
from tidemark.session import stable
from tidemark.sources.relations import query as run_sql

from .inputs import (
    AS_OF, AS_OF_WIB_SQL, number_texts, plain, silver_orders, stg_orders, table, typed_changes, with_inputs,
)
from .registry import query

DEC = T.DecimalType(12, 2)
STAGED_TYPES = schema_from_names({
    "o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string", "o_totalprice": "decimal(12,2)",
    "created_at": "timestamp", "updated_at": "timestamp"})

# --- casts -----------------------------------------------------------------------------------

# Expected values by text style: 0 1234.56, 1 Rp 1234.56, 2 1234,56, 3 1.234,56, 4 1,234.56, 5 blank, 6 no-break space and 1234.56,
# 7 -1234.56, 8 12e2, 9 .12, 10 12-3, 11 n/a R
_WHOLE = "CASE WHEN style = 7 THEN -trunc(price) WHEN style IN (3, 4) AND price >= 1000000 THEN trunc(price / 1000000) " \
    "WHEN style IN (3, 4) AND price >= 1000 THEN trunc(price / 1000) ELSE trunc(price) END"
# leading digits: a thousands sign ends them, the e is skipped, other signs before them too
_LEADING = f"CASE WHEN style IN (5, 11) THEN NULL WHEN style = 8 THEN quantity * 10 + 2 WHEN style IN (9, 10) THEN quantity ELSE {_WHOLE} END"
# a dot is read as a thousands sign wherever the rest is then a number
_FRACTION = """CASE WHEN style IN (5, 10, 11) THEN NULL WHEN style = 0 THEN price * 100 WHEN style = 7 THEN -price * 100
  WHEN style = 4 AND price < 1000 THEN price * 100 WHEN style = 4 AND price < 1000000 THEN round(price / CAST(1000 AS DECIMAL(12,2)), 2)
  WHEN style = 8 THEN quantity * 100 WHEN style = 9 THEN quantity ELSE price END"""
# the number itself, whatever its style
_EXACT = """CASE WHEN style IN (5, 10, 11) THEN NULL WHEN style = 7 THEN -price WHEN style = 8 THEN quantity * 100
  WHEN style = 9 THEN quantity / CAST(power(10, length(CAST(quantity AS VARCHAR))) AS DECIMAL(12,2)) ELSE price END"""
_NUMBER_KEYS = "l_orderkey, l_linenumber, l_partkey, t"


def _number_query(spark: SparkSession, sf: str, **kinds: F.Column) -> DataFrame:
    return plain(number_texts(spark, sf).select(
        "l_orderkey", "l_linenumber", "l_partkey", "t", *(c.alias(n) for n, c in kinds.items())))


@query(with_inputs(f"SELECT {_NUMBER_KEYS}, CAST({_LEADING} AS INTEGER) AS n FROM number_texts", "number_texts"))
def cast_int_compat(spark, sf):
    return _number_query(spark, sf, n=casting.cast_column(F.col("t"), T.IntegerType(), numeric_mode="compat_microbatch"))


@query(with_inputs(f"SELECT {_NUMBER_KEYS}, CAST({_FRACTION} AS DOUBLE) AS n FROM number_texts", "number_texts"))
def cast_decimal_compat(spark, sf):
    return _number_query(spark, sf, n=casting.cast_column(F.col("t"), DEC, numeric_mode="compat_microbatch"))


@query(with_inputs(
    f"SELECT {_NUMBER_KEYS}, CAST({_LEADING} AS DOUBLE) AS d, "
    f"CAST({_LEADING} AS BIGINT) AS n FROM number_texts", "number_texts"))
def cast_backfill_compat(spark, sf):
    def cast(kind):
        return casting.cast_column(F.col("t"), kind, numeric_mode="compat_backfill")
    return _number_query(spark, sf, d=cast(DEC), n=cast(T.LongType()))


_EXACT_SQL = with_inputs(f"SELECT {_NUMBER_KEYS}, CAST({_EXACT} AS DOUBLE) AS d, CAST(trunc({_EXACT}) AS INTEGER) AS n FROM number_texts", "number_texts")


@query(_EXACT_SQL)
def cast_number_exact(spark, sf):
    return _number_query(spark, sf, d=casting.exact_number(F.col("t"), DEC),
                         n=casting.exact_number(F.col("t"), T.IntegerType()))


@query(_EXACT_SQL)
def cast_number_exact_id(spark, sf):
    return _number_query(spark, sf, d=casting.exact_number(F.col("t"), DEC, "id"),
                         n=casting.exact_number(F.col("t"), T.IntegerType(), "id"))


_WORDS = ("t", "TRUE", " yes ", "1", "Y", "f", "False", "0 ", "n", "NO", "maybe", "")
_FLAG_SQL = "CASE (l_orderkey + l_linenumber) % 12 " + " ".join(
    f"WHEN {i} THEN '{w}'" for i, w in enumerate(_WORDS)) + " END"


@query(f"""SELECT l_orderkey, l_linenumber, w, CASE WHEN lower(trim(w)) IN ('t','true','1','y','yes') THEN TRUE
  WHEN lower(trim(w)) IN ('f','false','0','n','no') THEN FALSE END AS b
FROM (SELECT l_orderkey, l_linenumber, {_FLAG_SQL} AS w FROM lineitem) x""")
def cast_boolean(spark, sf):
    words = F.array(*(F.lit(w) for w in _WORDS))
    style = ((F.col("l_orderkey") + F.col("l_linenumber")) % 12).cast("int")
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.get(words, style).alias("w")).withColumn(
        "b", casting.cast_column(F.col("w"), T.BooleanType()))


@query("""SELECT o_orderkey, t, try_cast(nullif(trim(t), '') AS TIMESTAMP) AS ts,
  CAST(try_cast(nullif(trim(t), '') AS DATE) AS VARCHAR) AS d
FROM (SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN CAST(o_orderdate AS VARCHAR)
  WHEN 1 THEN concat('  ', CAST(CAST(o_orderdate AS DATE) AS VARCHAR), ' ') WHEN 2 THEN ' ' WHEN 3 THEN 'soon'
  ELSE concat(CAST(o_orderdate AS VARCHAR), '.250') END AS t FROM orders) x""")
def cast_timestamp_date(spark, sf):
    style, text = F.col("o_orderkey") % 5, F.col("o_orderdate").cast("string")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    t = (F.when(style == 0, text).when(style == 1, F.concat(F.lit("  "), day, F.lit(" "))).when(style == 2, F.lit(" "))
         .when(style == 3, F.lit("soon")).otherwise(F.concat(text, F.lit(".250"))))
    return plain(table(spark, sf, "orders").select("o_orderkey", t.alias("t")).select(
        "o_orderkey", "t", casting.cast_column(F.col("t"), T.TimestampNTZType()).alias("ts"),
        casting.cast_column(F.col("t"), T.DateType()).alias("d")))


# --- alignment -------------------------------------------------------------------------------

_ORDER_NAMES = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")


@query("""SELECT o_orderkey AS order_id, o_custkey AS customer, o_orderstatus AS state, o_totalprice AS amount,
  o_orderdate AS ordered_at, o_orderpriority AS priority FROM orders""")
def align_by_position(spark, sf):
    unnamed = table(spark, sf, "orders").toDF("A", "b b", "C-1", "1x", "", "Z")
    return cols.align_columns(unnamed, ["order_id", "customer", "state", "amount", "ordered_at", "priority"], by="position")


@query("""SELECT o_totalprice, o_orderkey, o_custkey, o_orderstatus, o_orderdate, o_orderpriority,
  o_orderkey * 2 AS extra_column FROM orders""")
def align_by_name(spark, sf):
    shuffled = table(spark, sf, "orders").select(
        F.col("o_totalprice").alias("O_TOTALPRICE"), *(n for n in _ORDER_NAMES if n != "o_totalprice"),
        (F.col("o_orderkey") * 2).alias("Extra Column"))
    return cols.align_columns(shuffled, (), [*_ORDER_NAMES, "__op", "__ts_ms"])


@query("""SELECT o_orderkey + 1 AS next_key, o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
FROM orders""")
def align_tail(spark, sf):
    wide = table(spark, sf, "orders").select((F.col("o_orderkey") + 1).alias("Next Key"), *(
        F.col(n).alias(f"c{i}") for i, n in enumerate(_ORDER_NAMES)))
    return cols.align_columns(wide, (), _ORDER_NAMES)


@query("SELECT concat(l_orderkey, '', l_linenumber) AS unique_id, l_orderkey, l_linenumber, l_partkey FROM lineitem")
def computed_key(spark, sf):
    return cols.computed_key(table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey"),
                             "unique_id", ["l_orderkey", "l_linenumber"])


@query("SELECT o_orderkey, o_totalprice, o_orderdate FROM orders")
def pruned_columns(spark, sf):
    return cols.keep_destination_columns(table(spark, sf, "orders"), ["O_ORDERKEY", "o_totalprice", "o_orderdate", "__op"])


@query(f"SELECT o_orderkey, o_custkey, 'cron-2-hours' AS __op, {AS_OF_WIB_SQL} AS __ts_ms FROM orders")
def run_metadata(spark, sf):
    return cols.add_run_metadata(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), "cron-2-hours", AS_OF)


# --- de-duplication --------------------------------------------------------------------------

@query(with_inputs(
    "SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DOUBLE) AS o_totalprice, created_at, updated_at "
    "FROM staged_values", "typed_changes", "latest_changes", "staged_values"))
def dedupe_latest(spark, sf):
    return plain(dedupe_source(casting.cast_to_schema(stg_orders(spark, sf), STAGED_TYPES), "o_orderkey"))


@query("""SELECT * FROM lineitem QUALIFY row_number() OVER (
  PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC) = 1""")
def dedupe_composite_key(spark, sf):
    order = [F.col(c).desc_nulls_last() for c in ("l_shipdate", "l_partkey", "l_suppkey")]
    return latest_per_key(table(spark, sf, "lineitem"), "l_orderkey,l_linenumber", order)


# --- upsert ----------------------------------------------------------------------------------

_GUARD = "coalesce(s.updated_at, TIMESTAMP '1970-01-01') > coalesce(t.updated_at, TIMESTAMP '1970-01-01')"
_OUT = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "created_at", "updated_at", "__op", "__ts_ms")
_SOURCE_SIDE = {c: f"s.{c}" for c in _OUT[:6]} | {"__op": "'cron-2-hours'", "__ts_ms": AS_OF_WIB_SQL}
_INPUTS = ("silver_orders", "typed_changes", "latest_changes", "staged_values")


def merge_sql(*, guard=_GUARD, on="", update=None, insert=None, keep=(), target="silver_orders", source="staged_values",
              inputs=_INPUTS) -> str:
    """Full-join twin of a merge over the order columns."""
    updates = {**_SOURCE_SIDE, **{k: f"t.{k}" for k in ("o_orderkey", *keep)}, **(update or {})}
    inserts = {**_SOURCE_SIDE, **(insert or {})}
    picked = []
    for c in _OUT:
        value = f"CASE WHEN NOT t.in_t THEN {inserts[c]} WHEN s.in_s AND {guard} THEN {updates[c]} ELSE t.{c} END"
        value = value.replace("NOT t.in_t", "t.in_t IS NULL").replace("s.in_s AND", "s.in_s IS NOT NULL AND")
        picked.append(f"CAST({value} AS DOUBLE) AS {c}" if c == "o_totalprice" else f"{value} AS {c}")
    return with_inputs(
        f"SELECT {', '.join(picked)} FROM (SELECT *, TRUE AS in_t FROM {target}) t "
        f"FULL JOIN (SELECT *, TRUE AS in_s FROM {source}) s ON t.o_orderkey = s.o_orderkey {on}", *inputs)


def order_rules(**changes) -> MergeRules:
    return MergeRules(**{"keys": "o_orderkey", "guard": "updated_at", "op": "cron-2-hours", "as_of": AS_OF, **changes})


def _merge(spark, sf, **changes) -> DataFrame:
    return plain(merge_upsert(silver_orders(spark, sf), stg_orders(spark, sf), order_rules(**changes), run_once=stable))


@query(merge_sql())
def merge_guarded(spark, sf):
    return _merge(spark, sf)


@query(merge_sql())
def merge_guarded_lookup(spark, sf):
    """The plan taken for a small source under a large target."""
    return _merge(spark, sf, strategy="lookup")


@query(merge_sql(guard="TRUE"))
def merge_unguarded(spark, sf):
    return _merge(spark, sf, guard=None, updated_col="updated_at")


@query(merge_sql(keep=("o_custkey", "created_at")))
def merge_exclude_update(spark, sf):
    return _merge(spark, sf, exclude_update=["o_custkey", "created_at"])


@query(merge_sql(on="AND t.o_orderstatus <> 'F'"))
def merge_extra_on(spark, sf):
    return _merge(spark, sf, extra_on=["t.o_orderstatus <> 'F'"])


@query(merge_sql(update={"o_orderstatus": "concat(t.o_orderstatus, '>', s.o_orderstatus)"}, insert={"o_custkey": "-1"}))
def merge_extra_assign(spark, sf):
    return _merge(spark, sf, set_={"o_orderstatus": "concat(t.o_orderstatus, '>', s.o_orderstatus)"},
                  insert_={"o_custkey": F.lit(-1)})


@query("""SELECT o_custkey FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01' GROUP BY o_custkey
UNION SELECT c_custkey FROM customer""")
def merge_keys_only(spark, sf):
    known = silver_orders(spark, sf).select("o_custkey").distinct()
    staged = table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("o_custkey"))
    return merge_upsert(known, staged, MergeRules(keys="o_custkey"))


_NULL_TARGET = "SELECT CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderkey END AS o_orderkey, * EXCLUDE (o_orderkey) FROM silver_orders"
_NULL_SOURCE = """SELECT CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderkey END AS o_orderkey, o_custkey, o_orderstatus,
  CAST(o_totalprice AS DECIMAL(12,2)) AS o_totalprice, o_orderdate AS created_at, o_orderdate + to_days(1) AS updated_at FROM orders"""


def _null_p(df: DataFrame) -> DataFrame:
    return df.withColumn("o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey")))


@query(merge_sql(target=f"({_NULL_TARGET})", source=f"({_NULL_SOURCE})", inputs=("silver_orders",)))
def merge_null_keys(spark, sf):
    """A third of the keys are null on both sides; they never match and all are kept."""
    source = _null_p(table(spark, sf, "orders")).select(
        "o_orderkey", "o_custkey", "o_orderstatus", F.col("o_totalprice").cast(DEC).alias("o_totalprice"),
        F.col("o_orderdate").alias("created_at"), (F.col("o_orderdate") + F.expr("interval 1 day")).alias("updated_at"))
    return plain(merge_upsert(_null_p(silver_orders(spark, sf)), source, order_rules(dedupe=False)))


# --- extracts and backfill -------------------------------------------------------------------

def backfill_source(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", F.lower("o_orderstatus").alias("o_orderstatus"),
        F.col("o_totalprice").cast(DEC).alias("o_totalprice"), F.col("o_orderdate").alias("created_at"),
        (F.col("o_orderdate") + F.make_dt_interval((F.col("o_orderkey") % 7 - 3).cast("int"))).alias("updated_at"))


_BACKFILL = """(SELECT * FROM (SELECT o_orderkey, o_custkey, lower(o_orderstatus) AS o_orderstatus,
  CAST(o_totalprice AS DECIMAL(12,2)) AS o_totalprice, o_orderdate AS created_at,
  o_orderdate + to_days(CAST(o_orderkey % 7 - 3 AS INTEGER)) AS updated_at FROM orders) b WHERE {where})"""
BACKFILL_LOW, BACKFILL_HIGH = datetime(1997, 1, 1), datetime(2000, 6, 1)
RECENT_AS_OF = datetime(2001, 7, 15)


def backfill_sql(where: str) -> str:
    return merge_sql(source=_BACKFILL.format(where=where), inputs=("silver_orders",))


BACKFILL_RANGE_SQL = backfill_sql("updated_at >= TIMESTAMP '1997-01-01' AND updated_at < TIMESTAMP '2000-06-01'")


@query(BACKFILL_RANGE_SQL)
def backfill_range(spark, sf):
    source = backfill_filter(backfill_source(spark, sf), start=BACKFILL_LOW, end=BACKFILL_HIGH)
    return plain(merge_upsert(silver_orders(spark, sf), source, order_rules(dedupe=False)))


@query(backfill_sql("updated_at > TIMESTAMP '2001-06-15'"))
def backfill_30day(spark, sf):
    source = backfill_filter(backfill_source(spark, sf), as_of=RECENT_AS_OF)
    return plain(merge_upsert(silver_orders(spark, sf), source, order_rules(dedupe=False)))


@query("""SELECT event_id, ts, user_id, event_type, value FROM events
WHERE ts >= TIMESTAMP '2024-01-15 09:30:00' AND ts < TIMESTAMP '2024-01-15 12:00:00'""")
def lookback_extract(spark, sf):
    return look_back(table(spark, sf, "events"), "ts", datetime(2024, 1, 15, 12), timedelta(hours=2, minutes=30)).select(
        "event_id", "ts", "user_id", "event_type", "value")


@query("SELECT event_id AS event_id, value * 2 AS double_value FROM events WHERE value >= 10.5 AND event_type <> 'error'")
def param_extract(spark, sf):
    return run_sql(spark, 'SELECT event_id, value * 2 AS `Double Value` FROM {src} WHERE value >= ? AND event_type <> ?',
                   "[10.5, \"error\"]", src=table(spark, sf, "events"))


@query(with_inputs(
    "SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DOUBLE) AS o_totalprice, created_at, updated_at "
    "FROM typed_changes", "typed_changes"))
def typed_versions(spark, sf):
    """All versions of the change set, typed, before any de-duplication."""
    return plain(typed_changes(spark, sf))
