"""Document fingerprints from closed syncmers, in Spark SQL expressions alone.

A text is a sequence of tokens (runs of at most eight non-blank characters), with two marks before and after it. A run of
``k`` tokens is an anchor when the smallest hash of its runs of ``s`` tokens stands at its first or last place: a property
of the run alone, so an edit elsewhere never moves an anchor. The fingerprint is the sorted list of the ``size`` smallest
anchor hashes; two fingerprints estimate the Jaccard likeness of the texts' anchor sets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import whole_text

TOKEN = r"\S{1,8}"


def anchors(text: Column, k: int = 3, s: int = 1) -> Column:
    """Distinct 32-bit hashes of the text's closed syncmers; a text without tokens has none."""
    tokens = F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))
    marked = F.concat(F.array(*[F.lit("\u0002")] * (k - 1)), tokens, F.array(*[F.lit("\u0003")] * (k - 1)))
    hashes = F.transform(marked, lambda t: F.xxhash64(t))
    inner = hashes if s == 1 else F.transform(F.sequence(F.lit(1), F.size(hashes) - s + 1), lambda i: F.xxhash64(F.slice(hashes, i, s)))

    def chosen(state: Column) -> Column:
        places = F.sequence(F.lit(1), F.size(state["h"]) - k + 1)
        edge = lambda i: F.least(F.get(state["m"], i - 1), F.get(state["m"], i + k - s - 1))
        kept = F.filter(places, lambda i: F.array_min(F.slice(state["m"], i, k - s + 1)) == edge(i))
        return F.transform(kept, lambda i: F.xxhash64(F.slice(state["h"], i, k)).bitwiseAND(F.lit(0xFFFFFFFF)))

    # one lambda over a single struct: the hashes are computed once, not at every place that names them
    state = F.array(F.struct(hashes.alias("h"), inner.alias("m")))
    found = F.flatten(F.transform(state, chosen))
    return F.when(F.size(tokens) > 0, F.array_distinct(found)).otherwise(F.array().cast("array<bigint>"))


def sketch(text: Column, size: int = 64, k: int = 3, s: int = 1) -> Column:
    return F.slice(F.sort_array(anchors(text, k, s)), 1, size)


def likeness(a: Column, b: Column, size: int = 64) -> Column:
    """Estimated Jaccard likeness of two sketches; two empty ones are alike."""
    both = F.slice(F.sort_array(F.array_union(a, b)), 1, size)
    shared = F.size(F.array_intersect(F.array_intersect(a, b), both))
    return F.when(F.size(both) == 0, 1.0).otherwise(shared / F.size(both))


def as_text(a: Column) -> Column:
    return F.array_join(F.transform(a, lambda x: F.lpad(F.lower(F.hex(x)), 8, "0")), "")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 64, k: int = 3, s: int = 1) -> DataFrame:
    """One row per input row: (id, fingerprint, n_anchors). Null texts are empty; an empty fingerprint is ''."""
    found = docs.select(F.col(id_col), anchors(whole_text(text_col), k, s).alias("a"))
    return found.select(id_col, as_text(F.slice(F.sort_array("a"), 1, size)).alias("fingerprint"), F.size("a").alias("n_anchors"))


def _bucket(key: str, bounds: list) -> Column:
    """How many of the sorted ``bounds`` lie below the column; found in two steps, so many bounds stay cheap."""
    if not bounds:
        return F.lit(0)
    step = max(1, round(len(bounds) ** 0.5))
    groups = [bounds[i:i + step] for i in range(0, len(bounds), step)]
    coarse = F.size(F.filter(F.lit([g[-1] for g in groups[:-1]]) if len(groups) > 1 else F.array().cast("array<bigint>"), lambda b: b < F.col(key)))
    fine = F.get(F.array(*[F.lit(g) for g in groups]), coarse)
    return F.when(F.col(key).isNull(), 0).otherwise(coarse * step + F.size(F.filter(fine, lambda b: b < F.col(key))))


def with_next(rows: DataFrame, key: str, carried: list[str], tie: list[Column], names: list[str], derived: dict[str, Column]) -> DataFrame:
    """Adds the ``derived`` columns, and to each row the ``carried`` ones, as ``names``, of the row that follows it in descending ``key`` (nulls last, ties
    by ``tie``); the last row is followed by the first.

    Rows are dealt to buckets of about equal size at quantiles of the (integer) key. Each bucket also gets a
    copy of the first row of the next one, so every pair of neighbours meets in one bucket and no task sees all rows.
    """
    spark = rows.sparkSession
    parts = max(8, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    shares = [i / parts for i in range(1, parts)]
    bounds = rows.agg(F.percentile_approx(key, shares, 20 * parts)).first()[0] or []
    dealt = rows.withColumn("__bucket", _bucket(key, sorted(set(bounds))))
    # the first row of each bucket: of its largest key, the smallest tie
    top = dealt.groupBy("__bucket").agg(F.max(key).alias("__top"))
    of_top = dealt.join(F.broadcast(top), "__bucket").where(F.col(key).eqNullSafe(F.col("__top")))
    one = F.row_number().over(_window("__bucket", *tie))
    # derived columns are costly: made for the chosen rows only, and once for each row below
    first = of_top.withColumn("__one", one).where("__one = 1").withColumns(derived).select("__bucket", *carried)
    # bucket b is followed by the nearest non-empty bucket below; the lowest by the highest
    order = sorted(r[0] for r in top.select("__bucket").collect())  # one number a bucket
    after = dict(zip(order[1:], order, strict=False)) | ({order[0]: order[-1]} if order else {})
    pairs = spark.createDataFrame([(b, a) for a, b in after.items()], "__bucket int, __for int")
    edges = first.join(F.broadcast(pairs), "__bucket").drop("__bucket").withColumnRenamed("__for", "__bucket").withColumn("__edge", F.lit(1))
    every = dealt.withColumns(derived).withColumn("__edge", F.lit(0)).unionByName(edges, allowMissingColumns=True)
    window = _window("__bucket", F.col("__edge"), F.desc_nulls_last(key), *tie)
    for column, name in zip(carried, names, strict=True):
        every = every.withColumn(name, F.lead(column).over(window))
    return every.where("__edge = 0").drop("__edge", "__bucket")


def _window(part: str, *order: Column):
    from pyspark.sql import Window

    return Window.partitionBy(part).orderBy(*order)


def edit_likeness(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 64, k: int = 3, s: int = 1) -> DataFrame:
    """How alike a text's fingerprint is to that of an edited version and to that of the next text.

    One row per input row: (id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next). The edited
    text has its last floor(n_chars / 3) characters replaced by as many first characters (or all) of the next text in
    descending id; after the last comes the first. Null texts are empty, null ids come last, rows with equal ids are ordered by their texts' hash
    and text. A single row is its own next one; an empty table gives no rows; other columns are not read. Ids are whole numbers.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), whole_text(text_col).alias("text"))
    tie = [F.xxhash64("text"), F.col("text")]
    rows = with_next(rows, "id", ["text", "sketch"], tie, ["next_text", "next_sketch"], {"sketch": sketch(F.col("text"), size, k, s)})
    n = F.length("text")
    m = F.floor(n / 3).cast("int")
    edited = F.concat(F.substr("text", F.lit(1), n - m), F.substr("next_text", F.lit(1), m))
    rows = rows.select("id", n.cast("long").alias("n_chars"), edited.alias("edited"), "sketch", "next_sketch")
    rows = rows.select("*", sketch(F.col("edited"), size, k, s).alias("edited_sketch"))
    return rows.select(
        F.col("id").alias(id_col), "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        as_text(F.col("sketch")).alias("fingerprint"), as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        likeness(F.col("sketch"), F.col("edited_sketch"), size).alias("near_edited"),
        likeness(F.col("sketch"), F.col("next_sketch"), size).alias("near_next"))
