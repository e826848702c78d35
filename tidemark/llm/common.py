"""Helpers shared by the training-data operators: tables, word hashing, connected components."""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import configure, stable

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(text: str | Column = "text") -> Column:
    """The text, null read as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z alone; other letters stay."""
    return F.translate(text, ASCII_UPPER, ASCII_UPPER.lower())


def latin_class(kind: str) -> str:
    """Characters below U+0250 whose general category starts with ``kind``, for the inside of a regex class."""
    return "".join(re.escape(chr(c)) for c in range(0x250) if unicodedata.category(chr(c)).startswith(kind))


def fold_of(doc_id: str, folds: int = 5) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id gets fold 1, so it is never held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds, F.lit(1))


def _bin(n: str) -> Column:
    """Eighths of an octave: a few hundred bins for any counts."""
    return F.floor(8 * F.log2(F.col(n)))


def _bins(rows: DataFrame, n: str) -> list[tuple[int, int]]:
    return sorted(((r[0], r[1]) for r in rows.groupBy(_bin(n)).agg(F.count("*")).collect()), reverse=True)


def frequent(rows: DataFrame, n: str, most: int) -> DataFrame:
    """The rows with the largest counts ``n``, whole bins of them, ``most`` rows at most. No sort; the driver sees a histogram."""
    total, least = 0, None
    for edge, size in _bins(rows, n):
        if total + size > most:
            break
        total, least = total + size, edge
    return rows.where(F.lit(False)) if least is None else rows.where(_bin(n) >= least)


def top(rows: DataFrame, n: str, most: int, *ties: str) -> DataFrame:
    """The ``most`` rows with the largest counts, ties in the order of ``ties``; only bins that can hold them are sorted."""
    total, least = 0, None
    for edge, size in _bins(rows, n):
        if total >= most:
            break
        total, least = total + size, edge
    few = rows if least is None else rows.where(_bin(n) >= least)
    return few.orderBy(F.desc(n), *ties).limit(most)


def lowest_hashes(rows: DataFrame, key: str, most: int) -> DataFrame:
    """At most ``most`` rows, those whose (distinct) keys hash lowest; only a share that can hold them is sorted."""
    n = rows.count()
    if n <= most:
        return rows
    share = min(1.0, (most + 10 * most ** 0.5) / n)  # ten standard deviations more than wanted
    small = F.xxhash64(key) < F.lit(int(-(2 ** 63) + share * (2 ** 64 - 2 ** 12)))
    return rows.where(small).orderBy(F.xxhash64(key), key).limit(most)


def _edge_state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % 1_000_003)).first()
    return row[0], row[1] or 0


def components(edges: DataFrame, a: str = "a", b: str = "b", most_rounds: int = 60) -> DataFrame:
    """Connected components of an edge list: (node, root), root the smallest node, nodes with an edge only.

    Alternating large-star and small-star steps, a logarithmic number of rounds. Every step is a
    minimum by node (combined before its shuffle) joined back to the edges, so a hub with a third of all
    edges is only a skewed join, which Spark splits. Each round is checkpointed in the shared folder.
    Null ends are dropped; no edges give no rows.
    """
    edges = edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where("a <> b").distinct()
    edges = stable(edges)
    state = _edge_state(edges)
    for _ in range(most_rounds):
        if not state[0]:
            break
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        # large star: every larger neighbour points at the smallest of the neighbourhood
        large = (both.where("b > a").join(least, "a")
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct())
        # small star: every smaller neighbour, and the node itself, points at the smallest
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct())
        edges = stable(small)
        now = _edge_state(edges)
        if now == state:
            break
        state = now
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
