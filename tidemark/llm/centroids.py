"""Exact integer k-means over dictionary-encoded vectors.

Vectors are gathered in chunks of bounded size, and each chunk is stored once as a column store would store it: its
dimensions are cut into blocks, each block has a dictionary of the distinct subvectors that occur, and a vector is a code per
block. Nothing is lost. Blocks grow by merging neighbours as long as their dictionary stays short against the chunk, so
copied vectors share wide blocks and unrelated ones share single components.

A round computes the squared distance from every dictionary entry to every centroid once, and a vector's distance is the
sum of its codes' partial distances. All arithmetic is on integers, so results depend neither on the number of chunks nor on
the order of rows. Rounds read the encoded table, which lies in the shared folder; what comes back to the driver is one
number per centroid and component.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import scratch_path

#: Components are clamped to this size, so that a squared distance fits a 64-bit number.
LARGEST = 1 << 26
COUNT, INERTIA = -1, -2  # places of a cluster's row count and summed distance beside its components


def integer_vectors(vectors: DataFrame, id_col: str, vector_col: str, dimensions: int, scale: int) -> DataFrame:
    """(id, v): whole numbers floor(scale * x) of the vectors with exactly ``dimensions`` finite components."""
    def bad(x: Column) -> Column:
        return x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))

    def whole(x: Column) -> Column:
        scaled = x.cast("double") * scale
        return F.floor(F.greatest(F.least(scaled, F.lit(float(LARGEST))), F.lit(float(-LARGEST)))).cast("int")

    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("x"))
    kept = rows.where((F.size("x") == dimensions) & ~F.exists("x", bad))
    return kept.select("id", F.transform("x", whole).alias("v"))


def dictionary_blocks(values: np.ndarray, share: float = 0.5) -> list[tuple[np.ndarray, np.ndarray]]:
    """[(entries, codes)] from the first dimension to the last: ``entries[codes]`` side by side are ``values`` again."""
    n, blocks = len(values), []
    for column in values.T:
        entries, codes = np.unique(column, return_inverse=True)
        blocks.append((entries[:, None], codes))
    most, grown = max(1, share * n), True
    while grown:
        grown, at, wider = False, 0, []
        while at < len(blocks):
            if at + 1 < len(blocks):
                (left, a), (right, b) = blocks[at:at + 2]
                if max(len(left), len(right)) <= most:
                    keys, codes = np.unique(a * len(right) + b, return_inverse=True)
                    if len(keys) <= most:
                        wider.append((np.hstack([left[keys // len(right)], right[keys % len(right)]]), codes))
                        at, grown = at + 2, True
                        continue
            wider.append(blocks[at])
            at += 1
        blocks = wider
    return blocks


def _encode(batches: Iterator[pa.RecordBatch], rows: int, dimensions: int, share: float, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held, size = [], 0

    def chunk() -> pa.RecordBatch:
        values = np.concatenate([b.column("v").flatten().to_numpy() for b in held]).reshape(-1, dimensions)
        blocks = dictionary_blocks(values, share)
        ids = pa.concat_arrays([b.column("id") for b in held])
        columns = [pa.ListArray.from_arrays([0, len(ids)], ids), pa.array([[e.shape[1] for e, _ in blocks]], pa.list_(pa.int32())),
                   pa.array([[len(e) for e, _ in blocks]], pa.list_(pa.int32())),
                   pa.array([b"".join(np.ascontiguousarray(e, "<i4").tobytes() for e, _ in blocks)], pa.binary()),
                   pa.array([b"".join(c.astype("<u2").tobytes() for _, c in blocks)], pa.binary())]
        return pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    for batch in batches:
        at = 0
        while at < batch.num_rows:
            held.append(batch.slice(at, rows - size))
            at, size = at + held[-1].num_rows, size + held[-1].num_rows
            if size == rows:
                yield chunk()
                held, size = [], 0
    if held and size:
        yield chunk()


def _distances(row: dict, centroids: np.ndarray) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Squared distances [vector, centroid], and the chunk's blocks."""
    entries, codes = np.frombuffer(row["entries"], "<i4").astype(np.int64), np.frombuffer(row["codes"], "<u2")
    n = len(codes) // len(row["widths"])
    total, blocks, at, first = np.zeros((n, len(centroids)), np.int64), [], 0, 0
    for i, (width, size) in enumerate(zip(row["widths"], row["sizes"], strict=True)):
        block, own = entries[at:at + width * size].reshape(size, width), codes[i * n:(i + 1) * n]
        apart = block[:, None, :] - centroids[None, :, first:first + width]
        total += (apart * apart).sum(2)[own]
        blocks.append((block, own))
        at, first = at + width * size, first + width
    return total, blocks


def _round(batches: Iterator[pa.RecordBatch], centroids: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(cluster, place, value): component sums of the vectors nearest to each centroid, their count and summed distance."""
    k, dimensions = centroids.shape
    sums, counts, inertia = np.zeros((k, dimensions), np.int64), np.zeros(k, np.int64), [0] * k
    for batch in batches:
        for row in batch.to_pylist():
            distance, blocks = _distances(row, centroids)
            cluster, near = distance.argmin(1), distance.min(1)
            counts += np.bincount(cluster, minlength=k)
            high, low = np.zeros(k, np.int64), np.zeros(k, np.int64)  # summed apart, so that no sum overflows
            np.add.at(high, cluster, near >> 32)
            np.add.at(low, cluster, near & 0xFFFFFFFF)
            inertia = [s + (int(h) << 32) + int(x) for s, h, x in zip(inertia, high, low, strict=True)]
            first = 0
            for entries, codes in blocks:
                occurs = np.bincount(cluster * len(entries) + codes, minlength=k * len(entries)).reshape(k, -1)
                sums[:, first:first + entries.shape[1]] += occurs @ entries
                first += entries.shape[1]
    places = [*range(dimensions), COUNT, INERTIA]
    values = [int(x) for c in range(k) for x in (*sums[c], counts[c], inertia[c])]
    yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(k), len(places)), pa.int32()), pa.array(places * k, pa.int32()),
                                      pa.array(values, pa.decimal128(38, 0))], names=["cluster", "place", "value"])


def _assign(batches: Iterator[pa.RecordBatch], centroids: np.ndarray, of_cluster: list[tuple[int, int, str]], schema: pa.Schema
            ) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, row in enumerate(batch.select(["widths", "sizes", "entries", "codes"]).to_pylist()):
            distance, _ = _distances(row, centroids)
            cluster = distance.argmin(1)
            found = pa.array(cluster, pa.int32())
            repeated = [pa.array([c[j] for c in of_cluster], f.type).take(found) for j, f in enumerate(list(schema)[3:])]
            yield pa.RecordBatch.from_arrays([batch.column("ids").slice(i, 1).flatten(), found, pa.array(distance.min(1)), *repeated], schema=schema)


def _totals(encoded: DataFrame, centroids: np.ndarray) -> dict[tuple[int, int], int]:
    step = partial(_round, centroids=centroids)
    rows = (encoded.select("widths", "sizes", "entries", "codes").mapInArrow(step, "cluster int, place int, value decimal(38,0)")
            .groupBy("cluster", "place").agg(F.sum("value").alias("value")).collect())  # k * (dimensions + 2) rows
    return {(r["cluster"], r["place"]): int(r["value"]) for r in rows}


def centroid_clusters(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", dimensions: int = 64, clusters: int = 8,
                      rounds: int = 10, scale: int = 1024, seed: str = "3", chunk_rows: int = 1 << 14, share: float = 0.5) -> DataFrame:
    """One row per kept vector: (id, cluster, distance, cluster_inertia, inertia, centroid_sha256).

    Kept are vectors of exactly ``dimensions`` components, none null or not finite, as whole numbers floor(scale * x); a number
    beyond 2**26 counts as 2**26. The first centroids are the ``clusters`` vectors whose ``seed:id`` has the smallest
    SHA-256 (equal ones by components; the text of a null id is empty); fewer vectors make fewer centroids. A round gives
    each vector to its nearest centroid (ties: the smaller number) and moves each centroid that has vectors to the
    componentwise floor of their mean. Then vectors are given once more to the last centroids. Repeated rows and null ids
    are clustered like any row; other columns are not read; without kept vectors there are no rows. An inertia beyond
    a 64-bit number is given as the largest.

    ``chunk_rows`` (at most 65,536) bounds what a task holds at once; a block's dictionary has at most ``share`` of its chunk's
    rows, or one component.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    if not 0 < chunk_rows <= 1 << 16:
        raise ValueError("chunk_rows must be between 1 and 65,536")
    spark, kind = vectors.sparkSession, vectors.schema[id_col].dataType.simpleString()
    numbers = integer_vectors(vectors, id_col, vector_col, dimensions, scale)
    stored = StructType.fromDDL(f"ids array<{kind}>, widths array<int>, sizes array<int>, entries binary, codes binary")
    path = scratch_path(spark, "vectors")
    numbers.mapInArrow(partial(_encode, rows=chunk_rows, dimensions=dimensions, share=share, schema=to_arrow_schema(stored)),
                       stored).write.parquet(path)
    encoded = spark.read.schema(stored).parquet(path)

    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    chosen = numbers.select("v", F.sha2(name, 256).alias("hash")).orderBy("hash", "v").limit(clusters).collect()
    centroids = np.array([r["v"] for r in chosen], np.int64).reshape(-1, dimensions)
    for _ in range(rounds if len(centroids) else 0):
        totals, last = _totals(encoded, centroids), centroids
        centroids = np.array([[totals[c, i] // totals[c, COUNT] for i in range(dimensions)] if totals[c, COUNT] else old
                              for c, old in enumerate(centroids.tolist())], np.int64)
        if (centroids == last).all():
            break  # further rounds would change nothing
    totals = _totals(encoded, centroids) if len(centroids) else {}
    largest = 2 ** 63 - 1
    everything = min(largest, sum(totals[c, INERTIA] for c in range(len(centroids))))
    of_cluster = [(min(largest, totals[c, INERTIA]), everything, hashlib.sha256(",".join(map(str, v)).encode()).hexdigest())
                  for c, v in enumerate(centroids.tolist())]
    result = StructType.fromDDL(f"id {kind}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    step = partial(_assign, centroids=centroids, of_cluster=of_cluster, schema=to_arrow_schema(result))
    return encoded.mapInArrow(step, result).withColumnRenamed("id", id_col)
