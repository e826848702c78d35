"""Source divergence audit: how far the word use of a language's sources lies apart.

A CountVectorizer keeps, in each language, the terms that enough of its documents hold; every other limit on the vocabulary
is at its maximum. Its documents become exact sparse count vectors, which are summed per (language, source) over their stored
entries only. A group gives a kept term with ``count`` occurrences the smoothed share, in billionths,

    p = 1 + floor(10^9 * (count + 5) / (N + 5 V))

of its N counted terms and the language's V kept terms. Two sources are as far apart as the sum of their shares'
differences. Terms that neither has differ by the same small amount, so only stored entries are visited: those of up to ``TILE``
sources and ``BLOCK`` terms meet in one task, sources in more tiles meet tile by tile, and the blocks' sums are added.
All arithmetic is on integers.

One CountVectorizer serves all languages, since a term carries its language as a prefix; its vocabulary is held once by the
driver and once by each executor, as that estimator does. A kept term needs ``min_docs`` documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import scratch_path, stable

from .common import whole_text

WHOLE, SMOOTH = 1_000_000_000, 5
TILE, BLOCK = 64, 4096
HELD = 1 << 21  # stored entries a task sums at once
SPAN = 256  # terms whose sums of one group travel in one row


def share(count: str, total: str, terms: str) -> Column:
    """The smoothed share in billionths; decimals, since a count times 10^9 may pass 64 bits."""
    def wide(x: str) -> str:
        return f"cast({x} as decimal(19,0))"

    return F.expr(f"1 + cast({WHOLE} as decimal(10,0)) * {wide(f'{count} + {SMOOTH}')} div {wide(f'{total} + {SMOOTH} * {terms}')}")


_LOWER, _LETTER = np.arange(256, dtype=np.uint8), np.zeros(256, bool)
_LOWER[65:91] += 32
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True  # all bytes of a character beyond ASCII are 128 or more


def terms_of(texts: pa.Array, prefix: str, once: bool = False) -> pa.ListArray:
    """The terms of each text in order, A-Z lower-cased, each behind ``prefix``; bytes of all texts at once. ``once``: each different
    term of a text, in any order."""
    begin = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[begin[0]:begin[-1]]
    begin, head = begin - begin[0], np.frombuffer(prefix.encode(), np.uint8)
    letter = _LETTER[data]
    first = letter.copy()
    first[1:] &= ~letter[:-1]
    starts = begin[:-1][begin[:-1] < len(data)]
    first[starts] = letter[starts]  # the letters of two texts never join
    places = np.flatnonzero(letter)
    term = np.cumsum(first[places])  # of each letter, from 1
    at = np.flatnonzero(first[places])
    ends = np.concatenate(([0], np.cumsum(np.diff(np.append(at, len(places))) + len(head))))
    out = np.empty(ends[-1], np.uint8)
    out[np.arange(len(places)) + term * len(head)] = _LOWER[data[places]]
    for i, byte in enumerate(head):
        out[ends[:-1] + i] = byte
    owner = np.searchsorted(begin, places[at], "right") - 1
    words = pa.StringArray.from_buffers(len(at), pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(out))
    if once and len(words):
        coded = words.dictionary_encode()
        size = len(coded.dictionary)
        found = np.unique(owner * size + coded.indices.to_numpy())
        owner, words = found // size, coded.dictionary.take(pa.array(found % size))
    each = np.concatenate(([0], np.cumsum(np.bincount(owner, minlength=len(texts)))))
    return pa.ListArray.from_arrays(pa.array(each, pa.int32()), words)


def _tokens(batches: Iterator[pa.RecordBatch], once: bool = False, rows: int = 1000, most_bytes: int = 1 << 18) -> Iterator[pa.RecordBatch]:
    """(lang, source, tokens): every term of a text (``once``: every different one) behind its language and a zero character, which no term holds.

    Rows are taken by language, at most about ``most_bytes`` of text at once or one text.
    """
    for batch in batches:
        for lang in pc.unique(batch.column("lang")):
            own = batch.filter(pc.equal(batch.column("lang"), lang))
            sizes, at = np.cumsum(pc.binary_length(own.column("text")).to_numpy()), 0
            while at < own.num_rows:
                before = sizes[at - 1] if at else 0
                to = min(at + rows, max(at + 1, int(np.searchsorted(sizes, before + most_bytes, "right"))))
                part = own.slice(at, to - at)
                yield pa.RecordBatch.from_arrays([part.column("lang"), part.column("source"), terms_of(part.column("text"), f"{lang.as_py()}\0", once)],
                                                 names=["lang", "source", "tokens"])
                at = to


def _sum_vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, span, place, n): entries of sparse vectors summed by group; a bounded number of them is held. A row has those of
    ``SPAN`` neighbouring terms."""
    keys, values, groups, held = [], [], {}, 0

    def flush() -> Iterator[pa.RecordBatch]:
        found, place = np.unique(np.concatenate(keys), return_inverse=True)
        n = np.bincount(place, np.concatenate(values), len(found)).astype(np.int64)
        names = list(groups)
        lang, source = (pa.array([g[i] for g in names], pa.string()) for i in (0, 1))
        starts = np.flatnonzero(np.diff(found // SPAN, prepend=-1))  # of a group's terms of one span
        ends = np.append(starts, len(found))
        for at in range(0, len(starts), 5000):
            to = min(at + 5000, len(starts))
            low, high = ends[at], ends[to]
            first, offsets = found[starts[at:to]], pa.array((ends[at:to + 1] - low).astype(np.int32))
            group = pa.array(first >> 32)
            yield pa.RecordBatch.from_arrays([
                lang.take(group), source.take(group), pa.array(((first & 0xFFFFFFFF) // SPAN).astype(np.int32)),
                pa.ListArray.from_arrays(offsets, pa.array((found[low:high] % SPAN).astype(np.int32))),
                pa.ListArray.from_arrays(offsets, pa.array(n[low:high]))], names=["lang", "source", "span", "place", "n"])

    for batch in batches:
        lang, source = batch.column("lang").to_pylist(), batch.column("source").to_pylist()
        vectors = batch.column("vector")
        indices, counts = vectors.field("indices"), vectors.field("values")
        ends = np.asarray(indices.offsets)
        group = np.array([groups.setdefault(g, len(groups)) for g in zip(lang, source, strict=True)], np.int64)
        flat, amount = np.asarray(indices.values), np.asarray(counts.values)
        at = 0
        while at < len(group):  # at least a row, and rows up to the bound
            to = max(at + 1, int(np.searchsorted(ends, ends[at] + HELD, "right")) - 1)
            low, high = ends[at], ends[to]
            keys.append((np.repeat(group[at:to], np.diff(ends[at:to + 1])) << 32) | flat[low:high].astype(np.int64))
            values.append(amount[low:high])
            held += int(high - low)
            if held >= HELD:
                yield from flush()
                keys, values, held = [], [], 0
            at = to
    if held:
        yield from flush()


def _add_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, index, n): the sums of rows of ``_sum_vectors`` that come in order of (lang, source, span). A batch and one span are held."""
    last, carried = None, np.zeros(SPAN, np.int64)

    def entries(keys: list[tuple], sums: np.ndarray) -> pa.RecordBatch:
        row, place = np.nonzero(sums)
        lang, source, span = (pa.array([k[i] for k in keys], t) for i, t in enumerate((pa.string(), pa.string(), pa.int64())))
        of = pa.array(row)
        index = span.take(of).to_numpy() * SPAN + place
        return pa.RecordBatch.from_arrays([lang.take(of), source.take(of), pa.array(index.astype(np.int32)), pa.array(sums[row, place])],
                                          names=["lang", "source", "index", "n"])

    for batch in batches:
        if not batch.num_rows:
            continue
        names = list(zip(*(batch.column(c).to_pylist() for c in ("lang", "source", "span")), strict=True))
        keys, run = [], np.empty(len(names), np.int64)
        for i, key in enumerate(names):
            if not keys or key != keys[-1]:
                keys.append(key)
            run[i] = len(keys) - 1
        places, amounts = batch.column("place"), batch.column("n")
        at = np.repeat(run * SPAN, np.diff(places.offsets.to_numpy())) + places.flatten().to_numpy()
        sums = np.bincount(at, amounts.flatten().to_numpy(), len(keys) * SPAN).astype(np.int64).reshape(-1, SPAN)
        if last == keys[0]:
            sums[0] += carried
        elif last is not None:
            yield entries([last], carried[None])
        last, carried = keys[-1], sums[-1].copy()
        if len(keys) > 1:
            yield entries(keys[:-1], sums[:-1])
    if last is not None:
        yield entries([last], carried[None])


def _tile_pairs(frame: pd.DataFrame) -> pd.DataFrame:
    """Pairs of one tile of sources with another, over one block of terms: summed differences beyond those of two absent terms.

    Rows of ``index`` -1 list the tiles' sources with the share of an absent term; the others hold what a present one has above it.
    """
    i, j = int(frame["i"].iat[0]), int(frame["j"].iat[0])
    listed = frame["index"] < 0
    sources = frame[listed].sort_values("s")
    entries = frame[~listed]
    terms, column = np.unique(entries["index"].to_numpy(), return_inverse=True)
    names, absent = sources["s"].to_numpy(), sources["amount"].to_numpy()
    shares = np.repeat(absent[:, None], len(terms), 1)
    shares[np.searchsorted(names, entries["s"].to_numpy()), column] += entries["amount"].to_numpy()
    a, b, value = [], [], []
    for at in np.flatnonzero(names // TILE == i):
        other = np.flatnonzero((names // TILE == j) & (names > names[at]))
        apart = np.abs(shares[other] - shares[at]).sum(1) - np.abs(absent[other] - absent[at]) * len(terms)
        a.append(np.full(len(other), names[at]))
        b.append(names[other])
        value.append(apart)
    return pd.DataFrame({"lang": frame["lang"].iat[0], "a": np.concatenate(a), "b": np.concatenate(b), "more": np.concatenate(value)})


def _ranked(rows: DataFrame) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return rows.withColumn("rank", F.row_number().over(order))


def source_divergence(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", min_docs: int = 30,
                      top_terms: int = 50) -> DataFrame:
    """(lang, source, part, item, value, rank), for every (lang, source) that occurs.

    Part ``pair``: item is each other source of the language, value the summed differences of all kept terms' shares (0
    without kept terms). Part ``term``: item is each kept term of the group whose share is above the whole language's,
    value by how much, the ``top_terms`` first. Ranks start at 1 in each group and part, by falling value, then item in byte
    order. Terms are runs of A-Z, a-z and characters beyond ASCII, A-Z lower-cased. Nulls are empty texts: so they are languages
    and sources of that name, and texts without terms. Repeated rows count each time. Other columns are not read; an empty table
    gives no rows; a source alone in its language has no pairs.
    """
    spark = docs.sparkSession
    rows = docs.select(whole_text(lang_col).alias("lang"), whole_text(source_col).alias("source"), whole_text(text_col).alias("text"))
    kind = "lang string, source string, tokens array<string>"
    tokens = rows.mapInArrow(_tokens, kind)
    # minDF asks how many texts hold a term; how often each does only orders the vocabulary, which no result depends on
    held = rows.mapInArrow(partial(_tokens, once=True), kind).select("tokens")
    model = CountVectorizer(inputCol="tokens", outputCol="vector", minDF=float(min_docs), vocabSize=2 ** 31 - 1).fit(held)
    path = scratch_path(spark, "vocabulary")
    model.write().save(path)
    words = spark.read.parquet(f"{path}/data").select(F.posexplode("vocabulary").alias("index", "word"))
    words = words.select("index", F.regexp_extract("word", r"(?s)^(.*)\x00([^\x00]*)$", 1).alias("lang"), F.substring_index("word", "\0", -1).alias("term"))

    # a group's sums travel by spans of terms, so a group with most rows is dealt to as many tasks as it has spans
    key = ["lang", "source", "span"]
    spans = model.transform(tokens).select("lang", "source", "vector").mapInArrow(
        _sum_vectors, "lang string, source string, span int, place array<int>, n array<long>")
    sums = stable(spans.repartition(*key).sortWithinPartitions(*key).mapInArrow(_add_spans, "lang string, source string, index int, n long"))
    kept = words.groupBy("lang").agg(F.count("*").alias("terms"))
    totals = sums.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = (rows.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(kept, "lang", "left")
              .fillna(0, ["total", "terms"]))
    by_lang = Window.partitionBy("lang")
    groups = stable(groups.select(
        "*", (F.row_number().over(by_lang.orderBy("source")) - 1).cast("long").alias("s"), F.count("*").over(by_lang).alias("sources"),
        F.when(F.col("terms") > 0, share("0", "total", "terms")).otherwise(0).cast("long").alias("absent")))

    in_lang = sums.groupBy("lang", "index").agg(F.sum("n").alias("n_lang"))
    lang_total = groups.groupBy("lang").agg(F.sum("total").alias("lang_total"))
    entries = sums.join(groups, ["lang", "source"]).withColumn("p", share("n", "total", "terms"))
    above = (entries.join(in_lang, ["lang", "index"]).join(lang_total, "lang")
             .withColumn("value", F.col("p") - share("n_lang", "lang_total", "terms")).where("value > 0")
             .join(words.select("index", F.col("term").alias("item")), "index"))
    terms = _ranked(above.select("lang", "source", F.lit("term").alias("part"), "item", "value")).where(F.col("rank") <= top_terms)

    block = F.expr(f"index div {BLOCK}")
    blocks = words.select("lang", block.alias("block")).distinct()
    listed = groups.join(blocks, "lang").select("lang", "block", "s", "sources", F.lit(-1).alias("index"), F.col("absent").alias("amount"))
    held = entries.select("lang", block.alias("block"), "s", "sources", "index", (F.col("p") - F.col("absent")).alias("amount"))
    # every tile of sources meets itself and every other tile
    tile, other = F.expr(f"s div {TILE}"), F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(sources - 1) div {TILE}")))
    met = listed.unionByName(held).where("sources > 1").withColumn("tile", tile).withColumn("other", other).select(
        "lang", "block", F.least("tile", "other").alias("i"), F.greatest("tile", "other").alias("j"), "s", "index", "amount")
    more = (met.groupBy("lang", "block", "i", "j").applyInPandas(_tile_pairs, "lang string, a long, b long, more long")
            .groupBy("lang", "a", "b").agg(F.sum("more").alias("more")))
    left = groups.select("lang", "terms", F.col("s").alias("a"), F.col("source").alias("one"), F.col("absent").alias("absent_one"))
    right = groups.select("lang", F.col("s").alias("b"), F.col("source").alias("two"), F.col("absent").alias("absent_two"))
    value = F.col("terms") * F.abs(F.col("absent_one") - F.col("absent_two")) + F.coalesce("more", F.lit(0))
    pairs = left.join(right, "lang").where("a < b").join(more, ["lang", "a", "b"], "left").withColumn("value", value)
    both = F.explode(F.array(F.struct(F.col("one").alias("source"), F.col("two").alias("item")), F.struct(F.col("two").alias("source"), F.col("one").alias("item"))))
    pairs = pairs.select("lang", "value", both.alias("side")).select("lang", "side.source", F.lit("pair").alias("part"), "side.item", "value")
    return _ranked(pairs).unionByName(terms).withColumn("value", F.col("value").cast("long"))
