"""Benchmark decontamination: BM25 over an inverted index of test items, pruned by block maxima.

The test items are the index, every window of every text is a query. Impacts are divided by the item's own score, so one
threshold (a share of a full match) serves all items. Pruning is block-max WAND in its document-ordered form:
items are sorted by length into blocks; a window whose summed term maxima stay below the threshold has no pivot and
is dropped, then blocks whose summed block maxima stay below it are skipped, and only the items of live
blocks are scored. Nothing above the threshold is lost. Retrieved items are then verified: the words of the item's
question and of its answer must lie in word shingles that the text around the window shares with the item.

The index is cut into shards of at most ``shard_items`` parts of at most ``stride`` words, so a broadcast shard has a
fixed size bound; each further shard is another pass over the texts.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial, reduce
from types import SimpleNamespace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import whole_text

WORD = re.compile(r"\w+")
ANSWER = re.compile(r"(?i)\banswer\s*[:=]\s*")
SENTENCE = re.compile(r"(?<=[.!?])\s+")
K1, B = 1.2, 0.75


@dataclass
class Shard:
    """One broadcastable part of the index."""
    vocabulary: dict[str, int]
    item: list                 # item id of each indexed part
    question: list[list[str]]  # words, of the whole item
    answer: list[list[str]]
    impact: np.ndarray         # term x part, shares of the part's own score
    block_max: np.ndarray      # term x block
    term_max: np.ndarray       # term
    block: int


def question_and_answer(text: str) -> tuple[list[str], list[str]]:
    """Words of the question and of the answer: cut at the last "Answer:", else before the last sentence, else in half."""
    low = text.lower()
    marks = list(ANSWER.finditer(low))
    if marks and WORD.search(low, marks[-1].end()):
        return WORD.findall(low[:marks[-1].start()]), WORD.findall(low[marks[-1].end():])
    parts = [w for s in SENTENCE.split(low) if (w := WORD.findall(s))]
    if len(parts) > 1:
        return [w for p in parts[:-1] for w in p], parts[-1]
    words = parts[0] if parts else []
    return words[:(len(words) + 1) // 2], words[(len(words) + 1) // 2:]


def build_shard(items: list[tuple[object, str]], frequency: dict[str, int], total: int, mean: float, stride: int, block: int) -> Shard:
    parts = []
    for key, text in items:
        words = WORD.findall(text.lower())
        if words:
            q, a = question_and_answer(text)
            parts += [(key, words[i:i + stride], q, a) for i in range(0, len(words), stride)]
    parts.sort(key=lambda p: (len(p[1]), str(p[0])))
    vocabulary = {w: i for i, w in enumerate(sorted({w for p in parts for w in p[1]}))}
    impact = np.zeros((len(vocabulary), len(parts)), np.float32)
    for j, (_, words, _, _) in enumerate(parts):
        for w, tf in Counter(words).items():
            idf = math.log(1 + (total - frequency.get(w, 1) + 0.5) / (frequency.get(w, 1) + 0.5))
            impact[vocabulary[w], j] = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(words) / max(mean, 1)))
    impact /= np.maximum(impact.sum(0, keepdims=True), 1e-9)
    blocks = max(1, -(-len(parts) // block))
    block_max = np.stack([impact[:, i * block:(i + 1) * block].max(1, initial=0) for i in range(blocks)], 1)
    return Shard(vocabulary, [p[0] for p in parts], [p[2] for p in parts], [p[3] for p in parts], impact, block_max,
                 impact.max(1, initial=0), block)


def index_shards(items: DataFrame, id_col: str = "item_id", text_col: str = "text", stride: int = 64, block: int = 8,
                 shard_items: int = 512) -> Iterator[Shard]:
    """The index, shard by shard: only one shard's items and their terms' frequencies are on the driver at a time."""
    rows = items.select(F.col(id_col).alias("id"), whole_text(text_col).alias("text")).where("id is not null")
    # Python's \w: letters, numbers and the underscore of any script
    found = F.regexp_extract_all(F.lower("text"), F.lit(r"([\p{L}\p{N}_]+)"), F.lit(1))
    words = rows.select("id", F.explode(F.array_distinct(found)).alias("w"))
    frequency = words.groupBy("w").agg(F.count("*").alias("n"))
    total, n_words, n_parts = rows.select(F.size(found).alias("n")).agg(F.count("*"), F.sum("n"), F.sum(F.ceil(F.col("n") / stride))).first()
    if not total:
        return
    length = F.greatest(F.lit(1), F.ceil(F.length("text") / (2 * stride)))  # parts of an item, at most
    n_shards = rows.agg(F.ceil(F.sum(length) / shard_items)).first()[0]
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("id", "text"), F.lit(n_shards)))
    mean = n_words / max(n_parts, 1)  # words of a part
    for shard in range(n_shards):
        own = dealt.where(F.col("shard") == shard)
        pairs = [tuple(r) for r in own.select("id", "text").distinct().collect()]
        terms = words.join(own.select("id").distinct(), "id", "left_semi").select("w").distinct()
        counts = {r["w"]: r["n"] for r in frequency.join(terms, "w", "left_semi").collect()}
        yield build_shard(pairs, counts, total, mean, stride, block)


def _covered(part: list[str], grams: dict[int, set], width: int) -> float:
    """Share of ``part``'s words inside a shingle that the text has too; an empty part counts as covered."""
    width = min(width, len(part))
    if not width:
        return 1.0
    inside = np.zeros(len(part), bool)
    for i in range(len(part) - width + 1):
        if tuple(part[i:i + width]) in grams[width]:
            inside[i:i + width] = True
    return float(inside.mean())


class _Matcher:
    def __init__(self, shard: Shard | SimpleNamespace, share: float, question: float, answer: float, width: int, stride: int):
        self.shard, self.share, self.least, self.width, self.stride = shard, share, (question, answer), width, stride

    def retrieve(self, words: list[str]) -> dict[int, tuple[float, int]]:
        """part -> (best score, window) of all parts that reach the share in some window of two strides."""
        shard, size = self.shard, len(self.shard.vocabulary)
        ids = np.fromiter(map(shard.vocabulary.get, words, [-1] * len(words)), np.int64, len(words))
        known = np.flatnonzero(ids >= 0)
        if not len(known):
            return {}
        keys = np.unique(known // self.stride * size + ids[known])
        chunk, term = keys // size, keys % size
        first = np.flatnonzero(np.diff(chunk, prepend=-1))
        chunks, last = chunk[first], np.append(first[1:], len(keys))
        # a window is a chunk and the next one; without a next one, the chunk alone
        follows = np.append(chunks[1:] == chunks[:-1] + 1, False)
        top = np.add.reduceat(shard.term_max[term], first)
        pivot = np.flatnonzero(top + np.append(top[1:], 0) * follows >= self.share)
        found: dict[int, tuple[float, int]] = {}
        for i in pivot:
            terms = np.unique(term[first[i]:last[i + 1] if follows[i] else last[i]])
            if shard.term_max[terms].sum() < self.share:
                continue
            for b in np.flatnonzero(shard.block_max[terms].sum(0) >= self.share):
                scores = shard.impact[terms, b * shard.block:(b + 1) * shard.block].sum(0)
                for j in np.flatnonzero(scores >= self.share):
                    part, s = int(b * shard.block + j), float(scores[j])
                    if part not in found or s > found[part][0]:
                        found[part] = (s, int(chunks[i]))
        return found

    def leaks(self, text: str) -> list[tuple]:
        """(item, score, question overlap, answer overlap, first word of the window), one per verified item."""
        words = WORD.findall(text.lower())
        parts = self.retrieve(words)
        if not parts:
            return []
        shard, near = self.shard, defaultdict(list)
        for part, (score, chunk) in parts.items():
            near[shard.item[part]].append((score, chunk, part))
        out = []
        for item, hits in near.items():
            grams, question, answer = defaultdict(set), shard.question[hits[0][2]], shard.answer[hits[0][2]]
            reach = self.stride + len(question) + len(answer)
            widths = {min(self.width, len(p)) for p in (question, answer) if p}
            for _, chunk, _ in hits:
                at = max(0, chunk * self.stride - reach)
                around = words[at:(chunk + 1) * self.stride + reach]
                for w in widths:
                    grams[w].update(zip(*(around[k:] for k in range(w)), strict=False))
            q, a = _covered(question, grams, self.width), _covered(answer, grams, self.width)
            if q >= self.least[0] and a >= self.least[1]:
                score, chunk, _ = max(hits)
                out.append((item, score, q, a, chunk * self.stride))
        return out


def _find(batches: Iterator[pa.RecordBatch], shard, how: dict, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    matcher = _Matcher(SimpleNamespace(**shard.value), **how)
    for batch in batches:
        out = []
        for key, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist(), strict=True):
            out += [(key, *leak) for leak in matcher.leaks(text)]
        columns = list(zip(*out, strict=True)) or [[]] * len(schema)
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                 share: float = 0.6, question: float = 0.8, answer: float = 0.8, width: int = 5, stride: int = 64) -> DataFrame:
    """One row per text and leaked item: (id, item, score, question_overlap, answer_overlap, first_word).

    A window of two strides must reach ``share`` of the item's own BM25 score, and at least ``question`` / ``answer``
    of the words of the item's two halves must lie in shared ``width``-word shingles (shorter halves: the whole half). Items longer than a
    stride are indexed in parts. Null and empty texts leak nothing; null ids and repeated rows of texts are
    treated like any row; items with a null id or without words are ignored, repeated ones count once. Other columns are not
    read, so the item's text column may have any name that a text column has.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    kinds = docs.schema[id_col].dataType.simpleString(), items.schema[item_col].dataType.simpleString()
    schema = f"id {kinds[0]}, item {kinds[1]}, score double, question_overlap double, answer_overlap double, first_word long"
    arrow = to_arrow_schema(StructType.fromDDL(schema))
    how = {"share": share, "question": question, "answer": answer, "width": width, "stride": stride}
    rows = docs.select(F.col(id_col).alias("id"), whole_text(text_col).alias("text"))
    send = docs.sparkSession.sparkContext.broadcast
    found = [rows.mapInArrow(partial(_find, shard=send(vars(s)), how=how, schema=arrow), schema)
             for s in index_shards(items, item_col, text_col, stride)]
    out = reduce(DataFrame.unionByName, found) if found else docs.sparkSession.createDataFrame([], schema)
    return out.withColumnsRenamed({"id": id_col, "item": item_col})


def drop_contaminated(docs: DataFrame, items: DataFrame, text_col: str = "text", item_col: str = "item_id",
                      share: float = 0.6, question: float = 0.8, answer: float = 0.8, width: int = 5, stride: int = 64) -> DataFrame:
    """The rows of ``docs``, all columns, whose text leaks no item; defined as in :func:`contaminated`, in map tasks alone."""
    how = {"share": share, "question": question, "answer": answer, "width": width, "stride": stride}
    send = docs.sparkSession.sparkContext.broadcast
    for each in index_shards(items, item_col, text_col, stride):
        docs = docs.where(~_leaky(send(vars(each)), how)(whole_text(text_col)))
    return docs


def _leaky(shard, how: dict):
    @F.pandas_udf("boolean")
    def leaky(texts: pd.Series) -> pd.Series:
        matcher = _Matcher(SimpleNamespace(**shard.value), **how)
        return pd.Series([bool(matcher.leaks(x)) for x in texts], dtype=bool)

    return leaky
