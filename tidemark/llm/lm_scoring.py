"""Cross-entropy difference (Moore and Lewis, 2010) with two matched bigram models.

A target model and a background model share one vocabulary, one order and one smoothing, and the background counts are
scaled to the target's size, so their losses differ only by what the two corpora hold. For the word v after u

    p(v | u) = (c(u v) + mu p(v)) / (c(u) + mu),      p(v) = (c(v) + 1) / (N + V)

The score is the mean over a text's tokens of target loss minus background loss: low means target-like. Counts cover all
texts, and every bigram that occurs (``least_count`` above 1 would leave rarer ones to the unigrams). A text's sum is split in two: what
unigram and context counts give, from broadcast tables of vocabulary size, and a correction for each seen bigram.
The corrections of the most frequent bigrams (at most ``heads``) are broadcast, the others meet the texts' bigrams in a
shuffle join; the model as a whole grows with the corpus and is never in one place.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import stable

from .common import frequent, top, whole_text

WORD = re.compile(r"\w+")
FLUSH_WORDS, FLUSH_BIGRAMS = 300_000, 1 << 21


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, n), partly summed."""
    held = Counter()

    def flush():
        out = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])
        held.clear()
        return out

    for batch in batches:
        for text in batch.column("text").to_pylist():
            held.update(WORD.findall(text.lower()))
            if len(held) > FLUSH_WORDS:
                yield flush()
    yield flush()


def _bigrams(text: str, ids: dict[str, int], size: int) -> np.ndarray:
    """Context and word ids of all tokens as one number; id ``size`` is an unknown word, ``size + 1`` the start."""
    words = WORD.findall(text.lower())
    known = np.fromiter(map(ids.get, words, [size] * len(words)), np.int64, len(words))
    return np.concatenate(([size + 1], known[:-1])) * (size + 2) + known if len(words) else known


def _count_bigrams(batches: Iterator[pa.RecordBatch], ids) -> Iterator[pa.RecordBatch]:
    """(bigram, n, n_target), summed over blocks of a bounded number of tokens."""
    held, number, size = ([], []), 0, len(ids.value)

    def flush():
        every = np.concatenate([*held[0], *held[1], np.zeros(0, np.int64)])
        flag = np.repeat([0, 1], [sum(map(len, held[0])), sum(map(len, held[1]))])
        keys, place = np.unique(every, return_inverse=True)
        n = np.bincount(place, minlength=len(keys))
        target = np.bincount(place, flag, minlength=len(keys)).astype(np.int64)
        held[0].clear(), held[1].clear()
        return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n.astype(np.int64)), pa.array(target)], names=["bigram", "n", "n_target"])

    for batch in batches:
        for text, target in zip(batch.column("text").to_pylist(), batch.column("target").to_pylist(), strict=True):
            held[target].append(_bigrams(text, ids.value, size))
            number += len(held[target][-1])
            if number > FLUSH_BIGRAMS:
                yield flush()
                number = 0
    if number:
        yield flush()


def _terms(batches: Iterator[pa.RecordBatch], model, kind: pa.DataType) -> Iterator[pa.RecordBatch]:
    """For each text one row (negative ``bigram``, unlike any bigram) with its token count and what is known in the task,
    and a row for each of its other bigrams."""
    m, names = model.value, ["row", "id", "n_tokens", "base", "bigram", "n"]
    kinds = [pa.int64(), kind, pa.int64(), pa.float64(), pa.int64(), pa.int64()]
    size = len(m["ids"])
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            part = batch.slice(at, 500)
            row, key, tokens, base, bigram, number = [], [], [], [], [], []
            for r, k, text in zip(*(part.column(c).to_pylist() for c in ("row", "id", "text")), strict=True):
                every = _bigrams(text, m["ids"], size)
                pairs, n = np.unique(every, return_counts=True)
                context, word = pairs // (size + 2), pairs % (size + 2)
                total = float((n * (m["word"][word] - m["context"][context])).sum())
                if len(m["head"]) and len(pairs):
                    place = np.minimum(np.searchsorted(m["head"], pairs), len(m["head"]) - 1)
                    hit = m["head"][place] == pairs
                    total += float((n[hit] * m["head_delta"][place[hit]]).sum())
                    pairs, n = pairs[~hit], n[~hit]
                rest = len(pairs)
                row.append(np.full(rest + 1, r))
                key += [k] + [None] * rest
                tokens += [len(every)] + [None] * rest
                base += [total] + [0.0] * rest
                bigram += [np.array([-1 - r]), pairs]
                number += [np.array([0]), n]
            values = [np.concatenate(row), key, tokens, base, np.concatenate(bigram), np.concatenate(number)]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, kinds, strict=True)], names=names)


def cross_entropy_difference(docs: DataFrame, targets: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: int = 1 << 15,
                             mu: float = 50.0, least_count: int = 1, heads: int = 1 << 18) -> DataFrame:
    """One row per input row: (id, n_tokens, score), score = mean target loss minus mean background loss, in nats.

    ``targets`` names the target texts by id; all of them are used, so that side of the join grows with the input and
    is shuffled at every size. All texts are the background. ``vocabulary`` words (the most frequent, ties by
    word) and one unknown word make the shared vocabulary. Texts without words, null ones too, score 0; without any
    target text every score is 0. Null ids are never targets; repeated rows count and are scored like any row; repeated target
    ids count once; other columns are not read; an empty table gives no rows.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    kind, send = docs.schema[id_col].dataType, docs.sparkSession.sparkContext.broadcast
    texts = docs.select(F.col(id_col).alias("id"), whole_text(text_col).alias("text"))

    # the vocabulary is that of all texts, so it needs no join with the targets
    words = stable(texts.select("text").mapInArrow(_count_words, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")))
    chosen = top(words, "n", vocabulary, "word").collect()
    ids, size = {r["word"]: i for i, r in enumerate(chosen)}, len(chosen)

    # the targets grow with the input, so their join is the same at every size: by shuffle, never by broadcast
    target = targets.select(F.col(id_col).alias("id")).where("id is not null").distinct().withColumn("target", F.lit(1)).hint("merge")
    rows = texts.join(target, "id", "left").select("text", F.coalesce("target", F.lit(0)).alias("target"))
    every = stable(rows.mapInArrow(partial(_count_bigrams, ids=send(ids)), "bigram long, n long, n_target long").groupBy("bigram")
                   .agg(F.sum("n").alias("n"), F.sum("n_target").alias("n_target")))
    seen = every.where(F.col("n") >= least_count)

    # each token ends one bigram, so word counts are the bigrams' sums by their second word; a text's first token follows the start
    sums = [F.sum("n_target").alias("n_target"), F.sum("n").alias("n")]
    counts = np.zeros((size + 1, 2))  # target, background; the last is the unknown word
    for r in every.groupBy((F.col("bigram") % (size + 2)).alias("v")).agg(*sums).collect():  # at most a row per word of the vocabulary
        counts[r["v"]] = r["n_target"], r["n"]
    starts = [x or 0 for x in every.where(F.col("bigram") >= (size + 1) * (size + 2)).agg(*sums).first()]
    total_target, total = counts.sum(0)
    scale = float(total_target / total) if total else 0.0  # background counts at the target's size

    counts[:, 1] *= scale
    p = (counts + 1) / (counts.sum(0) + size + 1)
    # losses without bigram counts: log p(v) and the contexts' log((c + mu) / mu), target minus background
    word = np.append(-np.log(p[:, 0] / p[:, 1]), 0.0)
    contexts = np.vstack([counts, [starts[0], starts[1] * scale]])
    context = -np.log((contexts[:, 0] + mu) / (contexts[:, 1] + mu))

    of_word = docs.sparkSession.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(p)], "v int, pt double, pb double")
    delta = -(F.log1p(F.col("n_target") / (mu * F.col("pt"))) - F.log1p(F.col("n") * scale / (mu * F.col("pb"))))
    model = seen.withColumn("v", (F.col("bigram") % (size + 2)).cast("int")).join(F.broadcast(of_word), "v").select("bigram", "n", delta.alias("delta"))
    head = sorted(frequent(model, "n", heads).select("bigram", "delta").collect())
    known = send({"ids": ids, "word": word, "context": context, "head": np.array([r[0] for r in head], np.int64),
                  "head_delta": np.array([r[1] for r in head], float)})

    numbered = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), whole_text(text_col).alias("text"))
    terms = numbered.mapInArrow(partial(_terms, model=known, kind=to_arrow_type(kind)),
                                f"row long, id {kind.simpleString()}, n_tokens long, base double, bigram long, n long")
    summed = terms.join(model.select("bigram", "delta"), "bigram", "left").groupBy("row").agg(
        F.max("id").alias(id_col), F.max("n_tokens").alias("n_tokens"),
        F.sum(F.col("base") + F.col("n") * F.coalesce("delta", F.lit(0.0))).alias("sum"))
    score = F.when((F.col("n_tokens") == 0) | F.lit(bool(total_target == 0)), 0.0).otherwise(F.col("sum") / F.col("n_tokens"))
    return summed.select(id_col, "n_tokens", score.alias("score"))
