"""Toxic passages by maximum-scoring segments.

Each token gets a log-odds score, toxic against clean, learned from labelled rows with Dirichlet priors; all maximal
scoring segments of a text are found in one linear scan; extreme-value statistics (Karlin-Altschul) turn a segment's
score into the number of equally good segments that clean text of that length would hold by chance, and a
one-dimensional logistic fit on rows that taught no token score turns their sum into a probability.

Only the text and the training labels are read. Tokens are words and word beginnings, counted once per document, so a
document that repeats itself counts once. The model's size is bounded by ``lexicon_size``.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import stable

from .common import fold_of, lowest_hashes, whole_text

WORD = re.compile(r"\w+")
#: Lengths of the word beginnings that are tokens of their own: they catch inflected forms not seen in training.
STEMS = (5, 6, 7, 8)
FLUSH = 400_000


@dataclass
class ToxicityModel:
    """token -> log-odds (beginnings are written ``stem*``), and the calibration."""
    odds: dict[str, float] = field(default_factory=dict)
    neutral: float = -1.0      # score of a token without evidence
    decay: float = 1.0         # lambda of the extreme-value law
    density: float = 0.01      # K of the extreme-value law
    intercept: float = -2.0    # logistic fit
    slope: float = 0.0
    significance: float = 0.01  # expected number of chance segments below which a passage is reported

    def chance(self, n: int, score: float) -> float:
        """Segments of ``score`` or more expected by chance in clean text of ``n`` words, which counts as one place at least."""
        return (self.density * n + 1) * math.exp(max(-600.0, -self.decay * score))


def _tokens(word: str) -> list[str]:
    return [word, *(f"{word[:n]}*" for n in STEMS if len(word) >= n)]


def _count_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(token, toxic, clean): in how many labelled rows a token stands, partly summed; flushed at a bounded size."""
    sides = (Counter(), Counter())

    def flush() -> pa.RecordBatch:
        names = list(sides[0].keys() | sides[1].keys())
        out = pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([sides[1][x] for x in names], pa.int64()),
                                          pa.array([sides[0][x] for x in names], pa.int64())], names=["token", "toxic", "clean"])
        sides[0].clear(), sides[1].clear()
        return out

    for batch in batches:
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
            sides[toxic].update({t for w in set(WORD.findall(text.lower())) for t in _tokens(w)})
            if len(sides[0]) + len(sides[1]) > FLUSH:
                yield flush()
    yield flush()


def _token_score(word: str, odds: dict[str, float], neutral: float) -> float:
    """The word's own log-odds, else that of its longest known beginning, else the neutral score."""
    if word in odds:
        return odds[word]
    for n in reversed(STEMS):
        if len(word) >= n and (s := odds.get(f"{word[:n]}*")) is not None:
            return s
    return neutral


def maximal_segments(scores: list[tuple[int, float]], neutral: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first, last, score) of a token sequence, in linear time (Ruzzo and Tompa).

    ``scores`` holds (position, score) of the tokens that do not score ``neutral`` (negative), in order.
    """
    stack: list[tuple[float, float, int, int]] = []  # (sum before, sum after, first, last)
    total, at = 0.0, -1
    for place, score in scores:
        before = total + (place - at - 1) * neutral
        total, at = before + score, place
        if score <= 0:
            continue
        left, right, first = before, total, place
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][0] >= left:
                j -= 1
            if j < 0 or stack[j][1] >= right:
                stack.append((left, right, first, place))
                break
            left, first = stack[j][0], stack[j][2]
            del stack[j:]
    return [(first, last, after - before) for before, after, first, last in stack]


class _Scorer:
    """Scores texts one by one, remembering word scores (a bounded number of them)."""

    def __init__(self, model: ToxicityModel):
        self.model, self.seen = model, {}

    def segments(self, text: str) -> tuple[int, list[tuple[int, int, float]]]:
        words, seen, model, hits = WORD.findall(text.lower()), self.seen, self.model, []
        if len(seen) > 500_000:
            seen.clear()
        for i, word in enumerate(words):
            score = seen.get(word)
            if score is None:
                score = seen[word] = _token_score(word, model.odds, model.neutral)
            if score != model.neutral:
                hits.append((i, score))
        return len(words), maximal_segments(hits, model.neutral)

    def evidence(self, n: int, segments: list[tuple[int, int, float]]) -> float:
        """log of summed exp(lambda S) over all segments, against the chance level K n + 1; zero without any segment."""
        if not segments:
            return 0.0
        top = max(s for _, _, s in segments)
        summed = sum(math.exp(self.model.decay * (s - top)) for _, _, s in segments)
        return max(0.0, math.log(summed) - math.log(self.model.chance(n, top)))

    def probability(self, evidence: float) -> float:
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, self.model.intercept + self.model.slope * evidence))))


def _score_bins(batches: Iterator[pa.RecordBatch], model: ToxicityModel) -> Iterator[pa.RecordBatch]:
    """Bounded summaries of labelled rows. kind 0: counts of token scores in clean rows (bins of 1/8);
    kind 1: counts of segment scores in clean rows (bins of 1/4)."""
    scorer, sums = _Scorer(model), Counter()
    for batch in batches:
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
            if toxic:
                continue
            for word in WORD.findall(text.lower()):
                sums[0, round(8 * _token_score(word, model.odds, model.neutral))] += 1
            for _, _, s in scorer.segments(text)[1]:
                sums[1, math.floor(4 * s)] += 1
    keys = sorted(sums)
    yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in keys], pa.int32()), pa.array([b for _, b in keys], pa.int32()),
                                      pa.array([sums[k] for k in keys], pa.int64())], names=["kind", "bin", "n"])


def _evidence_bins(batches: Iterator[pa.RecordBatch], model: ToxicityModel) -> Iterator[pa.RecordBatch]:
    """Counts of rows by (evidence in bins of 1/4, at most 400 of them, label)."""
    scorer, sums = _Scorer(model), Counter()
    for batch in batches:
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
            sums[toxic, min(400, round(4 * scorer.evidence(*scorer.segments(text))))] += 1
    keys = sorted(sums)
    yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in keys], pa.int32()), pa.array([b for _, b in keys], pa.int32()),
                                      pa.array([sums[k] for k in keys], pa.int64())], names=["kind", "bin", "n"])


def _binned(df: DataFrame, step, model: ToxicityModel) -> list[tuple[int, int, int]]:
    rows = df.mapInArrow(partial(step, model=model), "kind int, bin int, n long").groupBy("kind", "bin").agg(F.sum("n").alias("n"))
    return [tuple(r) for r in rows.collect()]  # a few thousand bins at most


def _decay(bins: dict[float, int]) -> float:
    """lambda > 0 with sum p(s) exp(lambda s) = 1 over clean tokens' scores; needs a negative mean."""
    total = sum(bins.values())
    grow = lambda x: sum(n / total * math.exp(min(60.0, x * s)) for s, n in bins.items()) - 1
    if not total or not any(s > 0 for s in bins) or sum(s * n for s, n in bins.items()) >= 0:
        return 1.0
    low, high = 1e-3, 1e-3
    while grow(high) < 0 and high < 8:
        low, high = high, high * 2
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if grow(middle) < 0 else (low, middle)
    return min(low, 3.0)


def _logistic(bins: list[tuple[int, float, int]], penalty: tuple[float, float] = (1e-3, 0.05), start: tuple[float, float] = (0.0, 0.5),
              rounds: int = 200) -> tuple[float, float]:
    """(intercept, slope) of a logistic fit on (label, x, count) with a light penalty that draws to ``start``.

    The penalised loss is strictly convex; a Newton step is halved until the loss falls enough, so the fit cannot
    swing between two points. Raises where the gradient does not vanish.
    """
    y, x, n = (np.array(v, float) for v in zip(*bins, strict=True))
    design, scale, drawn = np.stack([np.ones_like(x), x], 1), np.array(penalty), np.array(start)

    def loss(beta: np.ndarray) -> float:
        z = design @ beta
        return float((n * (np.logaddexp(0, z) - y * z)).sum() + (scale * (beta - drawn) ** 2).sum() / 2)

    beta, now = drawn, loss(drawn)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -500, 500)))
        gradient = design.T @ (n * (p - y)) + scale * (beta - drawn)
        if np.abs(gradient).max() <= 1e-9 * (1 + n.sum()):
            return float(beta[0]), float(max(0.0, beta[1]))
        step = np.linalg.solve(design.T @ (design * (n * p * (1 - p))[:, None]) + np.diag(scale), -gradient)
        share = 1.0
        while (after := loss(beta + share * step)) > now + 1e-4 * share * float(gradient @ step) and share > 1e-12:
            share /= 2
        if after >= now:  # no step makes it smaller: as good as the numbers' precision allows
            if np.abs(gradient).max() <= 1e-6 * (1 + n.sum()):
                return float(beta[0]), float(max(0.0, beta[1]))
            break
        beta, now = beta + share * step, after
    raise RuntimeError("the calibration did not converge")


def _middle(counts: dict[float, int]) -> float:
    """The median of a histogram's values."""
    half, seen = sum(counts.values()) / 2, 0
    for value in sorted(counts):
        seen += counts[value]
        if seen >= half:
            return value
    raise ValueError("no values")


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          most_rows: int = 50_000, lexicon_size: int = 20_000, prior: float = 0.1, least_z: float = 3.0,
          least_odds: float = 1.5, least_rows: int = 3, held_out_fold: int | None = 0) -> ToxicityModel:
    """Learn a :class:`ToxicityModel` from labelled rows.

    At most ``most_rows`` labels are used (the ones whose ids hash lowest), so the label side of the join has a
    known size and is broadcast; rows of fold ``held_out_fold`` (crc32 of the id, modulo 5) are never used. Equal texts count as one row, labelled
    as at least half of them are (rows that repeat an id with its text count each). A fifth of the texts, by a digest, teaches the logistic fit, the others the token scores. ``prior`` is the Dirichlet prior's weight as a share of the labelled rows:
    each class gets that many rows that hold a token as often as all labelled rows do. A token enters the lexicon when
    ``least_rows`` toxic rows hold it, its log-odds reach ``least_odds`` and lie ``least_z`` standard errors above zero; ``lexicon_size`` bounds the lexicon (largest z first).
    Null labels, labels other than 0 and 1 and ids without a row are ignored; several labels of one id: the largest.
    Null texts are empty. Without labelled rows of both kinds the model knows no token and gives every text the same score.
    """
    label = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("toxic"))
             .where("id is not null and toxic in (0, 1)").groupBy("id").agg(F.max("toxic").alias("toxic"))
             .withColumn("fold", fold_of("id")))
    if held_out_fold is not None:
        label = label.where(F.col("fold") != held_out_fold)
    label = F.broadcast(lowest_hashes(label, "id", most_rows))
    texts = docs.select(F.col(id_col).alias("id"), whole_text(text_col).alias("text"))
    # a text counts once however many rows have it, and never on both sides of the calibration: digests choose a row, texts stay where they are
    rows = texts.join(label, "id").select("id", "toxic", F.md5("text").alias("key")).groupBy("key", "id").agg(F.count("*").alias("n"), F.max("toxic").alias("toxic"))
    chosen = stable(rows.groupBy("key").agg(F.min_by("id", F.struct("n", "id")).alias("id"), F.when(2 * F.sum(F.col("n") * F.col("toxic")) >= F.sum("n"), 1).otherwise(0)
                                            .alias("toxic")).withColumn("held", F.crc32("key") % 5 == 4))
    sides = {tuple(r[:2]): r[2] for r in chosen.groupBy("toxic", "held").count().collect()}
    n1, n0 = sides.get((1, False), 0), sides.get((0, False), 0)
    if not n1 or not n0:
        return ToxicityModel()
    few = F.broadcast(chosen) if sum(sides.values()) <= 2 * most_rows else chosen  # more only where ids have several texts each
    used = texts.join(few, "id").where(F.md5("text") == F.col("key"))
    teach, check = used.where(~F.col("held")).select("text", "toxic"), used.where("held").select("text", "toxic")

    weight = prior * (n1 + n0)
    rate = (F.col("toxic") + F.col("clean")) / F.lit(n1 + n0)
    a1, a0 = F.col("toxic") + weight * rate, F.col("clean") + weight * rate
    # a token of every row leaves no row without it
    b1 = F.greatest(F.lit(0.5), F.lit(n1) - F.col("toxic") + weight * (1 - rate))
    b0 = F.greatest(F.lit(0.5), F.lit(n0) - F.col("clean") + weight * (1 - rate))
    odds = F.log(a1 / b1) - F.log(a0 / b0)
    z = odds / F.sqrt(1 / a1 + 1 / a0)
    counts = (teach.mapInArrow(_count_tokens, "token string, toxic long, clean long")
              .groupBy("token").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")))
    known = (counts.where(F.col("toxic") >= least_rows).select("token", odds.alias("odds"), z.alias("z"))
             .where((F.col("z") >= least_z) & (F.col("odds") >= least_odds)).orderBy(F.desc("z"), "token").limit(lexicon_size))
    lexicon = {r["token"]: min(8.0, r["odds"]) for r in known.collect()}
    model = ToxicityModel(odds=lexicon)

    bins = _binned(teach, _score_bins, model)
    tokens = {b / 8: n for kind, b, n in bins if kind == 0}
    found = {b / 4: n for kind, b, n in bins if kind == 1}
    model.decay = _decay(tokens)
    # K: clean rows hold K n exp(-lambda t) segments of score t or more; read off at the median segment
    words, seen = sum(tokens.values()), sum(found.values())
    if words and seen:
        level = _middle(found)
        above = sum(n for s, n in found.items() if s >= level)
        model.density = min(1.0, max(1e-6, above / words * math.exp(model.decay * level)))
    rows = [(kind, b / 4, n) for kind, b, n in _binned(check, _evidence_bins, model)]
    if {k for k, _, _ in rows} == {0, 1}:
        model.intercept, model.slope = _logistic(rows)
    else:
        model.intercept, model.slope = math.log(n1 / (n0 + 1)), 1.0
    return model


def score_column(model: ToxicityModel, text: str = "text"):
    """Probability that a text is toxic, as a column; null is scored as empty."""
    @F.pandas_udf("double")
    def run(texts: pd.Series) -> pd.Series:
        scorer = _Scorer(model)
        return pd.Series([scorer.probability(scorer.evidence(*scorer.segments(x))) for x in texts], dtype="float64")

    return run(whole_text(text))


def _passages(batches: Iterator[pa.RecordBatch], model: ToxicityModel, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    scorer = _Scorer(model)
    for batch in batches:
        out = []
        for key, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist(), strict=True):
            n, segments = scorer.segments(text)
            passages = []
            for first, last, s in segments:
                chance = model.chance(n, s)
                if chance <= model.significance:
                    passages.append({"first_word": first, "last_word": last, "log_odds": s, "chance": chance})
            evidence = scorer.evidence(n, segments)
            out.append({"id": key, "n_words": n, "evidence": evidence, "score": scorer.probability(evidence), "passages": passages})
        yield pa.RecordBatch.from_pylist(out, schema=schema)


def toxic_passages(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: (id, n_words, evidence, score, passages).

    ``passages`` lists every significant segment in order: first and last word (from 0), summed log-odds, and the
    number of such segments expected by chance. Null and empty texts have no words and no passages and get the score
    of no evidence. Null ids and repeated rows are scored like any row. Other columns are not read.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = (f"id {kind}, n_words long, evidence double, score double, "
              "passages array<struct<first_word: long, last_word: long, log_odds: double, chance: double>>")
    arrow = to_arrow_schema(StructType.fromDDL(schema))
    return (docs.select(F.col(id_col).alias("id"), whole_text(text_col).alias("text"))
            .mapInArrow(partial(_passages, model=model, schema=arrow), schema).withColumnRenamed("id", id_col))
