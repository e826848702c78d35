"""Token counts without token ids.

A byte-level BPE never joins across pre-tokens, so a text's token count is the sum over its pre-tokens. The pieces of every
distinct pre-token of the corpus are counted once; per-document pre-token frequencies are joined to those counts and summed.
The most frequent pre-tokens (at most ``heads``, none over 64 bytes, so their size is bounded) hold nearly all
occurrences; their counts are broadcast and joined in the map task, the others meet in a shuffle join.
"""

from __future__ import annotations

import os
import re
from collections import Counter
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import stable

from .common import frequent, latin_class, whole_text

FLUSH = 300_000
LONGEST_HEAD = 64


def plain_pattern() -> re.Pattern:
    """The vocabulary's pre-token pattern for texts of characters below U+0250, with its classes written out."""
    letter, number, space = latin_class("L"), latin_class("N"), "\t\n\x0b\x0c\r \x85\xa0"
    return re.compile(f"'s|'t|'re|'ve|'m|'ll|'d| ?[{letter}]+| ?[{number}]+| ?[^{space}{letter}{number}]+|[{space}]+(?![^{space}])|[{space}]+")


class _Pieces:
    """Pre-tokens of a text, and the number of pieces of a pre-token."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.pattern, self.unusual = plain_pattern(), re.compile("[^\x00-ɏ]")
        self.special = re.compile("|".join(re.escape(t.content) for t in self.library.get_added_tokens_decoder().values()) or "(?!)")

    def split(self, text: str) -> tuple[Counter, int]:
        """(frequencies of the pre-tokens, number of special tokens)."""
        parts, found = self.special.split(text), Counter()
        for part in parts:
            if self.unusual.search(part):
                found.update(part[i:j] for _, (i, j) in self.library.pre_tokenizer.pre_tokenize_str(part))
            else:
                found.update(self.pattern.findall(part))
        return found, len(parts) - 1

    def count(self, tokens: list[str]) -> list[int]:
        return [len(e.ids) for e in self.library.encode_batch_fast(tokens, add_special_tokens=False)]


def _frequencies(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    """(piece, n): occurrences of pre-tokens, partly summed; flushed at a bounded size."""
    pieces, total = _Pieces(path), Counter()

    def flush() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], names=["piece", "n"])
        total.clear()
        return out

    for batch in batches:
        for text in batch.column("text").to_pylist():
            total.update(pieces.split(text)[0])
            if len(total) > FLUSH:
                yield flush()
    yield flush()


def _lengths(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    """Adds the number of pieces to distinct pre-tokens."""
    pieces = _Pieces(path)
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column("piece"), batch.column("n"), pa.array(pieces.count(batch.column("piece").to_pylist()), pa.int64())],
                                         names=["piece", "n", "pieces"])


def _terms(batches: Iterator[pa.RecordBatch], path: str, heads, kind: pa.DataType) -> Iterator[pa.RecordBatch]:
    """For each text one row with what the heads and special tokens give, and a row for each other pre-token.

    The first kind's ``piece`` is no pre-token (a control sign and a letter never stand in one) and differs by row.
    """
    pieces, known = _Pieces(path), heads.value
    names = ["row", "id", "n_bytes", "base", "piece", "n"]
    kinds = [pa.int64(), kind, pa.int64(), pa.int64(), pa.string(), pa.int64()]
    for batch in batches:
        out = [[] for _ in names]

        def flush(out=out):
            made = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds, strict=True)], names=names)
            for c in out:
                c.clear()
            return made

        for row, key, text in zip(*(batch.column(c).to_pylist() for c in ("row", "id", "text")), strict=True):
            found, special = pieces.split(text)
            rare = [(p, n) for p, n in found.items() if p not in known]
            base = special + sum(known[p] * n for p, n in found.items() if p in known)
            n = 1 + len(rare)
            for column, values in zip(out, ([row] * n, [key] + [None] * (n - 1), [len(text.encode())] + [None] * (n - 1), [base] + [0] * (n - 1),
                                            [f"\x00row{row}", *(p for p, _ in rare)], [0, *(n for _, n in rare)]), strict=True):
                column.extend(values)
            if len(out[0]) > 100_000:
                yield flush()
        yield flush()


def token_counts(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 512,
                 heads: int = 1 << 18) -> DataFrame:
    """One row per input row: (id, n_bytes, n_tokens, over_limit).

    Counts are those of the library's encoding without added begin or end tokens; special strings in a text are single
    tokens, as is its default. Null texts are empty: no bytes, no tokens. Null ids and repeated rows are counted
    like any row (rows are told apart by a row number, not by id); other columns are not read; an empty table gives no rows.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    kind = docs.schema[id_col].dataType
    texts = docs.select(whole_text(text_col).alias("text"))
    distinct = (texts.mapInArrow(partial(_frequencies, path=tokenizer), "piece string, n long")
                .groupBy("piece").agg(F.sum("n").alias("n")))
    counted = stable(distinct.mapInArrow(partial(_lengths, path=tokenizer), "piece string, n long, pieces long"))
    head = frequent(counted.where(F.octet_length("piece") <= LONGEST_HEAD), "n", heads)
    known = docs.sparkSession.sparkContext.broadcast({r[0]: r[1] for r in head.select("piece", "pieces").collect()})
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), whole_text(text_col).alias("text"))
    terms = rows.mapInArrow(partial(_terms, path=tokenizer, heads=known, kind=to_arrow_type(kind)),
                            f"row long, id {kind.simpleString()}, n_bytes long, base long, piece string, n long")
    summed = terms.join(counted.select("piece", "pieces"), "piece", "left").groupBy("row").agg(
        F.max("id").alias(id_col), F.max("n_bytes").alias("n_bytes"),
        F.sum(F.col("base") + F.col("n") * F.coalesce("pieces", F.lit(0))).alias("n_tokens"))
    return summed.select(id_col, "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
