"""Packing of tokenised texts by vector bin packing.

A sequence has three limits at once: tokens, segments and loss-bearing tokens. Each map task fills one sequence after
another from a bounded pool of pieces: of those that still fit, the one with the largest dot product of its
demand and the sequence's free capacity goes in next (Panigrahy and others, 2011), both in units of the limits. If none
fits, one is cut to fill the gap. A sequence that other limits stop early is trimmed to a power of two, the sizes
that need no padding, so nothing is padded.

Texts are packed where they are read, without a shuffle; memory is bounded by the pool and the longest text.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import latin_class, whole_text

#: Texts with other characters, or with a special token's brackets, take the library's own path as a whole.
UNUSUAL = re.compile("[^\x00-\x1b\x20-ɏ]|<\\|")
REMEMBER = 800_000


class _Ids:
    """Token ids of a text as little-endian unsigned 32-bit bytes.

    The vocabulary's pre-tokens never span white space and the normaliser works character by character below
    U+0250, so words between white space are cut into pre-tokens, and both are remembered (a bounded number of them).
    Many unknown pre-tokens are encoded in one call, with blanks between; each ends at an id that closes a word.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library, self.known = Tokenizer.from_file(path), {}
        vocabulary = self.library.get_vocab()
        self.closes = np.zeros(max(vocabulary.values()) + 1, bool)
        self.closes[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        letter, number = latin_class("L"), latin_class("N")
        self.piece = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{letter}]+|[{number}]|[^{letter}{number}]+")

    def _whole(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _learn(self, pieces: list[str], at_once: int = 500) -> None:
        for at in range(0, len(pieces), 50 * at_once):
            groups = [pieces[i:i + at_once] for i in range(at, min(at + 50 * at_once, len(pieces)), at_once)]
            for group, encoded in zip(groups, self.library.encode_batch_fast([" ".join(g) for g in groups], add_special_tokens=False), strict=True):
                ids = np.array(encoded.ids, "<u4")
                data, ends = ids.tobytes(), (4 * np.flatnonzero(self.closes[ids]) + 4).tolist()
                if len(ends) == len(group):
                    self.known.update(zip(group, [data[i:j] for i, j in zip([0, *ends], ends, strict=False)], strict=True))
                else:
                    self.known.update((p, self._whole(p)) for p in group)

    def batch(self, texts: list[str]) -> list[bytes]:
        plain = [None if UNUSUAL.search(x) else x.lower().split() for x in texts]
        known = self.known
        if len(known) > REMEMBER:
            known.clear()
        found = [None if words is None else list(map(known.get, words)) for words in plain]
        lacking = [(words, ids, [j for j, x in enumerate(ids) if x is None]) for words, ids in zip(plain, found, strict=True) if ids and None in ids]
        new = {words[j] for words, _, places in lacking for j in places}
        mixed = {w: self.piece.findall(w) for w in new if not w.isalpha()}
        self._learn(list({p for pieces in mixed.values() for p in pieces if p not in known} | {w for w in new if w not in mixed}))
        known.update((w, b"".join(map(known.__getitem__, pieces))) for w, pieces in mixed.items() if len(pieces) > 1)
        for words, ids, places in lacking:
            for j in places:
                ids[j] = known[words[j]]
        return [self._whole(x) if ids is None else b"".join(ids) for x, ids in zip(texts, found, strict=True)]


class _Packer:
    """Fills sequences one after another. A piece in the pool is [row, start, length]; ``put`` gets each placed piece."""

    def __init__(self, put, tokens: int, segments: int, loss: int, pool: int):
        self.put, self.limits, self.pool_size = put, np.array([tokens, segments, loss], float), pool
        self.sequence, self.rows = 0, []
        self.sizes = np.zeros((pool + 1, 4), np.int64)  # of the waiting pieces: start, tokens, segments, loss

    @property
    def size(self) -> np.ndarray:
        return self.sizes[:len(self.rows)]

    @staticmethod
    def _loss(start, length, whole, loss):
        """Loss-bearing tokens stand at the end of an example."""
        return max(0, min(length, start + length - (whole - loss)))

    def add(self, row, whole: int, loss: int) -> None:
        """Full-length pieces are sequences of their own; the rest waits in the pool."""
        tokens, start = int(self.limits[0]), 0
        while whole - start >= tokens and self._loss(start, tokens, whole, loss) <= self.limits[2]:
            self._emit([(row, start, tokens)])
            start += tokens
        if whole > start:
            self.sizes[len(self.rows)] = start, whole - start, 1, self._loss(start, whole - start, whole, loss)
            self.rows.append((row, whole, loss))
        if len(self.rows) >= self.pool_size:
            self.drain(self.pool_size // 2)

    def _emit(self, pieces: list[tuple]) -> None:
        offset = 0
        for row, start, length in pieces:
            self.put(row, start, length, self.sequence, offset)
            offset += length
        self.sequence += 1

    def _cut(self, at: int, room: np.ndarray) -> int:
        """How many tokens of pooled piece ``at`` fit into ``room``; loss-bearing tokens come last in an example."""
        start, length = self.size[at, :2]
        _, whole, loss = self.rows[at]
        free = max(0, whole - loss - start)  # tokens before the loss-bearing ones
        return int(min(room[0], length, free + room[2])) if room[1] >= 1 else 0

    def drain(self, leave: int) -> None:
        """Close sequences until at most ``leave`` pieces wait."""
        while len(self.rows) > leave:
            room, placed, waiting = self.limits.copy(), [], np.ones(len(self.rows), bool)
            while True:
                fits = np.flatnonzero(waiting & (self.size[:, 1:] <= room).all(1))
                if not len(fits) or room[0] < 1:
                    break
                best = int(fits[np.argmax((self.size[fits, 1:] / self.limits) @ (room / self.limits))])
                room -= self.size[best, 1:]
                waiting[best] = False
                placed.append((best, int(self.size[best, 1])))
            if room[0] >= 1 and room[1] >= 1 and waiting.any():
                left = np.flatnonzero(waiting)
                best = int(left[np.argmax(self.size[left, 1])])
                if n := self._cut(best, room):
                    placed.append((best, n))
                    room[0] -= n
            self._close(placed, int(self.limits[0] - room[0]))

    def _close(self, placed: list[tuple[int, int]], total: int) -> None:
        if total < self.limits[0]:
            total = 1 << (total.bit_length() - 1)
        pieces, keep = [], np.ones(len(self.rows), bool)
        for at, n in placed:
            n = min(n, total)
            if not n:
                break
            total -= n
            row, whole, loss = self.rows[at]
            start, length = map(int, self.size[at, :2])
            pieces.append((row, start, n))
            keep[at] = n < length
            self.size[at] = start + n, length - n, 1, self._loss(start + n, length - n, whole, loss)
        self._emit(pieces)
        left = self.size[keep]
        self.rows = [r for r, k in zip(self.rows, keep, strict=True) if k]
        self.sizes[:len(left)] = left


def _pack_partition(batches: Iterator[pa.RecordBatch], path: str, end: int, limits: tuple, pool: int, schema: pa.Schema
                    ) -> Iterator[pa.RecordBatch]:
    ids, out, base = _Ids(path), [], TaskContext.get().partitionId() << 40
    closing = np.array([end], "<u4").tobytes()

    def put(row, start, length, sequence, offset):
        key, data = row
        out.append((key, start, length, len(data) // 4, base + sequence, offset, data[4 * start:4 * (start + length)]))

    def flush():
        columns = list(zip(*out, strict=True)) or [[]] * len(schema)
        batch = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
        out.clear()
        return batch

    packer = _Packer(put, *limits, pool)
    for batch in batches:
        for at in range(0, batch.num_rows, 200):
            part = batch.slice(at, 200)
            for key, data, share in zip(part.column("id").to_pylist(), ids.batch(part.column("text").to_pylist()),
                                        part.column("prompt").to_pylist(), strict=True):
                data += closing
                n = len(data) // 4
                packer.add((key, data), n, n - min(n, max(0, share or 0)))
            if len(out) > 5000:
                yield flush()
    packer.drain(0)
    yield flush()


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", prompt_col: str | None = None,
         end_id: int = 1, tokens: int = 2048, segments: int = 64, loss_tokens: int = 2048, pool: int = 512) -> DataFrame:
    """Pieces of tokenised texts, placed in sequences: (id, start, length, doc_tokens, sequence_id, offset, ids).

    ``ids`` holds the piece's token ids as little-endian unsigned 32-bit bytes; ``start`` counts from the text's
    first id, ``offset`` from the sequence's first, without gaps. Every text's ids, followed by ``end_id``, lie in exactly one
    piece each. ``prompt_col`` names a count of leading tokens that bear no loss (null or unset: none). Null and
    empty texts are the end id alone. Null ids and repeated rows are packed like any row; an empty table gives no
    pieces; other columns are not read. Sequence ids are unique across tasks and the same when a task runs again.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"
    arrow = to_arrow_schema(StructType.fromDDL(schema))
    prompt = F.col(prompt_col).cast("long") if prompt_col else F.lit(0).cast("long")
    rows = docs.select(F.col(id_col).alias("id"), whole_text(text_col).alias("text"), prompt.alias("prompt"))
    step = partial(_pack_partition, path=tokenizer, end=end_id, limits=(tokens, segments, loss_tokens), pool=pool, schema=arrow)
    return rows.mapInArrow(step, schema).withColumnRenamed("id", id_col)
