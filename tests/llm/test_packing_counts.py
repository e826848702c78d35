import zlib

import numpy as np
import public_tokenizers
import pytest
from helpers import TEXTS, awkward, nothing, rows_of
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import packing, token_counts

WORDS, BYTES = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")


def test_pieces_hold_every_id_once(spark):
    library = Tokenizer.from_file(WORDS)
    docs = awkward(spark, [r for r in TEXTS if r != (8, TEXTS[7][1])] + [TEXTS[7]])
    got = rows_of(packing.pack(docs, WORDS).withColumn("crc", F.crc32("ids")))
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append(r)
    for key, text in TEXTS:
        if key is None:
            continue
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        at = 0
        for r in sorted(by[key], key=lambda r: r["start"]):
            assert (r["start"], r["doc_tokens"]) == (at, len(ids))
            assert r["crc"] == zlib.crc32(ids[at:at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
    check_sequences(got, 2048, 64)
    assert packing.pack(nothing(spark), WORDS).count() == 0


def check_sequences(rows, tokens, segments):
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append(r)
    for pieces in sequences.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p["offset"]):
            assert p["offset"] == at and p["length"] > 0
            at += p["length"]
        assert at <= tokens and len(pieces) <= segments
        assert at == tokens or at & (at - 1) == 0, "a sequence that is not full has a power of two tokens"
    return sequences


def test_three_limits_hold_at_once(spark):
    texts = spark.range(400).select(F.col("id").alias("doc_id"), F.repeat(F.lit("word "), (F.col("id") % 90).cast("int")).alias("text"),
                                    (F.col("id") % 40).alias("prompt"))
    rows = rows_of(packing.pack(texts, WORDS, prompt_col="prompt", tokens=128, segments=4, loss_tokens=70, pool=32))
    assert sum(r["length"] for r in rows) == sum(i % 90 + 1 for i in range(400))
    for pieces in check_sequences(rows, 128, 4).values():
        loss = 0
        for p in pieces:
            first = min(p["doc_tokens"], p["doc_id"] % 40)
            loss += max(0, p["start"] + p["length"] - max(first, p["start"]))
        assert loss <= 70


def test_token_counts_match_the_library(spark):
    library = Tokenizer.from_file(BYTES)
    for heads in (1 << 18, 3):  # 3: nearly all pre-tokens go through the join
        got = sorted(((r["doc_id"] or -1, r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in rows_of(token_counts.token_counts(awkward(spark), BYTES, heads=heads))))
        want = []
        for key, text in TEXTS:
            n = len(library.encode(text or "", add_special_tokens=False).ids)
            want.append((key or -1, len((text or "").encode()), n, n > 512))
        assert got == sorted(want)
    assert token_counts.token_counts(nothing(spark), BYTES).count() == 0


@pytest.mark.parametrize("text", ["a  <|endoftext|> b\n\n<|endoftext|><|endoftext|>", "x \n y\t\tz  \n", "''s 's'''t I'll 'LL", "12a½²x ªº x_y--z",
                                  "foo\x1cbar\x85x\xa0\xa0y ﬁ", "\x00\x01 a\x1fb \x00row1", "é é é 日本 語", "  ", "\n"])
def test_pre_tokens_and_ids_of_odd_texts(text):
    pieces, ids = token_counts._Pieces(BYTES), packing._Ids(WORDS)
    found, special = pieces.split(text)
    assert special + sum(n * k for n, k in zip(found.values(), pieces.count(list(found)), strict=True)) == len(pieces.library.encode(text, add_special_tokens=False).ids)
    assert ids.batch([text])[0] == np.array(ids.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
