"""Awkward inputs every operator must take: nulls, empty and long texts, repeated rows, odd characters, clashing column names."""

from __future__ import annotations

LONG = ("the quick brown fox jumps over a lazy dog near 4929 rivers of time " * 3000).strip()
TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog and runs away from it all"),
    (2, "The quick brown fox jumps over the lazy dog and runs away from it all"),
    (3, None), (4, ""), (5, "   \n\t "), (6, "word"), (7, "Two words"), (8, LONG), (8, LONG),
    (9, "Ünïcode ДОМ 日本語 🎉 x y\u0085z\x1cend İı ΑΣ"), (None, "a row without an id stands here for once"), (None, None),
    (10, "call +1 (017) 555-7713 or mail réa.09@mail2.example.com by 2024-02-29, card 4539578763621486, host 97.51.17.173"),
    (11, "Licensed under the Apache License, Version 2.0. Released under the MIT License."),
    (12, "This work is licensed under CC BY-NC 4.0. <|endoftext|> and  <|startoftext|> don't"),
    (13, "The quick brown fox jumps over the lazy dog and runs away from it now"),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id string, fp string, words string, row string, hits string, a string, n int, target string"


def awkward(spark, rows=TEXTS):
    return spark.createDataFrame([(k, t, "en", "s", len(t or ""), "i", "f", "w", "r", "h", "a", 1, "t") for k, t in rows], SCHEMA)


def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def rows_of(df):
    return [r.asDict(True) for r in df.collect()]
