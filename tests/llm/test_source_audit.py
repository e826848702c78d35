"""Source divergence against a plain count."""

import random
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest

from tidemark.llm import source_audit
from tidemark.llm.source_audit import source_divergence

from helpers import LONG, awkward, nothing

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, index int, term string, item string, value long, s int, tokens string"


def brute(rows, min_docs, top=50):
    """(lang, source, part, item, value, rank) from (text, lang, source) rows."""
    upper = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    held, counts, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        words = Counter(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(upper)))
        groups[lang].add(source)
        held[lang].update(words.keys())
        counts[lang, source].update(words)
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in held[lang].items() if n >= min_docs]

        def shares(count):
            n = sum(count[t] for t in kept)
            return {t: 1 + 10 ** 9 * (count[t] + 5) // (n + 5 * len(kept)) for t in kept}

        p = {s: shares(counts[lang, s]) for s in sources}
        q = shares(sum((counts[lang, s] for s in sources), Counter()))
        for s in sources:
            pairs = [(-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode(), o) for o in sources if o != s]
            terms = [(q[t] - p[s][t], t.encode(), t) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            out += [(lang, s, "pair", o, -v, i) for i, (v, _, o) in enumerate(sorted(pairs), 1)]
            out += [(lang, s, "term", t, -v, i) for i, (v, _, t) in enumerate(sorted(terms)[:top], 1)]
    return sorted(out)


def found(df):
    return sorted(map(tuple, df.collect()))


def frame(spark, rows):
    return spark.createDataFrame([(1, t, lang, s, 1, 1, "t", "i", 5, 3, "x") for t, lang, s in rows], SCHEMA)


def made(n, sources, seed):
    pick = random.Random(seed)
    words = [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(120)] + ["Üben", "ДОМ", "Zoë", "日本語"]
    return [(" ".join(pick.choices(words, [1 / (i + 1) for i in range(len(words))], k=pick.randint(0, 40))), pick.choice(["en", "de"]),
             f"s{min(pick.randrange(sources), pick.randrange(sources))}") for _ in range(n)]


def test_against_brute_force(spark):
    rows = made(400, 7, 1)
    rows += rows[:50] + [(None, "en", "s1"), ("", None, None), ("plain words", None, "x"), (LONG, "en", "long"), ("a", "fr", "alone"), ("b", "a\0b", "nul"),
                         ("c wa", "a\0b", "other"), (None, "it", "empty"), (None, "it", "empty too")]
    for least in (30, 1):
        got = source_divergence(frame(spark, rows).repartition(5), min_docs=least)
        assert found(got) == brute(rows, least)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]


def test_tiles_and_blocks_change_nothing(spark, monkeypatch):
    rows = made(300, 40, 2)
    monkeypatch.setattr(source_audit, "TILE", 6)
    monkeypatch.setattr(source_audit, "BLOCK", 10)
    monkeypatch.setattr(source_audit, "HELD", 300)
    assert found(source_divergence(frame(spark, rows), min_docs=3)) == brute(rows, 3)


def test_a_third_of_all_rows_in_one_group(spark):
    rows = made(200, 5, 3) + [("the hot words of one source " * 20, "en", "hot")] * 100
    assert found(source_divergence(frame(spark, rows), min_docs=30)) == brute(rows, 30)


def test_large_counts_stay_exact(spark):
    df = spark.createDataFrame([(9 * 10 ** 17, 10 ** 18, 3)], "n long, total long, terms long")
    assert df.select(source_audit.share("n", "total", "terms")).first()[0] == 1 + 10 ** 9 * (9 * 10 ** 17 + 5) // (10 ** 18 + 15)


def test_no_rows_and_no_kept_terms(spark):
    assert source_divergence(nothing(spark)).collect() == []
    df = awkward(spark)
    assert source_divergence(df).collect() == []  # one source, and no term in thirty texts
    two = frame(spark, [("one", "en", "b"), ("two", "en", "a"), (None, "en", "c")])
    assert found(source_divergence(two)) == [("en", "a", "pair", "b", 0, 1), ("en", "a", "pair", "c", 0, 2), ("en", "b", "pair", "a", 0, 1),
                                             ("en", "b", "pair", "c", 0, 2), ("en", "c", "pair", "a", 0, 1), ("en", "c", "pair", "b", 0, 2)]


@pytest.mark.parametrize("sizes", [[0], [3, 0, 2], [5, 5, 5, 5]])
def test_vector_sums_hold_a_bounded_number(sizes, monkeypatch):
    monkeypatch.setattr(source_audit, "HELD", 4)
    vectors = [{"indices": list(range(n)), "values": [float(i + 1) for i in range(n)]} for n in sizes]
    batch = pa.RecordBatch.from_pydict({"lang": ["x"] * len(sizes), "source": [f"s{i % 2}" for i in range(len(sizes))], "vector": vectors})
    total = Counter()
    for out in source_audit._sum_vectors(iter([batch, batch])):
        for r in out.to_pylist():
            total.update({(r["source"], r["span"] * source_audit.SPAN + i): n for i, n in zip(r["place"], r["n"], strict=True)})
    want = Counter()
    for i, n in enumerate(sizes):
        for j in range(n):
            want[f"s{i % 2}", j] += 2 * (j + 1)
    assert total == want


def test_terms_of_bytes_are_those_of_the_pattern():
    upper = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    pick = random.Random(9)
    texts = ["", "a", "", "", "Zoë9x", "ÀÉ@日本語[x`y{z", " lead and trail ", "123 !", "ab", "cd", "\x7f\x80\u00ff", LONG[:500], ""]
    texts += ["".join(pick.choices("abZ éÜ日🎉0-_\n", k=pick.randint(0, 30))) for _ in range(300)]
    for prefix in ("", "en\0", "日\0"):
        for part in (pa.array(texts), pa.array(["skip", *texts]).slice(1), pa.array(["", ""]), pa.array([], pa.string())):
            want = [[prefix + w for w in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", t.translate(upper))] for t in part.to_pylist()]
            got = source_audit.terms_of(part, prefix)
            got.validate(full=True)
            assert got.to_pylist() == want
    batch = pa.RecordBatch.from_pydict({"lang": ["a", "b", "a", "", "a"], "source": list("vwxyz"), "text": ["One two", "x", "", "q r", "s"]})
    for options in ({}, {"rows": 1}, {"most_bytes": 1}):
        found = [tuple(r.values()) for out in source_audit._tokens(iter([batch]), **options) for r in out.to_pylist()]
        assert sorted(found) == sorted([("a", "v", ["a\0one", "a\0two"]), ("b", "w", ["b\0x"]), ("a", "x", []), ("", "y", ["\0q", "\0r"]), ("a", "z", ["a\0s"])])


def test_different_terms_of_each_text():
    texts = pa.array(["b a b A ab", "", "a", "a a é É"])
    got = [sorted(x) for x in source_audit.terms_of(texts, "en\0", once=True).to_pylist()]
    assert got == [sorted("en\0" + t for t in ts) for ts in (["a", "ab", "b"], [], ["a"], ["a", "é", "É"])]
    assert source_audit.terms_of(pa.array(["", "1"]), "", once=True).to_pylist() == [[], []]


@pytest.mark.parametrize(("held", "rows"), [(1 << 21, 1000), (7, 3), (1, 1)])
def test_sums_by_spans_are_the_sums(monkeypatch, held, rows):
    monkeypatch.setattr(source_audit, "HELD", held)
    rng, want, batches = random.Random(held + rows), Counter(), []
    for _ in range(6):
        table = []
        for _ in range(rng.randint(0, 12)):
            group, found = (rng.choice(["", "en"]), rng.choice(["s", "t", "u"])), sorted(rng.sample(range(1200), rng.randint(0, 40)))
            counts = [float(rng.randint(1, 9)) for _ in found]
            want.update({(*group, i): int(c) for i, c in zip(found, counts)})
            table.append({"lang": group[0], "source": group[1], "vector": {"indices": found, "values": counts}})
        kind = pa.schema([("lang", pa.string()), ("source", pa.string()),
                          ("vector", pa.struct([("indices", pa.list_(pa.int32())), ("values", pa.list_(pa.float64()))]))])
        batches.append(pa.RecordBatch.from_pylist(table, kind))
    spans = [r for b in source_audit._sum_vectors(iter(batches)) for r in b.to_pylist()]
    spans.sort(key=lambda r: (r["lang"], r["source"], r["span"]))
    dealt = [pa.RecordBatch.from_pylist(spans[i:i + rows], pa.schema([
        ("lang", pa.string()), ("source", pa.string()), ("span", pa.int32()), ("place", pa.list_(pa.int32())), ("n", pa.list_(pa.int64()))]))
        for i in range(0, len(spans), rows)]
    got = [tuple(r.values()) for b in source_audit._add_spans(iter(dealt)) for r in b.to_pylist()]
    assert len(got) == len(want) and dict(((a, b, c), n) for a, b, c, n in got) == want
