import json
import re

from helpers import TEXTS, awkward, nothing, rows_of

from tidemark.llm import license_scan as lic
from tidemark.llm import tool_calls


def brute_base(text):
    words = re.findall(lic.WORD, re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    places, labels = [], set()
    for phrase, label in lic.BASE.items():
        parts = phrase.split()
        for i in range(len(words)):
            if words[i:i + len(parts)] == parts:
                places.append(i)
                labels.add(label)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


LICENSED = [
    (40, "MIT license, mit-license; MIT  LICENSE! mit licence"), (41, "gnu general gnu general public license public license"),
    (42, "CC-BY 4.0 and cc by-nc and CC\nBY"), (43, "Apache License " * 40), (44, "ÄPACHE LICENSE apachelicense apache_license"),
    (45, "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    (46, "Permission is hereby granted, free of any charge, to any person obtaining a copy of this software and associated documentation files"),
    (47, "license of charge the mit general public a of by version software permission granted"), (48, "cc"), (49, "by cc by"),
]


def test_base_and_templates(spark):
    rows = [*TEXTS, *LICENSED]
    got = rows_of(lic.scan_licenses(awkward(spark, rows)))
    assert len(got) == len(rows)
    by = {r["doc_id"]: r for r in got}
    for key, text in rows:
        if key is not None:
            r = by[key]
            assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == brute_base(text), text
            assert 0 <= r["score"] <= 1 and set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(","))
            assert r["labels"] == ",".join(sorted(set(filter(None, r["labels"].split(",")))))
    assert by[11]["labels"] == "apache,apache-2.0,mit" and by[11]["score"] == 1.0
    assert by[12]["labels"] == "cc-by,cc-by-nc-4.0"
    assert by[45]["labels"] == "mit-notice" and by[46]["labels"] == "" and by[47]["labels"] == ""
    assert [m["start"] for m in by[11]["matches"]] == [0, 8]
    assert lic.scan_licenses(nothing(spark)).count() == 0


def test_every_template_finds_itself(spark):
    assert all(re.search(re.escape(p), " ".join(lic.template_words(t.text))) for t in lic.TEMPLATES for p in t.phrases)
    docs = [(i, f"before the {i} text {t.text} after it") for i, t in enumerate(lic.TEMPLATES)]
    got = {r["doc_id"]: r["labels"].split(",") for r in rows_of(lic.scan_licenses(awkward(spark, docs)))}
    assert all(t.label in got[i] for i, t in enumerate(lic.TEMPLATES))


def test_a_file_with_all_templates_keeps_every_label(spark):
    every = " and then ".join(t.text for t in lic.TEMPLATES)
    pairs = [(i, f"{a.text} {b.text}") for i, (a, b) in enumerate(zip(lic.TEMPLATES, lic.TEMPLATES[5:] + lic.TEMPLATES[:5]))]
    got = {r["doc_id"]: set(r["labels"].split(",")) for r in rows_of(lic.scan_licenses(awkward(spark, [*pairs, (100, every), (101, every * 3)])))}
    assert {t.label for t in lic.TEMPLATES} <= got[100] and got[100] == got[101]
    assert all({a.label, b.label} <= got[i] for i, (a, b) in enumerate(zip(lic.TEMPLATES, lic.TEMPLATES[5:] + lic.TEMPLATES[:5])))


CALLS = "conv_id long, turn long, call_id string, name string, arguments string, extra string"
RESULTS = "conv_id long, turn long, call_id string, content string, name string"
TOOLS = {"find": {"q": {"type": "string", "required": True}, "n": {"type": "integer"}, "m": {"type": "string", "enum": ["a", "b"]}}}


def test_linking_order_and_validation(spark):
    calls = spark.createDataFrame([
        (1, 0, "a", "find", '{"q": "x", "n": 3}', "e"), (1, 2, "b", "find", '{ "n":2,"q":"$ref:a and $ref:zz" }', "e"),
        (1, 4, "c", "find", '{"q": 5, "n": "3", "o": 1, "m": "c"}', "e"), (1, 6, "d", "other", "{}", "e"), (1, 8, "e", "find", "{broken", "e"), (1, 9, "g", "find", None, "e"),
        (2, 0, "a", "find", '{"q":"$ref:b"}', "e"), (2, 2, "b", "find", '{"q":"$ref:c"}', "e"), (2, 4, "c", "find", '{"q":"z"}', "e"),
        (3, 0, "a", "find", '{"q":"$ref:b"}', "e"), (3, 2, "b", "find", '{"q":"$ref:a"}', "e"), (3, 4, "c", "find", '{"q":"$ref:b"}', "e"), (3, 5, "d", "find", '{"q":"[1]"}', "e"),
        (4, 3, "a", "find", "[1]", "e"), (4, 1, "a", "find", '{"q":"first"}', "e"), (4, 1, "a", "find", '{"q":"first"}', "e"),
        (5, 0, None, "find", '{"q":"x"}', "e"), (5, 0, None, "find", '{"q":"x"}', "e"), (None, 0, "a", "find", '{"q":"x"}', "e"),
    ], CALLS)
    results = spark.createDataFrame([(1, 1, "a", "one", "n"), (1, 1, "b", "early", "n"), (1, 5, "c", None, "n"), (1, 7, "lost", "orphan", "n"), (4, 9, "a", "late", "n"),
                                     (4, 5, "a", "sooner", "n"), (5, 1, None, "loose", "n")], RESULTS)
    got = rows_of(tool_calls.link_tool_calls(calls, results, TOOLS))
    by = {(r["conv_id"], r["call_id"]): r for r in got if r["call_id"] and r["conv_id"]}
    assert len(got) == 15 + 4 + 0 and len(by) == 15
    assert {k[1]: by[1, k[1]]["status"] for k in by if k[0] == 1} == {"a": "linked", "b": "early", "c": "linked", "d": "pending", "e": "pending", "g": "pending", "lost": "orphan"}
    assert by[1, "a"]["valid"] and by[1, "a"]["errors"] == []
    assert by[1, "b"]["missing_refs"] == ["zz"] and by[1, "b"]["round"] == 0
    assert by[1, "c"]["errors"] == ["type of n", "type of q", "unknown o", "value of m"]
    assert by[1, "d"]["errors"] == ["unknown tool"] and by[1, "e"]["errors"] == ["not JSON"] == by[1, "g"]["errors"]
    assert [by[2, c]["round"] for c in "abc"] == [2, 1, 0]
    assert [by[3, c]["round"] for c in "abcd"] == [None, None, None, 0]
    assert (by[4, "a"]["turn"], by[4, "a"]["n_calls"], by[4, "a"]["n_results"]) == (1, 3, 2)
    made = json.loads(by[4, "a"]["canonical"])
    assert made["content"] == "sooner" and made["arguments"] == {"q": "first"} and list(made) == sorted(made)
    assert '"arguments":{"n":2,"q":"$ref:a and $ref:zz"}' in by[1, "b"]["canonical"]
    assert json.loads(by[1, "e"]["canonical"])["arguments"] == ["{broken"]


def test_no_calls_or_results(spark):
    none = spark.createDataFrame([], CALLS), spark.createDataFrame([], RESULTS)
    assert tool_calls.link_tool_calls(*none, TOOLS).count() == 0
    some = spark.createDataFrame([(1, 1, "a", "x", "n")], RESULTS)
    assert [r["status"] for r in rows_of(tool_calls.link_tool_calls(none[0], some, TOOLS))] == ["orphan"]
