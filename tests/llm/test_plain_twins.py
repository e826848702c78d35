"""Operators of SQL expressions alone against plain Python: the Feistel permutation, the call linker, the syncmer sketch."""

import datetime
import hashlib
import json
import random
import re
import struct

import xxhash
from helpers import TEXTS, awkward, rows_of
from pyspark.sql import functions as F

from tidemark.llm import pseudonyms, syncmers, tool_calls

# --- pseudonyms ---------------------------------------------------------------------------------


def permuted(limbs, radix, kind, key):
    """Four rounds for each limb: it moves by a keyed digest of the others."""
    limbs = list(limbs)
    for r in range(4 * len(limbs)):
        turn = r % len(limbs)
        others = ",".join("*" if i == turn else str(x) for i, x in enumerate(limbs))
        noise = int(hashlib.sha256(f"{key}|{kind}|{r}|{len(limbs)}|{others}".encode()).hexdigest()[:14], 16)
        limbs[turn] = (limbs[turn] + noise) % radix[turn]
    return limbs


def plain_digits(digits, kind, key):
    widths = [len(digits) // 2, len(digits) - len(digits) // 2]
    halves = [int(digits[:widths[0]]), int(digits[widths[0]:])]
    return "".join(str(x).zfill(w) for x, w in zip(permuted(halves, [10 ** w for w in widths], kind, key), widths))


def check_digit(payload):
    total = sum(d if i % 2 else 2 * d - 9 * (d > 4) for i, d in enumerate(map(int, reversed(payload))))
    return -total % 10


def refill(shape, digits):
    """The digits put in the places of ``shape``'s digits."""
    left = iter(digits)
    return re.sub("[0-9]", lambda _: next(left), shape)


def plain_pseudonym(kind, value, key):
    digits = re.sub("[^0-9]", "", value)
    if kind == "card":
        fresh = plain_digits(digits[:-1], kind, key)
        return refill(value, fresh + str((check_digit(fresh) + int(digits[-1]) - check_digit(digits[:-1])) % 10))
    if kind == "phone":
        country = value[:re.match(r"\+[0-9]+?(?=[ .\-]?\(?[0-9]{3}\)?[ .\-]?[0-9]{3}[ .\-]?[0-9]{4}$)", value).end()]
        return country + refill(value[len(country):], plain_digits(digits[-10:], kind, key))
    if kind == "social":
        return refill(value, plain_digits(digits, kind, key))
    if kind == "address":
        a, b, c, d = map(int, value.split("."))
        x, y = permuted([a * 256 + b, c * 256 + d], [65536] * 2, kind, key)
        return f"{x // 256}.{x % 256}.{y // 256}.{y % 256}"
    if kind == "date":
        sign, day_first = re.search("[^0-9]", value).group(), value[2] in "./"
        parts = list(map(int, value.split(sign)))
        number = (datetime.date(*(parts[::-1] if day_first else parts)) - datetime.date(1900, 1, 1)).days
        x, y = permuted([number // 781, number % 781], [94, 781], kind, key)
        day = datetime.date(1900, 1, 1) + datetime.timedelta(x * 781 + y)
        return day.strftime(f"%d{sign}%m{sign}%Y" if day_first else f"%Y{sign}%m{sign}%d")
    if kind == "secret":
        blocks = [value[i:i + 8] for i in range(0, len(value), 8)]
        fresh = permuted([int(b, 16) for b in blocks], [16 ** len(b) for b in blocks], kind, key)
        text = "".join(f"{x:x}".zfill(len(b)) for x, b in zip(fresh, blocks))
        return text.upper() if re.search("[A-F]", value) else text
    local, domain = value.split("@")
    low = ["a" if "a" <= c <= "z" else "A" if "A" <= c <= "Z" else "0" if "0" <= c <= "9" else c for c in local]
    size = [26 if b in "aA" else 10 if b == "0" else 1 for b in low]
    size = [1 if c not in "aA0" and s == 1 else s for c, s in zip(low, size)]
    fresh = permuted([ord(c) - ord(b) for c, b in zip(local, low)], size, "email", key)
    return "".join(chr(ord(b) + x) for b, x in zip(low, fresh)) + "@" + domain


def test_pseudonyms_are_those_of_a_plain_feistel(spark):
    rng = random.Random(3)

    def digits(n):
        return "".join(rng.choices("0123456789", k=n))

    values = []
    for _ in range(60):
        values += [("card", digits(rng.randint(13, 19))), ("card", rng.choice("- ").join(digits(4) for _ in range(4))), ("social", f"{digits(3)}-{digits(2)}-{digits(4)}"),
                   ("phone", f"+{rng.randint(1, 999)} ({digits(3)}) {digits(3)}-{digits(4)}"), ("phone", f"+{rng.randint(1, 99)}.{digits(3)}.{digits(3)}.{digits(4)}"),
                   ("address", ".".join(str(rng.randint(0, 255)) for _ in range(4))),
                   ("secret", "".join(rng.choices("0123456789abcdef", k=rng.randint(32, 64)))), ("secret", "".join(rng.choices("0123456789ABCDEF", k=rng.randint(32, 64)))),
                   ("email", "".join(rng.choices("abzAZ019._%+-éß", k=rng.randint(1, 12))) + "@mail.example.org")]
        day = datetime.date(1900, 1, 1) + datetime.timedelta(rng.randint(0, 73413))
        values.append(("date", day.strftime(rng.choice(["%Y-%m-%d", "%Y/%m/%d", "%d.%m.%Y", "%d/%m/%Y"]))))
    # a text is searched for each shape in turn; a value here stands alone
    for key in ("k", "another key"):
        got = spark.createDataFrame(values, "kind string, v string").select("kind", "v", pseudonyms.pseudonym(F.col("v"), key)).collect()
        wrong = [(k, v, p, plain_pseudonym(k, v, key)) for k, v, p in got if p != plain_pseudonym(k, v, key)]
        assert len(got) == len(values) and not wrong, wrong[:5]


# --- tool calls ---------------------------------------------------------------------------------

TOOLS = {"find": {"q": {"type": "string", "required": True}, "n": {"type": "integer"}, "m": {"type": "string", "enum": ["a", "b"]}}, "stop": {}}
PYTHON_TYPES = {"string": lambda x: isinstance(x, str), "integer": lambda x: isinstance(x, int) and not isinstance(x, bool)}


def plain_errors(name, arguments):
    try:
        parsed = json.loads(arguments)
    except ValueError:
        return None, ["not JSON"]
    if not isinstance(parsed, dict):
        return parsed, ["not an object"]
    if name not in TOOLS:
        return parsed, ["unknown tool"]
    found, fields = [], TOOLS[name]
    strange = sorted(set(parsed) - set(fields))
    if strange:
        found.append("unknown " + " ".join(strange))
    for field, rule in fields.items():
        if field not in parsed:
            found += [f"missing {field}"] * bool(rule.get("required"))
            continue
        if not PYTHON_TYPES[rule["type"]](parsed[field]):
            found.append(f"type of {field}")
        if "enum" in rule and parsed[field] not in rule["enum"]:
            found.append(f"value of {field}")
    return parsed, sorted(found)


def plain_links(calls, results):
    one, seen, first, answers = {}, {}, {}, {}
    for conv, turn, call, name, arguments in calls:
        seen[conv, call] = seen.get((conv, call), 0) + 1
        one[conv, call] = min(one.get((conv, call), (turn, name, arguments)), (turn, name, arguments))
    for conv, turn, call, content in results:
        answers[conv, call] = answers.get((conv, call), 0) + 1
        first[conv, call] = min(first.get((conv, call), (turn, content)), (turn, content))
    refs = {key: set(re.findall(r"\$ref:([A-Za-z0-9_\-]+)", c[2])) for key, c in one.items()}
    parents = {key: {(key[0], r) for r in refs[key] if (key[0], r) in one} for key in one}
    forward = {key[0] for key in one for p in parents[key] if not (one[p][0], p[1]) < (one[key][0], key[1])}
    rounds, number = {key: 0 for key in one if key[0] not in forward}, 0
    while ready := [key for key in one if key not in rounds and parents[key] <= set(rounds)]:
        rounds.update(dict.fromkeys(ready, number))
        number += 1
    out = {}
    for key in {*one, *first}:
        call, answer = one.get(key), first.get(key)
        status = "orphan" if call is None else "pending" if answer is None else "early" if answer[0] < call[0] else "linked"
        parsed, errors = plain_errors(*call[1:]) if call else (None, [])
        arguments = parsed if parsed is not None else [call[2] if call else None]
        name, content, number = call and call[1], answer and answer[1], rounds.get(key)
        out[key] = ((call or answer)[0], name, status, seen.get(key, 0), answers.get(key, 0), number,
                    sorted(r for r in refs.get(key, ()) if (key[0], r) not in one), errors, bool(call) and not errors,
                    {"arguments": arguments, "call_id": key[1], "content": content, "name": name, "round": number, "status": status})
    return out


def test_links_are_those_of_a_plain_linker(spark):
    rng = random.Random(8)
    calls, results = [], []
    for conv in range(60):
        ids = [f"c{i}" for i in range(rng.randint(1, 6))]
        way = rng.choice(["back", "any", "chain"])
        for i, call in enumerate(ids):
            wanted = {"back": ids[:i], "any": [*ids, "lost"], "chain": ids[i + 1:i + 2]}[way]
            some = wanted if way == "chain" else rng.sample(wanted, min(len(wanted), rng.randint(0, 2)))
            given = {"q": " ".join(["x", *(f"$ref:{r}" for r in some)])}
            given |= {k: rng.choice(v) for k, v in {"n": [1, "1", True, None], "m": ["a", "b", "c", None], "o": [0]}.items() if rng.random() < 0.3}
            text = json.dumps(given, sort_keys=rng.random() < 0.5)
            if rng.random() < 0.1:
                text = rng.choice([text[:-1], json.dumps([given]), json.dumps({"n": 3}), "{}", "7"])
            for _ in range(rng.choice([1, 1, 1, 2])):
                calls.append((conv, 2 * i + rng.choice([0, 0, 1]), call, rng.choice(["find", "find", "find", "stop", "other"]), text))
            for _ in range(rng.choice([0, 1, 1, 2])):
                results.append((conv, max(0, 2 * i + rng.choice([1, 1, -1, 3])), rng.choice([call, call, call, "orphan"]), rng.choice(["one", "two", ""])))
    # a long chain of forward references, and a long text
    calls += [(99, i, f"c{i}", "find", json.dumps({"q": f"$ref:c{i + 1}" if i < 8 else "end " * 20_000})) for i in range(9)]
    got = rows_of(tool_calls.link_tool_calls(spark.createDataFrame(calls, "conv_id long, turn long, call_id string, name string, arguments string"),
                                             spark.createDataFrame(results, "conv_id long, turn long, call_id string, content string"), TOOLS))
    want = plain_links(calls, results)
    assert len(got) == len(want)
    for r in got:
        made = json.loads(r["canonical"])
        assert list(made) == sorted(made) and ": " not in re.sub(r'"(\\.|[^"\\])*"', '""', r["canonical"])
        found = tuple(r[c] for c in ("turn", "name", "status", "n_calls", "n_results", "round", "missing_refs", "errors", "valid")) + (made,)
        assert found == want[r["conv_id"], r["call_id"]], (r, want[r["conv_id"], r["call_id"]])
    assert {r["status"] for r in got} == {"linked", "pending", "early", "orphan"} and max(r["round"] or 0 for r in got) == 8
    assert any(r["round"] is None and r["n_calls"] for r in got)


# --- syncmers -----------------------------------------------------------------------------------


def signed(x):
    return x - (x >> 63 << 64)


def plain_sketch(text):
    tokens = re.findall(r"\S{1,8}", text, re.ASCII)
    hashes = [signed(xxhash.xxh64_intdigest(t.encode(), 42)) for t in ["\x02"] * 2 + tokens + ["\x03"] * 2]
    found = set()
    for i in range(len(hashes) - 2 if tokens else 0):
        run = hashes[i:i + 3]
        if min(run) in (run[0], run[2]):  # closed: the smallest stands at an edge
            state = 42
            for h in run:
                state = xxhash.xxh64_intdigest(struct.pack("<q", h), state)
            found.add(state & 0xFFFFFFFF)
    return sorted(found)[:64]


def plain_likeness(a, b):
    both = set(sorted({*a, *b})[:64])
    return len({*a} & {*b} & both) / len(both) if both else 1.0


def test_likeness_is_that_of_plain_sketches(spark):
    rng = random.Random(10)
    base = rng.choices(["lorem", "ipsum", "dolor", "sit", "é日本", "amet,", "x", "consectetur"], k=400)
    rows = [(k, t) for k, t in TEXTS if k not in (None, 8)]
    rows += [(1000 + i, " ".join([*base[:rng.randint(0, 400)], *rng.choices(base, k=rng.randint(0, 20))])) for i in range(50)]
    rows += [(2000, "one text " * 30_000), (2001, "one text " * 30_000), (2002, "")]
    got = {r["doc_id"]: r for r in rows_of(syncmers.edit_likeness(awkward(spark, rows)))}
    order = sorted(((k, t or "") for k, t in rows), reverse=True)
    assert len(got) == len(order)
    for (key, text), (_, after) in zip(order, order[1:] + order[:1]):
        m = len(text) // 3
        edited = text[:len(text) - m] + after[:m]
        own, other = plain_sketch(text), plain_sketch(edited)
        r = got[key]
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert r["fingerprint"] == "".join(f"{x:08x}" for x in own) and r["edited_fingerprint"] == "".join(f"{x:08x}" for x in other), key
        assert (r["near_edited"], r["near_next"]) == (plain_likeness(own, other), plain_likeness(own, plain_sketch(after))), key


def test_many_rows_of_one_id_follow_each_other(spark):
    rows = [(5, f"text number {i % 7} of one id") for i in range(300)] + [(4, "another"), (6, "the first")]
    got = rows_of(syncmers.edit_likeness(awkward(spark, rows)))
    assert len(got) == 302 and sum(r["doc_id"] == 5 for r in got) == 300
    # within an id rows are ordered by text, so all but the last of equal texts are followed by their like
    assert sum(r["near_next"] == 1.0 for r in got if r["doc_id"] == 5) == 300 - 7
