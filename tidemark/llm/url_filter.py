"""URL filter: listed rules first, a weighted vocabulary for the rest.

A rule names a host and a path. It fits that host and its subdomains where the path begins like the rule's, and the longest
fitting rule decides. Other URLs are judged by the words in them: an Aho-Corasick automaton finds all terms of the
vocabulary in one pass, a hit counts only where it is not part of a longer word, and a URL is rejected when the weights of
its distinct terms reach ``reject_at``: one strict term, or several soft ones.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower

STRICT, SOFT = 2, 1  # weights
#: Terms that reject a URL alone.
STRICT_TERMS = ("casino", "porn", "porno", "xxx", "viagra", "cialis", "escort", "escorts", "milf", "hentai", "camgirl", "camgirls", "warez",
                "keygen", "jackpot", "sportsbook", "payday-loan")
#: Terms of which several are needed.
SOFT_TERMS = ("adult", "bet", "bets", "betting", "bonus", "cheap", "crack", "dating", "deal", "deals", "farm", "free", "gamble", "girls",
              "hookup", "hot", "loan", "loans", "lottery", "nude", "pharma", "pills", "poker", "sex", "sexy", "slots", "spam", "torrent",
              "win", "winner")
VOCABULARY = {**dict.fromkeys(STRICT_TERMS, STRICT), **dict.fromkeys(SOFT_TERMS, SOFT)}


def with_host_and_path(pages: DataFrame, url_col: str = "url") -> DataFrame:
    """Adds ``host`` (after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased) and ``path`` (from there up to
    ``?``, ``#`` or the end). Both are empty for null and for texts without ``://``."""
    url = F.coalesce(F.col(url_col), F.lit(""))
    start = F.instr(url, "://")
    rest = F.when(start > 0, F.substr(url, start + 3)).otherwise("")
    parts = r"^([^/?#]*)([^?#]*)"
    return pages.withColumns({"host": ascii_lower(F.regexp_extract(rest, parts, 1)), "path": F.regexp_extract(rest, parts, 2)})


def _word_char(char: str) -> bool:
    """Digits, letters a-z and all characters beyond ASCII; texts are lower-cased."""
    return "0" <= char <= "9" or "a" <= char <= "z" or char > "\x7f"


class _Judge:
    def __init__(self, rules: Sequence[tuple[str, str, str]], vocabulary: dict[str, int], reject_at: int):
        import ahocorasick

        self.rules, self.reject_at, self.vocabulary = {}, reject_at, vocabulary
        for host, path, verdict in rules:
            self.rules.setdefault(host, []).append((path, verdict))
        self.longest = max(map(len, self.rules), default=0)
        self.automaton = ahocorasick.Automaton()
        for term in vocabulary:
            self.automaton.add_word(term, term)
        if vocabulary:
            self.automaton.make_automaton()

    def rule(self, host: str, path: str) -> tuple[str, str] | tuple[None, None]:
        """(rule, verdict) of the longest rule that fits."""
        best = (-1, -1, None, None)
        # the host itself, and what follows each of its dots; longer ends than any rule's host cannot fit
        at = 0 if len(host) <= self.longest else host.find(".", len(host) - self.longest - 1) + 1 or len(host) + 1
        while at <= len(host) and host:
            end = host[at:]
            for begin, verdict in self.rules.get(end, ()):
                if path.startswith(begin):
                    best = max(best, (len(end) + len(begin), len(end), end + begin, verdict))
            at = host.find(".", at) + 1 or len(host) + 1
        return best[2:]

    def hits(self, text: str) -> dict[str, int]:
        """How often each term stands in a lower-cased text as a word or words of its own."""
        found: dict[str, int] = {}
        if self.vocabulary:
            for last, term in self.automaton.iter(text):
                first = last - len(term) + 1
                if (first == 0 or not _word_char(text[first - 1])) and (last + 1 == len(text) or not _word_char(text[last + 1])):
                    found[term] = found.get(term, 0) + 1
        return found


def _verdicts(batches: Iterator[pa.RecordBatch], rules, vocabulary, reject_at: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    judge = _Judge(rules, vocabulary, reject_at)
    for batch in batches:
        out = []
        for url, host, path in zip(*(batch.column(c).to_pylist() for c in ("url", "host", "path")), strict=True):
            rule, verdict = judge.rule(host, path)
            hits = judge.hits(url)
            weight = sum(vocabulary[t] for t in hits)
            strict = sum(n for t, n in hits.items() if vocabulary[t] >= reject_at)
            out.append((rule, verdict or ("block" if weight >= reject_at else "allow"), strict, sum(hits.values()) - strict, weight))
        columns = list(zip(*out, strict=True)) or [[]] * 5
        made = [pa.array(c, f.type) for c, f in zip(columns, list(schema)[3:], strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("host"), batch.column("path"), *made], schema=schema)


def judge_urls(pages: DataFrame, rules: Sequence[tuple[str, str, str]], id_col: str = "page_id", url_col: str = "url",
               vocabulary: dict[str, int] | None = None, reject_at: int = STRICT, most_rules: int = 100_000) -> DataFrame:
    """One row per page: (id, host, path, rule, verdict, strict_hits, soft_hits, weight).

    ``rules`` are (host, path, verdict), verdicts ``allow`` or ``block``; the longest host and path together wins, of equally
    long ones the longer host. ``rule`` is null where none fits; then ``verdict`` is the vocabulary's: ``block`` when the weights of the distinct terms
    sum to ``reject_at`` or more. Hits are counted with repeats in the whole URL, A-Z lower-cased; ``weight`` sums each term once. Terms
    must be lower case. A null URL, or one without ``://``, has an empty host and path, so no rule fits; a null URL holds no term. Null ids
    and repeated rows are judged like any row; other columns are not read; an empty table gives no rows. Rules and vocabulary travel with
    the tasks, so more than ``most_rules`` of either are refused.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    vocabulary = VOCABULARY if vocabulary is None else vocabulary
    if max(len(rules), len(vocabulary)) > most_rules:
        raise ValueError(f"more than {most_rules} rules or terms")
    if any(not t or t != t.lower() for t in vocabulary):
        raise ValueError("terms must be lower case and not empty")
    kind = pages.schema[id_col].dataType.simpleString()
    schema = StructType.fromDDL(f"id {kind}, host string, path string, rule string, verdict string, strict_hits long, soft_hits long, weight long")
    rows = with_host_and_path(pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url")))
    rows = rows.withColumn("url", ascii_lower(F.coalesce("url", F.lit(""))))
    step = partial(_verdicts, rules=[tuple(r) for r in rules], vocabulary=dict(vocabulary), reject_at=reject_at, schema=to_arrow_schema(schema))
    return rows.select("id", "url", "host", "path").mapInArrow(step, schema).withColumnRenamed("id", id_col)
