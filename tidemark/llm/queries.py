"""The registered queries of this subpackage and their DuckDB twins."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    centroids, decontamination, license_scan, lm_scoring, near_dedup, packing, pseudonyms, source_audit, syncmers, token_counts, tool_calls,
    toxicity, url_filter,
)
from .common import fold_of, table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}

#: The key of the registered pseudonym query; production keys come from a secret store.
DEMO_KEY = "tidemark-demo-key"


def query(function):
    QUERIES[function.__name__] = function
    return function


# every token of every text scored by both models, counted from all target texts
ORACLES["op1_cross_entropy_difference"] = r"""
WITH target AS (SELECT DISTINCT doc_id FROM labels WHERE quality = 1),
texts AS (SELECT d.doc_id, t.doc_id IS NOT NULL AS tg, regexp_extract_all(lower(coalesce(d.text, '')), '[\p{L}\p{N}_]+') AS ws
  FROM documents d LEFT JOIN target t ON t.doc_id = d.doc_id),
toks AS (SELECT doc_id, tg, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM texts WHERE len(ws) > 0),
words AS (SELECT w, count(*) AS n, count(*) FILTER (tg) AS nt FROM toks GROUP BY w),
vocabulary AS (SELECT w FROM words ORDER BY n DESC, w LIMIT 32768),
size AS (SELECT sum(n) AS n, sum(nt) AS nt, sum(nt) / CAST(sum(n) AS DOUBLE) AS scale, (SELECT count(*) FROM vocabulary) AS v FROM words),
known AS (SELECT t.doc_id, t.tg, t.i, coalesce(v.w, '<unk>') AS v FROM toks t LEFT JOIN vocabulary v ON v.w = t.w),
pairs AS (SELECT *, lag(v, 1, '<s>') OVER (PARTITION BY doc_id ORDER BY i) AS u FROM known),
unigrams AS (SELECT k.v, count(*) FILTER (tg) AS ct, count(*) * any_value(scale) AS cb,
  (count(*) FILTER (tg) + 1) / CAST(any_value(z.nt) + any_value(z.v) + 1 AS DOUBLE) AS pt,
  (count(*) * any_value(scale) + 1) / (any_value(z.n) * any_value(scale) + any_value(z.v) + 1) AS pb FROM known k, size z GROUP BY k.v),
contexts AS (SELECT v AS u, ct, cb FROM unigrams
  UNION ALL SELECT '<s>', count(*) FILTER (tg), count(*) * any_value(scale) FROM texts, size WHERE len(ws) > 0),
bigrams AS (SELECT q.u, q.v, count(*) FILTER (q.tg) AS ct, count(*) * any_value(z.scale) AS cb FROM pairs q, size z GROUP BY q.u, q.v),
losses AS (SELECT p.doc_id, -ln((coalesce(b.ct, 0) + 50 * g.pt) / (c.ct + 50)) + ln((coalesce(b.cb, 0) + 50 * g.pb) / (c.cb + 50)) AS loss
  FROM pairs p JOIN unigrams g ON g.v = p.v JOIN contexts c ON c.u = p.u LEFT JOIN bigrams b ON b.u = p.u AND b.v = p.v)
SELECT x.doc_id, CAST(len(x.ws) AS BIGINT) AS n_tokens, round(coalesce(l.score, 0), 6) AS score
FROM texts x LEFT JOIN (SELECT doc_id, avg(loss) AS score FROM losses GROUP BY doc_id) l ON l.doc_id = x.doc_id
"""


@query
def op1_cross_entropy_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    targets = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    scored = lm_scoring.cross_entropy_difference(table(spark, sf_dir, "documents"), targets)
    return scored.withColumn("score", F.round("score", 6))


@query
def op2_simhash_pigeonring(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dedup.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", near_dedup.hex_fingerprint("fp").alias("fingerprint"), "component_id")


@query
def op3_feistel_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonyms.pseudonym_report(table(spark, sf_dir, "documents"), DEMO_KEY)


@query
def op4_bm25_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op5_license_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan_licenses(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


@query
def op6_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query
def op7_toxic_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    found = toxicity.toxic_passages(docs, model)
    return found.select("doc_id", (fold_of("doc_id") == 0).alias("held_out"), "score",
                        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"), F.size("passages").alias("n_passages"))


#: The tools of the derived calls.
TOOLS = {
    "search": {"query": {"type": "string", "required": True}, "limit": {"type": "integer"}, "after": {"type": "string"}},
    "translate": {"text": {"type": "string", "required": True}, "to": {"type": "string", "required": True, "enum": ["en", "de", "fr", "es"]}, "after": {"type": "string"}},
}


def derived_calls(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Tool calls and results made from all turns of ``conversations``, which have none: a user's turn becomes a call with the turn's text
    as an argument, an assistant's turn the result of the call before it. A digest of the text decides the tool, which call is referred to (the one
    before, the one after, none), and which arguments are wrong."""
    digest = F.md5(F.coalesce("text", F.lit("")))
    bit = lambda i, of: F.substring(digest, i, 1).isin(list(of))
    call = lambda turn: F.concat(F.lit("call_"), F.col("conv_id").cast("string"), F.lit("_"), turn.cast("string"))
    after = F.when(bit(1, "01234567"), F.concat(F.lit("$ref:"), call(F.col("turn") - 2))).when(bit(1, "8"), F.concat(F.lit("$ref:"), call(F.col("turn") + 2)))
    search = F.to_json(F.struct(F.when(~bit(2, "0"), F.col("text")).alias("query"), F.length("text").alias("limit"), after.alias("after")))
    translate = F.to_json(F.struct(F.when(bit(2, "1"), "xx").otherwise("fr").alias("to"), F.col("text").alias("text"), after.alias("after")))
    arguments = F.when(bit(3, "01234567"), search).otherwise(translate)
    broken = F.when(bit(4, "0"), F.substr(arguments, F.lit(1), F.length(arguments) - 1)).otherwise(arguments)
    name = F.when(bit(3, "01234567"), "search").otherwise("translate")
    calls = turns.where("role = 'user'").select("conv_id", "turn", call(F.col("turn")).alias("call_id"), name.alias("name"), broken.alias("arguments"))
    results = turns.where("role = 'assistant'").select("conv_id", "turn", call(F.col("turn") - 1).alias("call_id"), F.col("text").alias("content"))
    return calls, results


@query
def op8_tool_call_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tool_calls.link_tool_calls(*derived_calls(table(spark, sf_dir, "conversations")), TOOLS)


@query
def op9_pretoken_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op10_closed_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.edit_likeness(table(spark, sf_dir, "documents"))


def _kmeans_sql(rounds: int = 10) -> str:
    """Rounds of exact k-means, one pair of common tables each."""
    assign = """a{i} AS MATERIALIZED (SELECT k.r, min(struct_pack(d := CAST(list_sum(list_transform(list_zip(k.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT),
  c := c.c)) AS best, any_value(k.v) AS v FROM kept k, c{i} c GROUP BY k.r)"""
    move = """m{i} AS MATERIALIZED (SELECT c, j, CAST(sum(x) AS BIGINT) AS s, count(*) AS n
  FROM (SELECT best.c AS c, unnest(v) AS x, generate_subscripts(v, 1) AS j FROM a{i}) GROUP BY c, j),
c{j} AS MATERIALIZED (SELECT c.c, coalesce(f.v, c.v) AS v FROM c{i} c LEFT JOIN (
  SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY j) AS v FROM m{i} GROUP BY c) f ON f.c = c.c)"""
    steps = ",\n".join(f"{assign.format(i=i)},\n{move.format(i=i, j=i + 1)}" for i in range(rounds))
    return f"""WITH kept AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256(concat('3:', vec_id)), v) - 1 AS c, v FROM kept QUALIFY c < 8),
{steps},
{assign.format(i=rounds)},
named AS (SELECT c, sha256(array_to_string(v, ',')) AS centroid_sha256 FROM c{rounds})
SELECT k.vec_id, CAST(a.best.c AS INTEGER) AS cluster, a.best.d AS distance, CAST(sum(a.best.d) OVER (PARTITION BY a.best.c) AS BIGINT) AS cluster_inertia,
  CAST(sum(a.best.d) OVER () AS BIGINT) AS inertia, n.centroid_sha256
FROM a{rounds} a JOIN kept k ON k.r = a.r JOIN named n ON n.c = a.best.c"""


ORACLES["op11_centroid_dictionaries"] = _kmeans_sql()


@query
def op11_centroid_dictionaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.centroid_clusters(table(spark, sf_dir, "embeddings"))


ORACLES["op12_source_divergence"] = r"""
WITH docs AS MATERIALIZED (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ws FROM documents),
toks AS (SELECT r, lang, source, unnest(ws) AS term FROM docs),
counted AS MATERIALIZED (SELECT r, lang, source, term, count(*) AS n FROM toks GROUP BY ALL),
kept AS MATERIALIZED (SELECT lang, term FROM counted GROUP BY lang, term HAVING count(*) >= 30),
sources AS MATERIALIZED (SELECT DISTINCT lang, source FROM docs),
sized AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
found AS MATERIALIZED (SELECT c.lang, c.source, c.term, CAST(sum(c.n) AS BIGINT) AS n FROM counted c JOIN kept k ON k.lang = c.lang AND k.term = c.term GROUP BY ALL),
dense AS MATERIALIZED (SELECT s.lang, s.source, k.term, coalesce(f.n, 0) AS n, CAST(sum(coalesce(f.n, 0)) OVER (PARTITION BY s.lang, s.source) AS BIGINT) AS total, z.v
  FROM sources s JOIN kept k ON k.lang = s.lang JOIN sized z ON z.lang = s.lang LEFT JOIN found f ON f.lang = s.lang AND f.source = s.source AND f.term = k.term),
shares AS MATERIALIZED (SELECT lang, source, term, n, CAST(1 + (1000000000 * CAST(n + 5 AS HUGEINT)) // (total + 5 * v) AS BIGINT) AS p FROM dense),
wide AS (SELECT lang, term, sum(n) AS n, any_value(v) AS v FROM dense GROUP BY lang, term),
whole AS MATERIALIZED (SELECT lang, term, CAST(1 + (1000000000 * CAST(n + 5 AS HUGEINT)) // CAST(sum(n) OVER (PARTITION BY lang) + 5 * v AS HUGEINT) AS BIGINT) AS q FROM wide),
pairs AS (SELECT a.lang, a.source, b.source AS item, coalesce(d.value, 0) AS value FROM sources a JOIN sources b ON b.lang = a.lang AND b.source <> a.source
  LEFT JOIN (SELECT x.lang, x.source AS one, y.source AS two, CAST(sum(abs(x.p - y.p)) AS BIGINT) AS value FROM shares x
    JOIN shares y ON y.lang = x.lang AND y.term = x.term AND y.source <> x.source GROUP BY ALL) d ON d.lang = a.lang AND d.one = a.source AND d.two = b.source),
terms AS (SELECT s.lang, s.source, s.term AS item, s.p - w.q AS value FROM shares s JOIN whole w ON w.lang = s.lang AND w.term = s.term WHERE s.n > 0 AND s.p > w.q)
SELECT lang, source, 'pair' AS part, item, CAST(value AS BIGINT) AS value, CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INTEGER) AS rank FROM pairs
UNION ALL SELECT lang, source, 'term', item, CAST(value AS BIGINT), CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INTEGER) AS rank
FROM terms QUALIFY rank <= 50
"""


@query
def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_audit.source_divergence(table(spark, sf_dir, "documents"))


#: The rules of the registered URL query.
URL_RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block"))


def _url_sql() -> str:
    def stands(term: str) -> str:
        return rf"regexp_matches(url, '(?:^|[\x00-\x2F\x3A-\x60\x7B-\x7F]){term}(?:[\x00-\x2F\x3A-\x60\x7B-\x7F]|$)')"

    weight = " + ".join(f"CASE WHEN {stands(t)} THEN {w} ELSE 0 END" for t, w in url_filter.VOCABULARY.items())
    rules = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    low = f"translate({{}}, '{upper}', '{upper.lower()}')"
    return f"""
WITH rests AS (SELECT row_number() OVER () AS r, page_id, {low.format("coalesce(url, '')")} AS url,
  CASE WHEN instr(coalesce(url, ''), '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (SELECT r, page_id, url, {low.format("regexp_extract(rest, '^([^/?#]*)([^?#]*)', 1)")} AS host, regexp_extract(rest, '^([^/?#]*)([^?#]*)', 2) AS path FROM rests),
rules(rule_host, rule_path, verdict) AS (VALUES {rules}),
fits AS (SELECT p.r, max(struct_pack(n := length(rule_host) + length(rule_path), h := length(rule_host), rule := rule_host || rule_path, verdict := x.verdict)) AS best
  FROM parts p JOIN rules x ON starts_with(p.path, rule_path) AND (p.host = rule_host OR ends_with(p.host, '.' || rule_host)) GROUP BY p.r),
judged AS (SELECT p.*, f.best, {weight} AS weight FROM parts p LEFT JOIN fits f ON f.r = p.r)
SELECT page_id, host, path, best.rule AS rule, coalesce(best.verdict, CASE WHEN weight >= {url_filter.STRICT} THEN 'block' ELSE 'allow' END) AS verdict,
  CAST(weight AS BIGINT) AS weight FROM judged"""


ORACLES["op13_url_vocabulary"] = _url_sql()


@query
def op13_url_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = url_filter.judge_urls(table(spark, sf_dir, "pages"), URL_RULES)
    return found.select("page_id", "host", "path", "rule", "verdict", "weight")
