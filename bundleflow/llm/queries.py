"""One query per operator, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bpe, chat, decontaminate, importance, langid, neardup, pii, quality_rules, ranked_search, sharding,
               token_counts, toxicity, url_rules)
from .common import Scratch, holdout, prepare, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(prepare(spark), sf_dir)
    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    QUERIES[fn.__name__] = run
    return run


@query
def op1_levenshtein_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = table(spark, sf_dir, "documents"), holdout("doc_id", 3, 1)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), train=~held_out)
    rows = docs.select("doc_id", "text", held_out.alias("held_out"))
    return toxicity.score(rows, model, keep=["doc_id", "held_out"]).withColumn(
        "predicted", (F.col("score") >= 0.7).cast("int"))


@query
def op2_spaced_seed_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLES["op2_spaced_seed_decontamination"] = """
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+'), lambda w: w <> '') AS dw
           FROM documents WHERE text IS NOT NULL),
b AS (SELECT item_id, list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+'), lambda w: w <> '') AS iw
      FROM benchmark WHERE text IS NOT NULL),
dp AS (SELECT doc_id, unnest(dw) AS w, generate_subscripts(dw, 1) AS p FROM d),
bp AS (SELECT item_id, len(iw) AS n, unnest(iw) AS w, generate_subscripts(iw, 1) AS q FROM b),
al AS (SELECT doc_id, item_id, n, p - q AS shift, list(q) AS qs
       FROM dp JOIN bp USING (w) GROUP BY ALL HAVING count(*) * 100 >= CASE WHEN n < 8 THEN 100 ELSE 80 END * least(13, n)),
ok AS (SELECT doc_id, item_id, len(qs) AS matched FROM al
       WHERE len(list_filter(range(1, n - least(13, n) + 2), lambda i:
             100 * len(list_filter(qs, lambda x: x >= i AND x < i + least(13, n))) >= CASE WHEN n < 8 THEN 100 ELSE 80 END * least(13, n))) > 0)
SELECT doc_id, item_id, max(matched)::INT AS matched FROM ok GROUP BY ALL
"""


@query
def op3_byte_level_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip_digest(table(spark, sf_dir, "documents"))


@query
def op4_contextual_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find(table(spark, sf_dir, "documents")))


@query
def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs, train=langid.train_rows())
    rows = docs.select("doc_id", "text", holdout("doc_id", 4, 2).alias("held_out"))
    return langid.identify(rows, model, keep=["doc_id", "held_out"])


@query
def op6_feistel_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_rows(table(spark, sf_dir, "documents"))


def _pass(rows: str, x: str) -> str:
    """DuckDB SQL of one pass of the network over column ``x`` of ``rows`` (which has a, b)."""
    out = f"(SELECT *, {x} // b AS l, {x} % b AS r FROM {rows})"
    for i, k in enumerate(sharding.round_keys(20240607)):
        side, other, cells = ("l", "r", "a") if i % 2 == 0 else ("r", "l", "b")
        out = f"(SELECT * REPLACE (({side} + {sharding.mix(other, str(k))}) % {cells} AS {side}) FROM {out})"
    return f"(SELECT *, l * b + r AS passed FROM {out})"


ORACLES["op6_feistel_sharding"] = f"""
WITH RECURSIVE tab AS (SELECT list(c ORDER BY n) AS t FROM (
  SELECT n, list_reduce([n::UBIGINT, 1, 2, 3, 4, 5, 6, 7, 8],
    lambda c, i: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) AS c FROM range(256) r(n))),
bytes AS (SELECT doc_id, strlen(coalesce(text, '')) + 1 AS size,
  list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: ('0x' || x)::UBIGINT) AS b FROM documents),
sums AS (SELECT doc_id, size, xor(4294967295, list_reduce([4294967295::UBIGINT] || b,
  lambda c, x: xor(c >> 8, t[((xor(c, x) & 255) + 1)::BIGINT])))::BIGINT AS crc FROM bytes, tab),
numbered AS (SELECT *, row_number() OVER (ORDER BY doc_id NULLS FIRST, crc, size) - 1 AS n FROM sums),
grid AS (SELECT count(*) AS cnt, greatest(1, ceil(sqrt(count(*))))::BIGINT AS a,
                ceil(count(*) / greatest(1, ceil(sqrt(count(*)))))::BIGINT AS b FROM documents),
walk AS (
  SELECT n, cnt, a, b, passed AS p FROM {_pass("(SELECT n, cnt, a, b FROM numbered, grid)", "n")}
  UNION ALL
  SELECT n, cnt, a, b, passed AS p FROM {_pass("(SELECT * FROM walk WHERE p >= cnt)", "p")})
SELECT doc_id, size, crc AS text_crc32, 'rows' AS law, (p % 8)::INT AS shard, p // 8 AS slot, NULL::INT AS grown_shard
FROM numbered JOIN (SELECT n, p FROM walk WHERE p < cnt) USING (n)
"""


@query
def op7_preference_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.preference_pairs(chat.reply_pairs(table(spark, sf_dir, "conversations")), "conv_id")


ORACLES["op7_preference_formatting"] = """
WITH t AS (SELECT conv_id, coalesce(role, 'user') AS role, coalesce(text, '') AS text,
                  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, 'user'),
                                     coalesce(text, '')) AS p
           FROM conversations),
a AS (SELECT *, last_value(CASE WHEN role = 'assistant' THEN text END IGNORE NULLS) OVER (
                  PARTITION BY conv_id ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before,
             count(*) FILTER (role = 'assistant') OVER (PARTITION BY conv_id) AS k FROM t),
s AS (SELECT conv_id, p, role, text, CASE WHEN role <> 'assistant' THEN text WHEN before IS NOT NULL THEN before
             WHEN k = 1 THEN '' ELSE text END AS alt FROM a),
n AS (SELECT conv_id, coalesce(min(p) FILTER (text <> alt), max(p) + 1) - 1 AS n FROM s GROUP BY 1),
o AS (SELECT s.conv_id, p, n, role,
             '<|' || role || '|>' || chr(10) || replace(text, '<|', '<' || chr(8203) || '|') || '<|end|>' || chr(10) AS c,
             '<|' || role || '|>' || chr(10) || replace(alt, '<|', '<' || chr(8203) || '|') || '<|end|>' || chr(10) AS r
      FROM s JOIN n ON s.conv_id IS NOT DISTINCT FROM n.conv_id),
m AS (SELECT *, sum(CASE WHEN p > n THEN length(c) ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY p) AS ce,
                sum(CASE WHEN p > n THEN length(r) ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY p) AS re FROM o)
SELECT conv_id, any_value(n)::INT AS n_common,
       coalesce(string_agg(c, '' ORDER BY p) FILTER (p <= n), '') AS prompt,
       coalesce(string_agg(c, '' ORDER BY p) FILTER (p > n), '') AS chosen,
       coalesce(string_agg(r, '' ORDER BY p) FILTER (p > n), '') AS rejected,
       coalesce(string_agg((ce - length(c) + length(role) + 5)::BIGINT || ':' || (ce - 1)::BIGINT, ',' ORDER BY p)
                FILTER (p > n AND role = 'assistant'), '') AS chosen_mask,
       coalesce(string_agg((re - length(r) + length(role) + 5)::BIGINT || ':' || (re - 1)::BIGINT, ',' ORDER BY p)
                FILTER (p > n AND role = 'assistant'), '') AS rejected_mask,
       max(p) > any_value(n) AS usable
FROM m GROUP BY conv_id
"""


@query
def op8_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


ORACLES["op10_url_filter"] = """
WITH u AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, rest, regexp_extract(rest, '^([^/?#]*)', 1) AS raw FROM u),
p AS (SELECT row_number() OVER () AS n, page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(substr(rest, length(raw) + 1), '^([^?#]*)', 1) AS path FROM h),
r(host_end, start, verdict) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
                                       ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
k(rule, verdict) AS (VALUES ('(?:^|[^A-Za-z0-9])spam-farm[.]', 'block'), ('(?:^|[^A-Za-z0-9])cheap-pills[.]', 'block'),
                     ('[.]casino(?:[^A-Za-z0-9]|$)', 'block'), ('(?:^|[^A-Za-z0-9])ads[.]', 'block'),
                     ('/login(?:[^A-Za-z0-9]|$)', 'block'), ('/tag/.*/page/', 'block')),
m AS (SELECT n, max_by(host_end || start, length(host_end || start)) AS rule,
             max_by(verdict, length(host_end || start)) AS verdict
      FROM p JOIN r ON (host = host_end OR ends_with(host, '.' || host_end)) AND starts_with(path, start) GROUP BY n),
b AS (SELECT DISTINCT n, 'block' AS verdict FROM p JOIN k ON regexp_matches(host || path, k.rule, 's'))
SELECT page_id, host, path, m.rule, coalesce(m.verdict, b.verdict, 'allow') AS verdict
FROM p LEFT JOIN m USING (n) LEFT JOIN b USING (n)
"""


@query
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = Scratch(spark, "quality").write(
        quality_rules.text_statistics(table(spark, sf_dir, "documents")), "stats")
    rules = quality_rules.fit(stats, table(spark, sf_dir, "labels"))
    return quality_rules.judge(stats, rules).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "rule")


@query
def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge_urls(table(spark, sf_dir, "pages")).select(
        "page_id", "host", "path", "rule", "verdict")


@query
def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


# Words as operators 11 and 13 take them, and crc32 of a text's bytes.
_WORDS = ("regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
          "'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')")

ORACLES["op11_importance_resampling"] = f"""
WITH tab AS (SELECT list(c ORDER BY n) AS t FROM (
  SELECT n, list_reduce([n::UBIGINT, 1, 2, 3, 4, 5, 6, 7, 8],
    lambda c, i: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) AS c FROM range(256) r(n))),
d AS (SELECT row_number() OVER () AS n, doc_id, {_WORDS} AS ws FROM documents),
dw AS (SELECT n, unnest(ws) AS w FROM d),
bw AS (SELECT unnest({_WORDS}) AS w FROM benchmark),
v AS (SELECT w, (xor(4294967295, list_reduce([4294967295::UBIGINT] || list_transform(
        regexp_extract_all(hex(encode(w)), '..'), lambda x: ('0x' || x)::UBIGINT),
        lambda c, x: xor(c >> 8, t[((xor(c, x) & 255) + 1)::BIGINT]))) % 10000)::BIGINT AS bucket
      FROM (SELECT DISTINCT w FROM (SELECT w FROM dw UNION ALL SELECT w FROM bw)), tab),
s AS (SELECT bucket, count(*) AS s FROM dw JOIN v USING (w) GROUP BY 1),
t AS (SELECT bucket, count(*) AS t FROM bw JOIN v USING (w) GROUP BY 1),
sums AS (SELECT coalesce((SELECT sum(s) FROM s), 0) AS ss, coalesce((SELECT sum(t) FROM t), 0) AS tt),
g AS (SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * (ss + 10000)::DOUBLE
                                     / ((coalesce(s, 0) + 1)::DOUBLE * (tt + 10000)::DOUBLE)))::BIGINT AS gain
      FROM s FULL JOIN t USING (bucket), sums),
f AS (SELECT n, sum(gain)::BIGINT AS weight FROM dw JOIN v USING (w) JOIN g USING (bucket) GROUP BY 1),
x AS (SELECT n, doc_id, len(ws)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
             coalesce(weight, 0)::BIGINT + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5)::DOUBLE
                                                          / 4294967296)))::BIGINT AS score
      FROM d LEFT JOIN f USING (n)),
r AS (SELECT n, row_number() OVER (ORDER BY score DESC, doc_id NULLS FIRST)::BIGINT AS rank, count(*) OVER () AS able
      FROM x WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= able * 10 // 100 THEN rank END AS rank
FROM x LEFT JOIN r USING (n)
"""


@query
def op12_overlap_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return token_counts.count_tokens(table(spark, sf_dir, "documents"),
                                     public_tokenizers.path("piece_bpe_32k.model"))


@query
def op13_geometric_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLES["op13_geometric_ranked_search"] = f"""
WITH d AS (SELECT row_number() OVER () AS d, doc_id, {_WORDS} AS ws FROM documents),
i AS (SELECT row_number() OVER () AS i, item_id, {_WORDS} AS ws FROM benchmark),
tot AS (SELECT count(*) AS nn, sum(len(ws))::BIGINT AS ll FROM d WHERE len(ws) > 0),
q AS (SELECT i, w, count(*) AS c FROM (SELECT i, unnest(ws) AS w FROM i) GROUP BY ALL),
p AS (SELECT d, w, count(*) AS tf FROM (SELECT d, unnest(ws) AS w FROM d) WHERE w IN (SELECT w FROM q) GROUP BY ALL),
f AS (SELECT w, floor(1000 * ln((2 * nn + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS weight
      FROM p, tot GROUP BY w, nn),
m AS (SELECT d, doc_id, 75 + (25 * len(ws)::BIGINT * nn) // ll AS m FROM d, tot WHERE len(ws) > 0),
s AS (SELECT i, d, doc_id, sum(c * weight * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
      FROM q JOIN p USING (w) JOIN f USING (w) JOIN m USING (d) GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS FIRST)::INT AS rank FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r JOIN i USING (i) WHERE rank <= 20
"""
