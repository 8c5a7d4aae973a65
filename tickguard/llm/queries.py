"""The operators as registered queries: production parameters, whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickguard.llm import (
    decontam, jaccard, lexical, lm, negatives, packing, pii, quality, sharding, simhash, substring, toxicity, urlfilter)
from tickguard.llm.common import ship, small_batches, table

SHARDS = 8
#: The rules, and the host labels whose pages make up the list of URLs.
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"),
         ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
SPAM_LABELS = ["cheap-pills", "casino-win", "ads-track", "free-bets"]

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        ship(spark)
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = run
    return run


def word_bpe() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query
def op4_quality_rules(spark, sf):
    judged = quality.judge(table(spark, sf, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                         "n_repeat_words", "base_failed", "kept")


ORACLES["op4_quality_rules"] = r"""
WITH cut AS (
  SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
         [x FOR x IN string_split(coalesce(text, ''), chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS lines
  FROM documents
), windows AS (
  SELECT doc_id, i, array_to_string(words[i:i + 4], ' ') AS w FROM cut, unnest(range(1, len(words) - 3)) t(i)
), twice AS (SELECT doc_id, w FROM windows GROUP BY ALL HAVING count(*) > 1
), covered AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM windows JOIN twice USING (doc_id, w), unnest(range(i, i + 5)) t(p)
  GROUP BY doc_id
), counted AS (
  SELECT doc_id, lang, source, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, len(lines) AS n_lines,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words
  FROM cut LEFT JOIN covered USING (doc_id)
), measured AS (
  SELECT *, coalesce(word_chars * 100 // nullif(n_words, 0), 0) AS word_centichars,
         coalesce(n_symbols * 10000 // nullif(word_chars, 0), 0) AS symbol_rate,
         coalesce(n_dup_lines * 10000 // nullif(n_lines, 0), 0) AS dup_line_rate,
         coalesce(n_repeat_words * 10000 // nullif(n_words, 0), 0) AS repeat_rate,
         n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed
  FROM counted
), long AS (
  SELECT lang, source, metric, (v >> greatest(length(bin(v)) - 6, 0)) << greatest(length(bin(v)) - 6, 0) AS bin
  FROM (SELECT lang, source, word_centichars, symbol_rate, dup_line_rate, repeat_rate FROM measured WHERE n_words > 0)
  UNPIVOT (v FOR metric IN (word_centichars, symbol_rate, dup_line_rate, repeat_rate))
), own AS (
  SELECT *, sum(n) OVER (PARTITION BY lang, source, metric ORDER BY bin) AS upto,
         sum(n) OVER (PARTITION BY lang, source, metric) AS total
  FROM (SELECT lang, source, metric, bin, count(*) AS n FROM long GROUP BY ALL)
), of_lang AS (
  SELECT *, sum(n) OVER (PARTITION BY lang, metric ORDER BY bin) AS upto,
         sum(n) OVER (PARTITION BY lang, metric) AS total
  FROM (SELECT lang, metric, bin, count(*) AS n FROM long GROUP BY ALL)
), lang_q AS (
  SELECT lang, metric, min(bin) FILTER (4 * upto >= total) AS q1, min(bin) FILTER (4 * upto >= 3 * total) AS q3
  FROM of_lang GROUP BY ALL
), picked AS (
  SELECT o.lang, o.source, o.metric,
         CASE WHEN max(total) < 200 THEN any_value(l.q1) ELSE min(bin) FILTER (4 * upto >= total) END AS q1,
         CASE WHEN max(total) < 200 THEN any_value(l.q3) ELSE min(bin) FILTER (4 * upto >= 3 * total) END AS q3
  FROM own o JOIN lang_q l ON o.lang = l.lang AND o.metric = l.metric GROUP BY ALL
), limits AS (
  SELECT lang, source, metric, q1 - reach AS low, q3 + reach AS high
  FROM (SELECT *, greatest(3 * (q3 - q1), CASE metric WHEN 'word_centichars' THEN 200 WHEN 'symbol_rate' THEN 200
                                          WHEN 'dup_line_rate' THEN 3000 ELSE 1500 END) AS reach FROM picked)
), wide AS (
  SELECT lang, source, max(low) FILTER (metric = 'word_centichars') AS chars_low,
         max(high) FILTER (metric = 'word_centichars') AS chars_high,
         max(high) FILTER (metric = 'symbol_rate') AS symbol_high,
         max(high) FILTER (metric = 'dup_line_rate') AS dup_high,
         max(high) FILTER (metric = 'repeat_rate') AS repeat_high
  FROM limits GROUP BY ALL
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       coalesce(NOT base_failed AND word_centichars BETWEEN chars_low AND chars_high AND symbol_rate <= symbol_high
                AND dup_line_rate <= dup_high AND repeat_rate <= repeat_high, false) AS kept
FROM measured LEFT JOIN wide USING (lang, source)
"""


@query
def op6_packing(spark, sf):
    return packing.pack(table(spark, sf, "documents"), word_bpe()).drop("ids")


@query
def op7_sharding(spark, sf):
    docs = table(spark, sf, "documents").select(
        "doc_id", "text", F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"))
    return sharding.shard(docs, SHARDS).select(
        "doc_id", F.col("_size").alias("size"), "text_crc32", F.lit("bytes").alias("law"),
        F.col("_shard").alias("shard"), F.col("_slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))


@query
def op8_url_filters(spark, sf):
    pages = table(spark, sf, "pages").select("page_id", "url")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    hosts = pages.select(urlfilter.host_of("url").alias("host"), urlfilter.path_of("url").alias("path"))
    listed = hosts.filter(F.arrays_overlap(F.split("host", r"\."), F.array(*map(F.lit, SPAM_LABELS))))
    return urlfilter.filter_urls(pages, rules, listed).select(
        "page_id", F.col("_host").alias("host"), F.col("_path").alias("path"),
        F.col("_rule").alias("rule"), F.col("_verdict").alias("verdict"))


ORACLES["op8_url_filters"] = r"""
WITH parts AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), urls AS (
  SELECT page_id,
         translate(regexp_extract(coalesce(rest, ''), '^([^/?#]*)', 1),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path
  FROM parts
), ruled AS (
  SELECT *, CASE
    WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM urls
), listed AS (
  SELECT DISTINCT regexp_replace(regexp_replace(host, '^[^@]*@|:[0-9]*$', '', 'g'), '^www\.', '')
         || regexp_replace(path, '/$', '') AS url
  FROM urls
  WHERE len(list_intersect(string_split(host, '.'), ['cheap-pills', 'casino-win', 'ads-track', 'free-bets'])) > 0
)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
    WHEN regexp_replace(regexp_replace(host, '^[^@]*@|:[0-9]*$', '', 'g'), '^www\.', '')
         || regexp_replace(path, '/$', '') IN (SELECT url FROM listed) THEN 'block' ELSE 'allow' END AS verdict
FROM ruled
"""


@query
def op9_decontamination(spark, sf):
    found = decontam.find(table(spark, sf, "documents").select("doc_id", "text"),
                          table(spark, sf, "benchmark"))
    return found.select(
        "doc_id", F.col("_n_words").alias("n_words"), F.col("_n_hit").alias("n_hit"),
        F.size("_items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("_items"), ","), 256).alias("items_sha256"),
        (F.col("_n_hit") > 0).alias("contaminated"))


@query
def op2_toxicity(spark, sf):
    small_batches(spark)
    scored = toxicity.scored(table(spark, sf, "documents").select("doc_id", "text"),
                             table(spark, sf, "labels").select("doc_id", "toxic"))
    return scored.select("doc_id", F.col("_held_out").alias("held_out"), F.col("_score").alias("score"),
                         F.col("_predicted").alias("predicted"))


@query
def op5_simhash(spark, sf):
    grouped = simhash.near_groups(table(spark, sf, "documents"))
    return grouped.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                          "component_id")


@query
def op10_lm_scoring(spark, sf):
    return lm.score(table(spark, sf, "documents"))


@query
def op3_suffix_array_dedup(spark, sf):
    return substring.repeats(table(spark, sf, "documents")).drop("runs")


@query
def op1_pii(spark, sf):
    found = pii.find(table(spark, sf, "documents").select("doc_id", "text")).drop("text")
    return found.select(
        "doc_id", *[pii.count_of("_base", kind).alias(f"n_{kind}") for kind in pii.KINDS],
        F.sha2(pii.written("_base"), 256).alias("base_sha256"), pii.written("_spans").alias("spans"))


@query
def op11_hard_negatives(spark, sf):
    return negatives.mine(table(spark, sf, "embeddings"))


ORACLES["op11_hard_negatives"] = r"""
WITH sound AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, r.vec_id AS id, a.label = r.label AS same,
         CAST(list_dot_product(a.v, r.v) AS BIGINT) AS score
  FROM sound a JOIN sound r ON a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id
), positives AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, s.id AS negative_id, positive_score,
       s.score AS negative_score
FROM positives JOIN scored s USING (anchor_id)
WHERE NOT s.same AND 80 * positive_score <= 100 * s.score AND s.score <= positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.id)
QUALIFY row_number() OVER w <= 5
"""


@query
def op12_ngram_jaccard(spark, sf):
    return jaccard.similar_groups(table(spark, sf, "documents"))


@query
def op13_lexical_search(spark, sf):
    return lexical.rank(table(spark, sf, "documents").select("doc_id", "text"), table(spark, sf, "benchmark"))


ORACLES["op13_lexical_search"] = r"""
WITH doc_terms AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents
), item_terms AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
), totals AS (SELECT count(*) AS n_docs, CAST(sum(len(terms)) AS BIGINT) AS n_terms FROM doc_terms WHERE len(terms) > 0
), held AS (
  SELECT r, any_value(doc_id) AS doc_id, any_value(len(terms)) AS n, term, count(*) AS tf
  FROM (SELECT r, doc_id, terms, unnest(terms) AS term FROM doc_terms)
  WHERE term IN (SELECT term FROM item_terms) GROUP BY r, term
), weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM held, totals GROUP BY term, n_docs
), parts AS (
  SELECT r, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_terms))) AS part
  FROM held JOIN weights USING (term), totals
), scored AS (
  SELECT item_id, doc_id, CAST(sum(part) AS BIGINT) AS score FROM item_terms JOIN parts USING (term)
  GROUP BY item_id, r, doc_id HAVING sum(part) > 0
)
SELECT item_id, CAST(row_number() OVER w AS INTEGER) AS rank, doc_id, score FROM scored
WINDOW w AS (PARTITION BY item_id ORDER BY score DESC, doc_id)
QUALIFY row_number() OVER w <= 50
"""


ORACLES["op9_decontamination"] = r"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents
), items AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark
), windows AS (
  SELECT DISTINCT item, least(10, len(words)) AS n, array_to_string(words[i:i + least(10, len(words)) - 1], ' ') AS w
  FROM items, unnest(range(1, greatest(len(words) - 9, 1) + 1)) t(i) WHERE len(words) > 0
), here AS (
  SELECT doc_id, i, n, array_to_string(words[i:i + n - 1], ' ') AS w
  FROM docs, (SELECT DISTINCT n FROM windows), unnest(range(1, len(words) - n + 2)) t(i)
), met AS (SELECT * FROM here SEMI JOIN windows USING (n, w)
), hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM met, unnest(range(i, i + n)) t(p) GROUP BY doc_id
), found AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item FROM met JOIN windows USING (n, w)) GROUP BY doc_id
)
SELECT doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit USING (doc_id) LEFT JOIN found USING (doc_id)
"""
