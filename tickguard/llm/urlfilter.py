"""URL filter: a blocked Bloom filter in front of an exact hash join.

The list holds rules (host and path prefix, block or allow) and single canonical
URLs to block. Every URL has a few keys under which the list could name it: its
host's suffixes with its path's prefixes, and its canonical form. Keys that the
Bloom filter lets pass meet the list in an exact join, which removes the false
positives; the longest rule wins.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickguard.llm.common import lower_ascii
from tickguard.session import settle

WORDS = 8                 # a block is eight 64-bit words, one bit set in each per key
BITS_PER_KEY = 16
MAX_BLOCKS = 1 << 16      # bounds the broadcast filter at about 5 MB; a longer list only
                          # lets more false positives through to the exact join
RULE, URL = "r", "u"


def _rest(url: str | Column) -> Column:
    """What follows the first ``://``; empty if there is none or the url is null."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host_of(url: str | Column) -> Column:
    return lower_ascii(F.regexp_extract(_rest(url), r"^([^/?#]*)", 1))


def path_of(url: str | Column) -> Column:
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def canonical(host: Column, path: Column) -> Column:
    """Host without user, port and a leading ``www.``; path without its last slash."""
    plain = F.regexp_replace(host, r"^[^@]*@|:[0-9]*$", "")
    return F.concat(F.regexp_replace(plain, r"^www\.", ""), F.regexp_replace(path, r"/$", ""))


def _bits(key: str) -> list[Column]:
    """One bit for each word of the key's block."""
    return [F.expr(f"shiftleft(1L, cast(shiftrightunsigned(xxhash64({key}, 1), {6 * i}) & 63 as int))")
            for i in range(WORDS)]


def bloom_filter(keys: DataFrame, key: str) -> tuple[DataFrame, int]:
    """The blocks of the filter: (block, w0 .. w7), and how many blocks there may be."""
    blocks = max(1, min(MAX_BLOCKS, -(-keys.count() * BITS_PER_KEY // (64 * WORDS))))
    words = [F.bit_or(bit).alias(f"w{i}") for i, bit in enumerate(_bits(key))]
    return keys.groupBy(F.pmod(F.xxhash64(key), F.lit(blocks)).alias("block")).agg(*words), blocks


def may_hold(rows: DataFrame, key: str, bloom: DataFrame, blocks: int) -> DataFrame:
    """The rows whose key the filter may hold."""
    hit = reduce(lambda a, b: a & b, (
        F.col(f"w{i}").bitwiseAND(bit) == bit for i, bit in enumerate(_bits(key))))
    probed = rows.withColumn("block", F.pmod(F.xxhash64(key), F.lit(blocks)))
    return (probed.join(F.broadcast(bloom), "block").filter(hit)
            .drop("block", *[f"w{i}" for i in range(WORDS)]))


def filter_urls(pages: DataFrame, rules: DataFrame, listed: DataFrame, url: str = "url") -> DataFrame:
    """``pages`` with ``_host``, ``_path``, ``_rule`` and ``_verdict``.

    ``rules`` has host, path and verdict; a rule fits its host and the host's
    subdomains if the path starts with the rule's. ``listed`` has host and path
    of URLs to block. Without a fitting rule a listed URL is blocked, and all
    else allowed. Of equally long rules block wins.

    A null url, or one without ``://``, has an empty host and path and is
    allowed. Repeated rows are judged alike and all kept. An empty list allows
    everything. Other columns of ``pages`` pass through.

    URLs are judged once each and joined back: a busy key is one row until
    then, and adaptive execution splits the pages of a busy URL.
    """
    pages = pages.withColumns({"_host": host_of(F.col(url)), "_path": path_of(F.col(url))})
    rules = rules.select(
        F.concat(F.lit(RULE), "host", F.lit("|"), "path").alias("key"),
        F.concat("host", "path").alias("rule"), "verdict",
        F.length("path").alias("chars"), F.size(F.split("host", r"\.")).alias("labels"))
    urls = listed.select(F.concat(F.lit(URL), canonical(F.col("host"), F.col("path"))).alias("key"))
    entries = settle(rules.select("key", "rule", "verdict").union(
        urls.distinct().select("key", F.lit(None).cast("string"), F.lit("block"))), "urls")
    bloom, blocks = bloom_filter(entries, "key")

    # Only suffixes and prefixes as long as some rule's are tried; both counts are
    # bounded by the longest rule.
    shape = rules.agg(F.max("labels"), F.array_sort(F.collect_set("chars"))).first()
    labels, chars = shape[0] or 0, shape[1] or []
    parts = F.split("_host", r"\.")
    tails = F.transform(F.sequence(F.lit(1), F.least(F.size(parts), F.lit(labels))),
                        lambda n: F.array_join(F.slice(parts, -n, n), "."))
    heads = F.array(*[F.when(F.length("_path") >= n, F.substring("_path", 1, n)) for n in chars])
    by_rule = F.flatten(F.transform(tails, lambda t: F.transform(
        F.array_compact(heads), lambda h: F.concat(F.lit(RULE), t, F.lit("|"), h))))
    own = F.array(F.concat(F.lit(URL), canonical(F.col("_host"), F.col("_path"))))
    keys = F.concat(by_rule, own) if labels and chars else own

    judged = (
        may_hold(pages.select("_host", "_path").distinct()
                 .select("_host", "_path", F.explode(keys).alias("key")), "key", bloom, blocks)
        .join(entries, "key")
        .groupBy("_host", "_path")
        .agg(F.max(F.struct(F.col("rule").isNotNull().alias("by_rule"),
                            F.length("rule").alias("chars"), "verdict", "rule")).alias("_best")))
    return (pages.join(judged.hint("merge"), ["_host", "_path"], "left")
            .withColumns({"_rule": F.col("_best.rule"),
                          "_verdict": F.coalesce("_best.verdict", F.lit("allow"))})
            .drop("_best"))
