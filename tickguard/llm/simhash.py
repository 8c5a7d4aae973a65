"""SimHash near-duplicates: fingerprints that differ in few bits, linked into groups.

Only distinct fingerprints are compared. First, fingerprints within two bits of
each other meet at a fingerprint one bit from both: each row is sent to its 65
neighbours and every meeting point links to one of its guests, so a dense cloud of
near copies is joined with a number of rows that is linear in its size. Then
fingerprints that share enough blocks are compared across the groups so far, by
the pigeonhole rule, and verified by their bit distance.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickguard.llm.common import utf8
from tickguard.session import settle

SHINGLE, BITS_APART = 4, 4
CANDIDATES = 0.25         # random fingerprints that a bucket should hold at most
PIECE = 1 << 16           # shingles counted at once


def _fingerprint(text: bytes, size: int) -> int:
    """The majority of each bit over the hashes of all shingles of lower-cased words."""
    words = text.lower().split()
    if not words:
        return 0
    shingled = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    begins = np.concatenate(([0], ends[:-1] + 1))
    n = max(len(words) - size + 1, 1)
    begins, ends = begins[:n].tolist(), ends[min(size, len(words)) - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for at in range(0, n, PIECE):
        hashes = np.array([digest(shingled[a:b], 42) for a, b in
                           zip(begins[at:at + PIECE], ends[at:at + PIECE], strict=True)], ">u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    bits = np.packbits(2 * ones > n)
    return int.from_bytes(bits.tobytes(), "big", signed=True)


def fingerprint(text: str | Column, size: int = SHINGLE) -> Column:
    """64 bits as a long. Null and wordless texts have fingerprint zero."""
    def prints(texts: pa.Array) -> pa.Array:
        return pa.array([_fingerprint(t, size) for t in utf8(texts)], pa.int64())

    return F.arrow_udf(prints, "bigint")(text)


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): the least node it is connected to.

    Alternating stars: all larger neighbours of a node move to its least
    neighbour, then all smaller ones, until nothing moves. The least neighbour is
    an aggregate that combines before its shuffle; no task holds a node's
    neighbours. Each round is written down.
    """
    edges = settle(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                   .filter("a <> b").distinct(), "edges")
    before = None
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (both.filter("b > a").join(least, "a")
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct())
        large = settle(large, "edges")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(least, "a")
        small = joined.select(F.explode(F.array(
            F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b"))
        )).alias("e")).select("e.*").filter("a <> b").distinct()
        edges = settle(small, "edges")
        now = tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == before:
            break
        before = now
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(roots.select("root", "root").distinct().toDF("node", "root"))


def _settle_roots(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(fp, root) for all ``nodes``."""
    found = components(edges).withColumnRenamed("node", "fp")
    return nodes.join(found, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))


def _block_keys(count: int, apart: int) -> list[list[tuple[int, int]]]:
    """Sets of blocks (shift, bits); two fingerprints within ``apart`` bits agree on one set.

    With apart + k blocks at least k agree. More agreeing blocks make longer keys
    and shorter buckets, so k grows with the logarithm of the count.
    """
    agree = 1
    while count / 2 ** (64 * agree / (apart + agree)) > CANDIDATES and agree < 4:
        agree += 1
    blocks = apart + agree
    edges = [64 * i // blocks for i in range(blocks + 1)]
    pieces = [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]
    return [list(c) for c in combinations(pieces, agree)]


def link_groups(prints: DataFrame, apart: int = BITS_APART) -> DataFrame:
    """(fp, root) of the distinct fingerprints in ``prints`` (fp): groups linked within ``apart`` bits."""
    prints = settle(prints.select("fp").distinct(), "prints")
    count = prints.count()

    near = F.concat(F.array("fp"), F.transform(
        F.sequence(F.lit(0), F.lit(63)),
        lambda i: F.col("fp").bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), i))))
    if apart >= 2:
        # The meeting point's least guest stands for it; one guest makes no link. Dealt
        # anew, as few prints would share a task that makes 65 rows of each.
        spread = prints.repartition(int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        met = spread.select("fp", F.explode(near).alias("point"))
        host = (met.groupBy("point").agg(F.min("fp").alias("least"), F.max("fp").alias("most"))
                .filter("least <> most").select("point", "least"))
        links = (met.join(host, "point").filter("fp <> least")
                 .select(F.col("fp").alias("a"), F.col("least").alias("b")).distinct())
        groups = settle(_settle_roots(prints, links), "groups")
    else:
        groups = prints.select("fp", F.col("fp").alias("root"))

    def key(number: int, blocks: list[tuple[int, int]]) -> Column:
        mask = reduce(lambda m, b: m | ((1 << b[1]) - 1) << b[0], blocks, 0)
        mask = mask - (1 << 64) if mask >> 63 else mask
        return F.struct(F.lit(number).alias("n"), F.col("fp").bitwiseAND(F.lit(mask)).alias("v"))

    keys = F.array(*[key(i, blocks) for i, blocks in enumerate(_block_keys(count, apart))])
    dealt = groups.select("fp", "root", F.explode(keys).alias("k")).select("fp", "root", "k.n", "k.v")
    # Two rows of a bucket with different roots: one of them is not of the bucket's
    # largest group, so only rows outside that group search the bucket.
    sizes = dealt.groupBy("n", "v", "root").count()
    largest = (sizes.groupBy("n", "v").agg(
        F.max(F.struct("count", "root"))["root"].alias("main"), F.count(F.lit(1)).alias("roots"))
        .filter("roots > 1").drop("roots"))
    mixed = settle(dealt.join(largest, ["n", "v"]), "buckets")
    one = mixed.filter("root <> main").select("n", "v", F.col("fp").alias("a"), F.col("root").alias("ra"))
    two = mixed.select("n", "v", F.col("fp").alias("b"), F.col("root").alias("rb"), "main")
    close = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= apart
    once = (F.col("rb") == F.col("main")) | (F.col("a") < F.col("b"))
    links = (one.join(two, (one["n"] == two["n"]) & (one["v"] == two["v"]) & (F.col("ra") != F.col("rb"))
                      & once & close)
             .select(F.col("ra").alias("a"), F.col("rb").alias("b")).distinct())
    merged = components(links).select(F.col("node").alias("root"), F.col("root").alias("top"))
    return groups.join(merged, "root", "left").select("fp", F.coalesce("top", "root").alias("root"))


def near_groups(docs: DataFrame, size: int = SHINGLE, apart: int = BITS_APART) -> DataFrame:
    """Per document: doc_id, fp (long) and component_id, the least doc_id it is linked to.

    Documents whose fingerprints differ in at most ``apart`` bits are linked,
    and links chain. Null and empty texts have fingerprint zero and are linked
    like any other. Repeated rows share their group. A null doc_id never names a
    group that has another. An empty table gives an empty table. Other columns
    are not read.
    """
    prints = settle(docs.select("doc_id", fingerprint("text", size).alias("fp")), "fingerprints")
    classes = settle(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "classes")
    groups = settle(link_groups(classes, apart).join(classes, "fp"), "groups")
    least = groups.groupBy("root").agg(F.min("least").alias("component_id"))
    named = groups.join(least, "root").select("fp", "component_id")
    return prints.join(named, "fp").select("doc_id", "fp", "component_id")


def keep_first(docs: DataFrame, size: int = SHINGLE, apart: int = BITS_APART) -> DataFrame:
    """``docs`` without the near copies of an earlier one: of each group the least doc_id stays.

    Rows that repeat that doc_id go too, but for one. A group of null ids
    keeps one row.
    """
    columns = docs.columns
    marked = settle(docs.withColumns({"_row": F.monotonically_increasing_id(),
                                      "_fp": fingerprint("text", size)}), "marked")
    classes = marked.groupBy("_fp").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", "_row")).alias("first"))
    classes = settle(classes.withColumnRenamed("_fp", "fp"), "classes")
    groups = link_groups(classes, apart).join(classes, "fp")
    stay = groups.groupBy("root").agg(F.min("first").alias("first")).select(F.col("first._row").alias("_row"))
    return marked.join(stay, "_row", "left_semi").select(*columns)
