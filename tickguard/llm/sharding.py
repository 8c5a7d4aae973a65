"""Sharding by histogram sort: shards of near equal bytes, cut in one key order.

Rows are ordered by the hash of their text, then of their id. The cuts between
shards are found by counting: every round sums the exact bytes below a few probes
per cut, over all partitions, and narrows each cut's bracket, until the bytes
below it are within the tolerance of its share. Only then do the rows move, once.
Equal texts share a key, so they share a shard unless one text outgrows the
tolerance; then the cut goes on by id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickguard.session import settle

PROBES = 15
TOLERANCE = 1e-4          # of a shard's share
SLOT_ROWS = 10_000       # rows that one task numbers
SIGN, WIDTH = 1 << 63, 1 << 64
LAST = WIDTH * WIDTH


def _below(cut: int) -> Column:
    """Rows whose key (_k1, _k2) is below ``cut``, the pair as one 128-bit number."""
    k1, k2 = divmod(cut, WIDTH)
    if k1 >= WIDTH:
        return F.lit(True)
    k1, k2 = k1 - SIGN, k2 - SIGN
    return (F.col("_k1") < k1) | ((F.col("_k1") == k1) & (F.col("_k2") < k2))


def splitters(keyed: DataFrame, shards: int, tolerance: float = TOLERANCE) -> list[int]:
    """The keys at which shards begin, found by counting bytes below probes.

    ``keyed`` has _k1, _k2 and size. Every round is one aggregate of a fixed
    number of sums. A cut whose bracket holds no two different keys is as good
    as it gets.
    """
    total = keyed.agg(F.sum("size")).first()[0] or 0
    slack = tolerance * total / shards
    want = [total * j / shards for j in range(1, shards)]
    low, high = [(0, 0)] * (shards - 1), [(LAST, total)] * (shards - 1)   # (key, bytes below it)
    done: list[int | None] = [0 if not total else None] * (shards - 1)
    while None in done:
        asked: dict[tuple, Column] = {}
        for j, at in enumerate(done):
            if at is not None:
                continue
            (a, _), (b, _) = low[j], high[j]
            step = max(1, (b - a) // (PROBES + 1))
            for probe in range(a + step, b, step):
                asked[j, probe] = F.sum(F.when(_below(probe), F.col("size")).otherwise(0))
            inside = ~_below(a) & _below(b)
            pair = F.struct("_k1", "_k2")
            asked[j, "least"] = F.min(F.when(inside, pair))
            asked[j, "most"] = F.max(F.when(inside, pair))
        found = dict(zip(asked, keyed.agg(*[c.alias(f"c{i}") for i, c in enumerate(asked.values())])
                         .first(), strict=True))
        for j, at in enumerate(done):
            if at is not None:
                continue
            for (i, probe), n in found.items():
                if i != j or isinstance(probe, str):
                    continue
                if n <= want[j] and n >= low[j][1] and probe > low[j][0]:
                    low[j] = (probe, n)
                if n >= want[j] and (n, probe) < (high[j][1], high[j][0]):
                    high[j] = (probe, n)
            nearest = min(low[j], high[j], key=lambda at: abs(at[1] - want[j]))
            ends = [e and (e[0] + SIGN) * WIDTH + e[1] + SIGN
                    for e in (found[j, "least"], found[j, "most"])]
            if abs(nearest[1] - want[j]) <= slack or ends[0] is None:
                done[j] = nearest[0]
                continue
            # Nothing lies outside the keys seen: the bracket shrinks to them.
            if ends[0] > low[j][0]:
                low[j] = (ends[0], low[j][1])
            if ends[1] + 1 < high[j][0]:
                high[j] = (ends[1] + 1, high[j][1])
            if high[j][0] - low[j][0] <= 1:
                done[j] = min(low[j], high[j], key=lambda at: abs(at[1] - want[j]))[0]
    return done


def shard(docs: DataFrame, shards: int, tolerance: float = TOLERANCE) -> DataFrame:
    """``docs`` with ``_size``, ``_shard`` (0 to shards - 1) and ``_slot`` (gapless in the shard).

    A row's size is the UTF-8 length of its text plus one; a null text has
    none. Shards hold equal bytes within the tolerance, or as near as whole rows
    allow. Repeated rows are rows of their own; which of two equal rows gets
    which slot makes no difference. An empty table gives an empty table. Other
    columns pass through.

    Slots follow a hash of the row within buckets of a bounded number of rows:
    bucket counts give each bucket its first slot, so no task numbers a whole shard.
    The rows are exchanged once, for this numbering.
    """
    columns = docs.columns
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1
    k1 = F.xxhash64(F.coalesce("text", F.lit("")))
    k2 = F.xxhash64("doc_id")
    keyed = settle(docs.select(k1.alias("_k1"), k2.alias("_k2"), size.alias("size")), "keys")
    cuts = splitters(keyed, shards, tolerance)
    buckets = max(1, -(-keyed.count() // (SLOT_ROWS * shards)))
    number = sum((F.when(_below(cut), 0).otherwise(1) for cut in cuts), F.lit(0)).cast("int")
    bucket = F.pmod(F.xxhash64("_k2", "_k1"), F.lit(buckets))
    counts = keyed.groupBy(number.alias("_shard"), bucket.alias("_bucket")).count()
    first = counts.select("_shard", "_bucket", (F.sum("count").over(
        Window.partitionBy("_shard").orderBy("_bucket")) - F.col("count")).alias("_first"))
    placed = (docs.withColumns({"_k1": k1, "_k2": k2, "_size": size})
              .withColumn("_shard", number).withColumn("_bucket", bucket))
    order = Window.partitionBy("_shard", "_bucket").orderBy("_k2", "_k1")
    return (placed.withColumn("_turn", F.row_number().over(order))
            .join(first, ["_shard", "_bucket"])
            .withColumn("_slot", F.col("_first") + F.col("_turn") - 1)
            .select(*columns, "_size", "_shard", "_slot"))
