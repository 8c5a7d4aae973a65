"""Join many facts with one row per group, whatever the size or skew of the groups."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickguard.session import settle

BROADCAST_BYTES = 32 << 20
HOT_ROWS = 2_000_000
# Hot groups that are listed one by one; the list is broadcast.
LISTED_GROUPS = 100_000


def written_bytes(rows: DataFrame) -> int:
    """Size of a settled table's rows as text, which is close to what a broadcast holds."""
    return rows.agg(F.sum(F.octet_length(F.to_json(F.struct("*"))))).first()[0] or 0


def attach(
    facts: DataFrame,
    groups: DataFrame,
    on: list[str],
    weight: str,
    *,
    deal_by: list[str] | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Inner join of ``facts`` with ``groups`` (unique on ``on``).

    ``weight`` is the group's number of facts. The groups are settled and
    measured first. Up to ``broadcast_bytes`` of them are broadcast, so the facts
    do not move. Beyond that both sides are shuffled by key, and every group of
    more than ``hot_rows`` facts is split over several partitions: its row is
    repeated once per salt and its facts are spread over the salts.

    Salts are dealt by a hash of the ``deal_by`` columns, which should tell the
    facts of a group apart. Without them the facts are settled too, and dealt by
    their place in what was written, which spreads identical copies: a retried
    task then reads the same rows and deals the same salts again.
    """
    groups = settle(groups, "groups")
    if written_bytes(groups) <= broadcast_bytes:
        return facts.join(F.broadcast(groups), on)

    heaviest, total = groups.agg(F.max(weight), F.sum(weight)).first()
    salts = F.ceil(F.col(weight) / F.lit(hot_rows)).cast("int")
    facts = facts.filter(reduce(lambda a, b: a & b, (F.col(key).isNotNull() for key in on)))
    if not deal_by:
        facts = settle(facts, "facts")
    if (total or 0) // hot_rows <= LISTED_GROUPS:
        hot = groups.filter(F.col(weight) > hot_rows).select(*on, salts.alias("_salts"))
        facts = facts.join(F.broadcast(hot), on, "left")
        count = F.coalesce("_salts", F.lit(1))
        copies = F.greatest(salts, F.lit(1))
    else:
        # Too many hot groups to list: all are dealt over as many salts as the heaviest needs.
        count = copies = F.lit(-(-heaviest // hot_rows)).cast("int")
    turn = (F.pmod(F.xxhash64(*deal_by), count) if deal_by
            else F.pmod(F.xxhash64(F.monotonically_increasing_id()), count))
    dealt = facts.withColumn("_salt", turn.cast("int")).drop("_salts")
    repeated = groups.withColumn("_salt", F.explode(F.sequence(F.lit(0), copies - 1)))
    return dealt.join(repeated.hint("shuffle_merge"), [*on, "_salt"]).drop("_salt")
