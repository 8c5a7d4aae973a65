"""Exact linear-interpolation quantiles per group, without gathering a group.

A sketch per group proposes cut values closely around each wanted quantile. The
cuts only divide the work: ranks are counted exactly, so a poor sketch costs
time and never changes a result. Equal values are counted before they are
ranked, and only the narrow segments that hold a wanted rank are sorted.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickguard.functions.scalars import number
from tickguard.operators.attach import attach
from tickguard.session import settle

MARGIN = 0.0005
ACCURACY = 20_000


def exact_quantiles(
    df: DataFrame, key: str, value: str, wanted: dict[str, float], **sizes,
) -> DataFrame:
    """One row per key: its number of values ``rows``, and a column per entry of
    ``wanted`` (name: fraction)."""
    facts = (
        df.select(key, number(F.col(value)).alias("x"))
        .filter(F.col("x").isNotNull() & F.col(key).isNotNull()))
    edges = sorted({min(1.0, max(0.0, q + side)) for q in wanted.values()
                    for side in (-MARGIN, MARGIN)})
    sketches = facts.groupBy(key).agg(
        F.count("x").alias("total"), F.percentile_approx("x", edges, ACCURACY).alias("cuts"))
    counts = settle(facts.groupBy(key, "x").agg(F.count(F.lit(1)).alias("copies")), "counts")
    segment = reduce(lambda a, b: a + b, (
        F.when(F.col("x") > F.col("cuts")[i], 1).otherwise(0) for i in range(len(edges))))
    cut = attach(counts, sketches, [key], "total",
                 deal_by=["x"], **sizes).withColumn("segment", segment)

    # At most len(edges) + 1 segments per key.
    sizes_of = cut.groupBy(key, "segment", "total").agg(
        F.sum("copies").alias("held"), F.count(F.lit(1)).alias("distinct_values"))
    before = F.coalesce(F.sum("held").over(
        Window.partitionBy(key).orderBy("segment")
        .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    spot = {name: (F.col("total") - 1) * F.lit(float(q)) for name, q in wanted.items()}
    ranks = [f(p).cast("long") for p in spot.values() for f in (F.floor, F.ceil)]
    needed = sizes_of.withColumn("before", before).filter(reduce(
        lambda a, b: a | b,
        ((r >= F.col("before")) & (r < F.col("before") + F.col("held")) for r in ranks)))

    picked = attach(cut.drop("total", "cuts"), needed.drop("held"),
                    [key, "segment"], "distinct_values", deal_by=["x"], **sizes)
    upto = F.col("before") + F.sum("copies").over(
        Window.partitionBy(key, "segment").orderBy("x")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ranked = picked.withColumn("upto", upto)

    def at(rank):
        return F.max(F.when((rank < F.col("upto")) & (rank >= F.col("upto") - F.col("copies")),
                            F.col("x")))

    found = []
    for name, p in spot.items():
        low, high = at(F.floor(p).cast("long")), at(F.ceil(p).cast("long"))
        part = F.max(p - F.floor(p))
        found.append((low + (high - low) * part).alias(name))
    return ranked.groupBy(key).agg(F.max("total").alias("rows"), *found)
