"""Hot groups: same results when split, and no task that holds a whole group."""

import random
from statistics import quantiles as py_quantiles

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickguard.operators import dedup
from tickguard.operators import zscore as Z
from tickguard.operators.attach import attach
from tickguard.operators.quantiles import exact_quantiles
from tickguard.operators.trailing import between_totals
from tickguard.plans import reports
from tickguard.sources.trades import watched
from tickguard.streaming.sinks import in_symbol_order
from support import rows_of

SPLIT = {"broadcast_bytes": 0, "hot_rows": 50}


@pytest.fixture
def uncoalesced(spark):
    """Keep small shuffle partitions apart, as large ones would be."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.fixture(scope="module")
def hot(spark):
    """3,000 trades; one symbol holds a third of them, many of those identical copies."""
    rnd = random.Random(5)
    rows = [("HOT" if i % 3 == 0 else f"S{rnd.randrange(40)}",
             100.0 if i % 6 == 0 else round(rnd.gauss(100, 9), 2)) for i in range(3000)]
    return spark.createDataFrame(rows, "symbol string, price double").selectExpr(
        "*", "1.0D AS volume", "timestamp_seconds(1700000000) AS event_time")


def test_split_join_equals_broadcast_join(hot):
    plain, split = Z.batch_zscores(hot), Z.batch_zscores(hot, **SPLIT)
    assert rows_of(plain) == rows_of(split)
    assert plain.count() > 0


def test_hot_group_and_its_copies_are_spread(hot, uncoalesced):
    stats = hot.groupBy("symbol").agg(F.count(F.lit(1)).alias("n"))
    joined = attach(hot, stats, ["symbol"], "n", **SPLIT)
    assert joined.count() == 3000
    held = (attach(hot, stats, ["symbol"], "n", **SPLIT)
            .filter("symbol = 'HOT' and price = 100.0")
            .groupBy(F.spark_partition_id()).count().collect())
    assert len(held) > 1
    plan = joined._jdf.queryExecution().toString()
    assert "SortMergeJoin" in plan and "_salt" in plan


def test_facts_out_of_a_shuffle_are_written_before_they_are_dealt(hot, uncoalesced):
    """A retried task must deal its rows the same salts again, so it may not read a shuffle."""
    shuffled = hot.repartition(5)
    stats = hot.groupBy("symbol").agg(F.count(F.lit(1)).alias("n"))
    joined = attach(shuffled, stats, ["symbol"], "n", **SPLIT)
    assert joined.count() == 3000
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "Repartition" not in plan and "rand(" not in plan


def test_more_hot_groups_than_can_be_listed(hot, monkeypatch):
    from tickguard.operators import attach as module

    monkeypatch.setattr(module, "LISTED_GROUPS", 3)
    assert rows_of(Z.batch_zscores(hot, **SPLIT)) == rows_of(Z.batch_zscores(hot))


def test_watch_table_long_or_short(spark, hot):
    watch = spark.createDataFrame([("HOT",), ("S1",), ("S1",), ("absent",)], "symbol string")
    want = rows_of(hot.filter("symbol in ('HOT', 'S1')"))
    assert rows_of(watched(hot, ["HOT", "S1"])) == want
    assert rows_of(watched(hot, watch)) == want
    assert rows_of(watched(hot, watch, **SPLIT)) == want


@pytest.mark.parametrize("sizes", [{}, SPLIT])
def test_exact_quantiles(spark, sizes):
    rnd = random.Random(1)
    data = {"even": [float(i) for i in range(100)], "one": [4.5], "two": [1.0, 2.0],
            "ties": [7.0] * 500 + [8.0] * 3, "wild": [rnd.lognormvariate(0, 4) for _ in range(2001)]}
    df = spark.createDataFrame([(k, v) for k, vs in data.items() for v in vs] + [("one", None)],
                               "k string, v double")
    wanted = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.999, "e": 1.0}
    got = {r.k: r for r in exact_quantiles(df, "k", "v", wanted, **sizes).collect()}
    assert got.keys() == data.keys()
    for k, values in data.items():
        for name, q in wanted.items():
            assert got[k][name] == pytest.approx(np.quantile(values, q), rel=1e-12)


def test_box_statistics(spark):
    values = [float(v) for v in [1, 2, 3, 4, 5, 6, 7, 8, 9, 100, -60]]
    df = spark.createDataFrame([("A", v) for v in values], "symbol string, volatility_ratio double")
    box = reports.box_statistics(df).first()
    q1, q2, q3 = py_quantiles(values, n=4, method="inclusive")
    assert (box.q1, box.median, box.q3) == (q1, q2, q3)
    assert (box.whisker_low, box.whisker_high, box.outliers, box.alerts) == (1.0, 9.0, 2, 11)


def test_layout_keeps_symbol_order_across_several_partitions(spark, uncoalesced):
    df = spark.range(4000).selectExpr(
        "if(id % 3 = 0, 'HOT', concat('S', id % 7)) AS symbol", "1.0D AS price", "1.0D AS volume",
        "timestamp_millis(1700000000000 + (id * 7919) % 4001) AS event_time", "id")
    placed = in_symbol_order(df, "id").select(
        "symbol", "event_time", F.spark_partition_id().alias("part"),
        F.monotonically_increasing_id().alias("position")).collect()
    assert len(placed) == 4000
    assert len({r.part for r in placed if r.symbol == "HOT"}) > 1
    for symbol in {r.symbol for r in placed}:
        times = [r.event_time for r in sorted(placed, key=lambda r: r.position) if r.symbol == symbol]
        assert times == sorted(times)


def test_keep_first_combines_before_the_shuffle(hot):
    kept = dedup.keep_first(hot.withColumn("batch_id", F.lit(1)), ["symbol", "price"], ["batch_id"])
    assert kept.count() == hot.select("symbol", "price").distinct().count()
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("partial_min_by") >= 1


@pytest.mark.parametrize("blocks", [2, 3, 6, 7, 60, 1200])
def test_block_totals_of_sparse_symbols_grow_with_a_logarithm(spark, blocks):
    """One busy symbol has trades in every block, thirty others in few, also before 1970."""
    rnd = random.Random(blocks)
    prices = {("BUSY", b): 1.0 + b % 7 for b in range(-500, 2000)}
    prices |= {(f"S{k}", rnd.randrange(-500, 2000)): float(k) for k in range(30) for _ in range(4)}
    totals = spark.createDataFrame(
        [(s, b, 1, p, 0.0, p, p) for (s, b), p in prices.items()],
        "symbol string, block long, n long, mean double, m2 double, low double, high double")
    made = between_totals(totals, blocks).collect()
    parts = {}
    for r in made:
        parts.setdefault((r.symbol, r.block), []).append(r)
    assert max(map(len, parts.values())) <= 2 * blocks.bit_length()
    for symbol, block in prices:
        inside = [p for b in range(block - blocks + 1, block) if (p := prices.get((symbol, b))) is not None]
        got = parts.get((symbol, block), [])
        assert sum(r.n for r in got) == len(inside)
        if inside:
            assert (min(r.low for r in got), max(r.high for r in got)) == (min(inside), max(inside))
            assert sum(r.n * r.mean for r in got) == pytest.approx(sum(inside))
            middle = sum(inside) / len(inside)
            spread = sum(r.m2 + r.n * (r.mean - middle) ** 2 for r in got)
            assert spread == pytest.approx(sum((p - middle) ** 2 for p in inside), abs=1e-6)
