"""Stored sketches, the maintained latest revisions and numbered messages."""

import os
import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from support import START, at, rows_of
from tickguard.operators import alert_store, latest, sketches
from tickguard.operators.dedup import latest_revision
from tickguard.streaming import compaction, sinks

LAYOUT = ("window_start timestamp, window_end timestamp, symbol string, count_trades long, mean_price double, "
          "batch_id long")


def test_sketches_answer_every_range_within_their_bound_in_any_order_of_batches(spark, trades, tmp_path):
    rng = random.Random(3)
    rows = [("AB"[rng.random() < 0.3], rng.lognormvariate(3, 1), rng.uniform(0, 4 * 86400)) for _ in range(20_000)]
    rows += [("A", float("nan"), 5), ("A", None, 5), ("A", 1.0, None), (None, 7.0, 6)]
    table = trades(rows).withColumn("who", F.col("volume") + F.floor(F.rand(1) * 3000))
    lots = [table.filter(F.pmod(F.xxhash64("price", "event_time"), F.lit(3)) == k) for k in range(3)]
    for name, order in (("one", (0, 1, 2)), ("two", (2, 0, 1, 0))):           # a replayed batch counts once
        for k in order:
            sketches.add_batch(lots[k], str(tmp_path / name), k, "who")
    one, two = (sketches.read_store(spark, str(tmp_path / n)) for n in ("one", "two"))
    sound = [r for r in rows if r[1] == r[1] and None not in r[1:]]
    for first in range(4):
        for last in range(first, 4):
            days = [(START + timedelta(days=d)).strftime("%Y-%m-%d") for d in (first, last)]
            for r in sketches.box(sketches.between(one, *days), "symbol").collect():
                mine = [p for s, p, t in sound if s == r.symbol and first <= t // 86400 <= last]
                assert (r.n, r.low, r.high) == (len(mine), min(mine), max(mine))
                for share, got in ((0.25, r.q1), (0.5, r.median), (0.75, r.q3)):
                    slack = sketches.RANK_ERROR * len(mine) + 1
                    assert sum(p < got for p in mine) <= share * len(mine) + slack
                    assert sum(p <= got for p in mine) >= share * len(mine) - slack
    exact = table.filter("price is not null and not isnan(price) and event_time is not null")
    wanted = exact.agg(F.count_distinct("who")).first()[0]
    counts = [sketches.distinct_count(s).first()[0] for s in (one, two)]
    assert counts[0] == counts[1] and abs(counts[0] - wanted) <= sketches.DISTINCT_ERROR * wanted
    bins = sketches.histogram(one).orderBy("bin").collect()
    assert len(bins) == 30 and abs(sum(b.trades for b in bins) - len(sound)) < 1e-6
    for b in bins:
        inside = sum((b.bin_from < p or b.bin == 1) and p <= b.bin_to for _, p, _ in sound)
        assert abs(b.trades - inside) <= 2 * sketches.RANK_ERROR * len(sound) + 1
    assert sketches.read_store(spark, str(tmp_path / "none")).count() == 0
    flat = trades([("A", 5.0, k) for k in range(4)])
    sketches.add_batch(flat, str(tmp_path / "flat"), 0)
    assert rows_of(sketches.histogram(sketches.read_store(spark, str(tmp_path / "flat"))).filter("trades > 0"),
                   "bin", "trades") == [(1, 4.0)]


def test_latest_table_equals_the_recompute_after_each_batch_and_leaves_other_days(spark, tmp_path):
    rng, root, seen = random.Random(7), str(tmp_path / "latest"), []
    for batch in range(10):
        day = 86400 * (batch // 3)
        new = [(at(day + 600 * rng.randrange(5)), at(day + 9999), rng.choice("AB"), rng.randrange(9), rng.random(), batch)
               for _ in range(6)] + ([(None, None, "A", 1, 1.0, batch)] if batch in (2, 8) else [])
        before = {f: os.path.getmtime(f) for f in files_of(root)}
        latest.merge_batch(spark.createDataFrame(new, LAYOUT), root)
        seen += new
        want = latest_revision(spark.createDataFrame(seen, LAYOUT))
        got = latest.read_latest(spark, root, LAYOUT)
        assert rows_of(got.drop("day")) == rows_of(want)
        touched = f"day={(START + timedelta(seconds=day)).strftime('%Y-%m-%d')}"
        for f, when in before.items():
            if touched not in f and "day=none" not in f:
                assert os.path.getmtime(f) == when
    latest.merge_batch(spark.createDataFrame(seen[:10], LAYOUT), root)           # an old batch again
    assert rows_of(latest.read_latest(spark, root, LAYOUT).drop("day")) == rows_of(want)


def files_of(root):
    return [os.path.join(d, f) for d, _, names in os.walk(root) for f in names if f.endswith(".parquet")]


def test_numbers_are_gapless_and_in_order_with_a_busy_symbol(spark, trades):
    rng = random.Random(1)
    rows = [("A" if k % 3 == 0 else rng.choice("BCDEFGH"), float(k), rng.randrange(400)) for k in range(3000)]
    rows += [(None, 1.0, 5), (None, 2.0, 4), ("A", 0.5, None)] + [("A", 9.0, 7)] * 3
    made = sinks.numbered(trades(rows), "price").select("symbol", "event_time", "price", "sequence")
    by = {}
    for symbol, when, price, number in made.collect():
        by.setdefault(symbol, []).append((number, (when is not None, when or START, price)))
    assert sum(map(len, by.values())) == len(rows)
    for numbered in by.values():
        numbered.sort()
        assert [n for n, _ in numbered] == list(range(1, len(numbered) + 1))
        assert [o for _, o in numbered] == sorted(o for _, o in numbered)
    assert sinks.numbered(trades([])).count() == 0


def test_range_of_the_alert_store_reads_part_of_it(spark, tmp_path):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")        # whole lists of filters in the plan's text
    rng, root = random.Random(2), str(tmp_path / "store")
    day = [START.replace(tzinfo=None) + timedelta(days=d) for d in range(3)]
    rows = [(rng.choice(day) + timedelta(seconds=rng.randrange(86400)), "BUSY" if k % 3 == 0 else f"S{rng.randrange(50):02}",
             rng.lognormvariate(2, 1) * rng.choice((-1, 1))) for k in range(60_000)]
    rows += [(None, "S01", 9.0), (day[0], None, 9.0), (day[0], "S01", None), (day[0], "S01", 0.0),
             (day[0], "S01", float("nan"))]
    layout = T.StructType([T.StructField("event_time", T.TimestampType()), T.StructField("symbol", T.StringType()),
                           T.StructField("z_score", T.DoubleType())])
    for batch in (0, 1, 0):                                             # a batch that comes again replaces itself
        part = spark.createDataFrame(rows[batch::2], layout)
        alert_store.write_batch(part, root, batch, "event_time", "abs(z_score)", row_group_bytes=1 << 13)
    whole = alert_store.read_store(spark, root, layout)
    assert repr(rows_of(whole, "event_time", "symbol", "z_score")) == repr(sorted(rows, key=repr))
    since, until = day[1] + timedelta(hours=3), day[2] + timedelta(hours=1)
    for chosen, low, high in ((["S07"], 30.0, None), (["BUSY", "S11"], 2.0, 2.5), (None, 60.0, 90.0), (["S07"], None, None)):
        got = alert_store.read_range(spark, root, layout, "event_time", chosen, low, high,
                                     since.strftime("%F %T"), until.strftime("%F %T"))
        want = [r for r in rows if r[0] is not None and since <= r[0] <= until
                and (chosen is None or r[1] in chosen)
                and (low is None or abs(r[2]) >= low) and (high is None or abs(r[2]) <= high)]
        assert rows_of(got.drop("batch_id")) == sorted(want, key=repr)
        plan = got._jdf.queryExecution().executedPlan()
        text = plan.toString()
        assert "PartitionFilters: [isnotnull(alert_day" in text
        assert ("GreaterThanOrEqual(alert_size" in text) == (low is not None)
        got._jdf.queryExecution().toRdd().count()
        read = plan.collectLeaves().head().metrics().apply("numOutputRows").value()
        assert len(want) <= read < 2 / 3 * len(rows) / 2                # of two days, less than half
    assert alert_store.read_range(spark, str(tmp_path / "none"), layout, "event_time", ["A"], 1).count() == 0
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def test_compaction_keeps_the_rows_also_when_a_round_dies(spark, trades, tmp_path, monkeypatch):
    root, store = str(tmp_path / "lots"), str(tmp_path / "store")
    count, target = 0, 60_000

    def lot(n):
        nonlocal count
        sinks.write_lines(trades([("A", count + k, k) for k in range(n)]).repartition(6), root)
        count += n

    def same():
        assert sorted(r.p for r in compaction.read_lots(spark, root, store).collect()) == list(map(float, range(count)))

    assert compaction.read_lots(spark, root, store).count() == 0 and compaction.compact(spark, root, store) == 0
    lot(3000)
    same()
    (tmp_path / "lots" / "part-odd.json").write_text('{"broken\n\n{"s":"Z"}\n')
    odd = compaction.read_lots(spark, root, store).filter("p is null").count()
    (tmp_path / "lots" / "part-empty.json").write_text("")
    files = compaction.live_files(spark, root, store).count()
    assert compaction.compact(spark, root, store, target) == files >= 7
    assert compaction.read_lots(spark, root, store).filter("p is null").count() == odd == 2
    live = compaction.live_files(spark, root, store).collect()
    assert len(live) < files and all(r.merged and r.bytes <= target for r in live)
    (tmp_path / "lots" / "part-odd.json").unlink()
    lot(2000)

    def numbers():
        return sorted(r.p for r in compaction.read_lots(spark, root, store).filter("p is not null").collect())

    assert numbers() == list(map(float, range(count)))
    for step in ("commit", "write_merged"):                             # dies after, and before, the merged files
        with monkeypatch.context() as m:
            m.setattr(compaction, step, lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
            with pytest.raises(RuntimeError):
                compaction.compact(spark, root, store, target)
        assert numbers() == list(map(float, range(count)))
    half = tmp_path / "store" / "manifest" / "0000000001"               # a manifest without its end mark
    half.mkdir()
    (half / "part-0.parquet").write_bytes(b"PAR1")
    assert numbers() == list(map(float, range(count)))
    assert compaction.compact(spark, root, store, target) > 0
    assert numbers() == list(map(float, range(count)))
    sizes = sorted(r.bytes for r in compaction.live_files(spark, root, store).collect())
    assert sum(s < target // 2 for s in sizes) <= 1
    while compaction.compact(spark, root, store, target):
        assert numbers() == list(map(float, range(count)))
    assert compaction.retired_files(spark, store).filter("file like '%lots%'").count() >= 13
