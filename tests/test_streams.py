"""Streams against their table twins, late data, restarts and summaries."""

import json
import random
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tickguard.operators import dedup
from tickguard.operators import volatility as V
from tickguard.operators import zscore as Z
from tickguard.operators.trailing import trailing_zscores
from tickguard.params import FeedRate, VolatilityRule, WindowSpec, ZScoreRule
from tickguard.schema import VOLATILITY_ALERT, ZSCORE_ALERT
from tickguard.session import shared_root, stream_session
from tickguard.sources import message_log
from tickguard.sources import trades as feed
from tickguard.sources.alerts import read_alerts
from tickguard.streaming import jobs, late, sinks
from tickguard.streaming.trailing import trailing_zscore_stream
from support import at, rows_of

EPOCH_MS = 1_704_067_200_000


class Lots:
    """A raw folder that receives one JSON-lines file at a time."""

    def __init__(self, spark, folder):
        self.spark, self.folder, self.count = stream_session(spark, 2), folder, 0
        (folder / "raw").mkdir()

    def add(self, rows):
        self.count += 1
        lines = [json.dumps({"s": s, "p": p, "v": 1.0, "t": EPOCH_MS + int(t * 1000)}) for s, p, t in rows]
        (self.folder / "raw" / f"batch_{self.count:03d}.json").write_text("\n".join(lines) + "\n")

    def stream(self, rate=FeedRate()):
        return feed.to_transactions(feed.readable(
            feed.stream_lines(self.spark, str(self.folder / "raw"), rate)))

    def table(self):
        return feed.to_transactions(feed.readable(
            feed.read_lines(self.spark, str(self.folder / "raw"))))

    def path(self, name):
        return str(self.folder / name)


@pytest.fixture
def lots(spark, tmp_path):
    return Lots(spark, tmp_path)


def minute(start, symbol="A"):
    return [(symbol, 100.0 + (i * 7) % 11, start + i) for i in range(60)]


def test_update_mode_ends_at_the_batch_result(lots):
    spec, rule = WindowSpec(60, 10, 600), VolatilityRule(threshold=0.02)
    for k in range(3):
        lots.add(minute(30 * k))
    query = jobs.drain(jobs.volatility_job(
        lots.stream(FeedRate(files_per_trigger=1)), lots.path("alerts"), lots.path("state"),
        spec, rule, lots.path("summary")))
    assert jobs.progress(query)["input_rows"] == 180
    alerts = read_alerts(lots.spark, lots.path("alerts"), VOLATILITY_ALERT)
    last = dedup.latest_revision(alerts)
    want = V.volatility_alerts(lots.table(), spec, rule)
    keys = ("window_start", "symbol", "count_trades")
    assert rows_of(last, *keys) == rows_of(want, *keys)
    assert alerts.count() > last.count() > 0
    summary = lots.spark.read.json(lots.path("summary") + "/*")
    assert summary.agg({"alerts": "sum"}).first()[0] == alerts.count()


def test_micro_batches_are_scored_on_their_own_and_late_trades_too(lots):
    lots.add([("A", 100.0 + i % 2, i) for i in range(30)] + [("A", 150.0, 31)])
    jobs.drain(jobs.zscore_job(lots.stream(), lots.path("alerts"), lots.path("state")))
    lots.add([("A", 200.0 + i % 2, i - 90000) for i in range(30)] + [("A", 150.0, -90000)])
    jobs.drain(jobs.zscore_job(lots.stream(), lots.path("alerts"), lots.path("state")))
    alerts = read_alerts(lots.spark, lots.path("alerts"), ZSCORE_ALERT)
    found = {(r.batch_id, r.price, r.z_score > 0) for r in alerts.collect()}
    assert found == {(0, 150.0, True), (1, 150.0, False)}


def test_no_intermediate_table_is_left_by_a_batch(lots, spark):
    def settled():
        return set(Path(shared_root(spark)).glob("tickguard/groups-*"))

    before = settled()
    lots.add(minute(0) + [("A", 300.0, 30.5)])
    jobs.drain(jobs.zscore_job(lots.stream(), lots.path("alerts"), lots.path("state")))
    assert read_alerts(lots.spark, lots.path("alerts"), ZSCORE_ALERT).count() == 1
    assert settled() == before


def test_quiet_batch_leaves_a_summary_but_no_folder(lots, tmp_path):
    lots.add(minute(0))
    jobs.drain(jobs.zscore_job(
        lots.stream(), lots.path("alerts"), lots.path("state"), summaries=lots.path("summary")))
    assert not list((tmp_path / "alerts").glob("batch_id=*"))
    row = lots.spark.read.json(lots.path("summary") + "/*").first()
    assert (row.analysed, row.alerts) == (60, 0)
    assert 0 < row.max_measure < 3


def test_totals_go_on_beyond_the_recent_batches(lots):
    totals = jobs.RunTotals()
    lots.spark.streams.addListener(totals)
    try:
        for k in range(104):
            lots.add([("A", 1.0, k)])
        query = jobs.drain(lots.stream(FeedRate(files_per_trigger=1)).writeStream.format("noop")
                           .option("checkpointLocation", lots.path("state")))
        for _ in range(100):
            if totals.of(query)["input_rows"] == 104:
                break
            time.sleep(0.1)
        assert totals.of(query)["input_rows"] == 104
        assert jobs.progress(query)["batches"] <= 100
    finally:
        lots.spark.streams.removeListener(totals)


def test_jobs_take_the_trigger_of_the_feed(lots):
    job = jobs.zscore_job(lots.stream(), lots.path("alerts"), lots.path("state"), rate=FeedRate(trigger_s=7))
    lots.add(minute(0))
    query = job.start()
    try:
        query.processAllAvailable()
        assert "ProcessingTime" in str(query._jsq.streamingQuery().trigger()) if hasattr(
            query._jsq, "streamingQuery") else query.isActive
    finally:
        query.stop()


def test_late_trades_are_dropped_once_their_windows_closed(lots):
    spec = WindowSpec(60, 10, 30)

    def run():
        stats = jobs.window_stats_stream(lots.stream(), spec)
        seen = []

        def keep(batch, batch_id):
            seen.extend((r.symbol, r.window_start, r.count_trades) for r in batch.collect())

        query = jobs.drain(stats.writeStream.outputMode("update").foreachBatch(keep)
                           .option("checkpointLocation", lots.path("state")))
        return seen, jobs.progress(query)

    run_one, _ = (lots.add([("A", 1.0, 0), ("A", 2.0, 600)]), run())[1]
    assert len(run_one) == 12
    lots.add([("A", 3.0, 5), ("A", 4.0, 565)])
    seen, progress = run()
    # The watermark stands at 570: windows that end by then are closed.
    assert {s for _, s, _ in seen} == {
        at(t).replace(tzinfo=None) for t in (520, 530, 540, 550, 560)}
    assert progress["late_rows"] >= 1


def test_sliding_scores_stream_equals_table_on_closed_windows(lots):
    spec, rule = WindowSpec(60, 10, 20), ZScoreRule()
    for k in range(4):
        rows = minute(60 * k) + minute(60 * k, "B") + [("A", 180.0, 60 * k + 30.5)]
        lots.add(rows)
    found = jobs.sliding_zscore_stream(lots.stream(FeedRate(files_per_trigger=1)), spec, rule)
    jobs.drain(found.writeStream.outputMode("append").format("parquet")
               .option("path", lots.path("out")).option("checkpointLocation", lots.path("state")))
    keys = ("event_time", "symbol", "price", "window_start", "count_trades")
    got = rows_of(lots.spark.read.schema(found.schema).parquet(lots.path("out")), *keys)
    closed = f"window_end <= timestamp_millis({EPOCH_MS + 239_000 - 20_000})"
    want = rows_of(Z.sliding_zscores(lots.table(), spec, rule).filter(closed), *keys)
    assert got == want and len(want) > 10


def test_replayed_batch_changes_nothing(lots):
    lots.add(minute(0) + [("A", 300.0, 30.5)])
    jobs.drain(jobs.zscore_job(lots.stream(), lots.path("alerts"), lots.path("state")))
    before = rows_of(read_alerts(lots.spark, lots.path("alerts"), ZSCORE_ALERT))
    jobs.drain(jobs.zscore_job(lots.stream(), lots.path("alerts"), lots.path("state-2")))
    assert rows_of(read_alerts(lots.spark, lots.path("alerts"), ZSCORE_ALERT)) == before
    assert len(before) == 1


def test_streamed_dedup_keeps_one_of_many_copies(lots):
    for _ in range(2):
        lots.add([("A", 5.0, 1)] * 50 + [("A", 6.0, 1), ("B", 5.0, 1)])
    kept = dedup.first_in_stream(lots.stream(FeedRate(files_per_trigger=1)), "1 hour")
    jobs.drain(kept.writeStream.outputMode("append").format("parquet")
               .option("path", lots.path("out")).option("checkpointLocation", lots.path("state")))
    out = lots.spark.read.schema(kept.schema).parquet(lots.path("out"))
    assert rows_of(out, "symbol", "price") == [("A", 5.0), ("A", 6.0), ("B", 5.0)]


def test_relay_writes_complete_lots(lots):
    lots.add(minute(0))
    jobs.drain(sinks.stream_to_lines(lots.stream(), lots.path("relay"), lots.path("state")))
    back = feed.to_transactions(feed.readable(feed.read_lines(lots.spark, lots.path("relay"))))
    assert rows_of(back) == rows_of(lots.table())


def log_of(spark, rows, root, shards=2, **sizes):
    messages = spark.createDataFrame([(k, f"{k}{i}", i) for i, k in rows], "key string, value string, i long")
    message_log.append_messages(messages, root, shards, "i", **sizes)


def test_message_log_polls_within_its_limit_and_goes_on_after_a_restart(spark, tmp_path):
    root, out, state, kept = (str(tmp_path / n) for n in ("log", "out", "state", "kept"))
    session = stream_session(spark, 2)
    log_of(spark, [(i, "A" if i % 3 else "B") for i in range(300)], root, per_segment=70)
    table = message_log.read_log(spark, root)
    assert table.count() == 300
    for rows in table.groupBy("shard").agg(F.sort_array(F.collect_list(F.struct("sequence", "value")))).collect():
        numbers = [r.sequence for r in rows[1]]
        assert numbers == list(range(len(numbers)))                       # gapless, and a key in order:
        for key in "AB":
            mine = [int(r.value[1:]) for r in rows[1] if r.value.startswith(key)]
            assert mine == sorted(mine)

    def run():
        read = message_log.stream_log(session, root, kept, "TRIM_HORIZON", FeedRate(messages_per_shard=40))
        return jobs.catch_up(read.writeStream.format("parquet").option("path", out).option("checkpointLocation", state))

    first = run()
    sizes = [p["numInputRows"] for p in first.recentProgress if p["numInputRows"]]
    assert sum(sizes) == 300 and max(sizes) <= 80
    log_of(spark, [(i, "A") for i in range(300, 330)], root)
    run()
    assert rows_of(spark.read.parquet(out), "value") == sorted(
        (f"{'A' if i % 3 or i >= 300 else 'B'}{i}",) for i in range(330))


def test_message_log_catches_up_a_backlog_in_few_batches(spark, tmp_path):
    root, out, state, kept = (str(tmp_path / n) for n in ("log", "out", "state", "kept"))
    session = stream_session(spark, 2)
    log_of(spark, [(i, "A") for i in range(310)], root, per_segment=70)
    rate = FeedRate(messages_per_shard=10, polls_per_trigger=8)
    for more in ([], range(310, 325)):
        if more:
            log_of(spark, [(i, "A") for i in more], root)
        read = message_log.stream_log(session, root, kept, "TRIM_HORIZON", rate)
        run = jobs.catch_up(read.writeStream.format("parquet").option("path", out).option("checkpointLocation", state))
        sizes = [p["numInputRows"] for p in run.recentProgress if p["numInputRows"]]
        assert sizes == ([10, 5] if more else [10, 20, 40, 80, 80, 80])
    back = spark.read.schema(message_log.MESSAGE).parquet(out)
    assert sorted(map(tuple, back.select("sequence", "value").collect())) == [(i, f"A{i}") for i in range(325)]


def test_message_log_reads_any_range_of_a_long_segment(tmp_path):
    lines = [f"{i}-{'ü' * (i % 90)}" for i in range(30_000)]
    path = tmp_path / "shard=1" / f"{5:020d}-{30_005:020d}.jsonl"
    path.parent.mkdir()
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    for first, after in ((5, 30_005), (5, 6), (12_000, 12_500), (29_999, 30_005)):
        part = message_log.Range(1, str(path), 5, first, after)
        got = [r for b in message_log._messages(str(tmp_path), part) for r in b.to_pylist()]
        assert got == [{"shard": 1, "sequence": i, "value": lines[i - 5]} for i in range(first, after)]


def test_message_log_from_its_end_and_unknown_positions(spark, tmp_path):
    root, out, state, kept = (str(tmp_path / n) for n in ("log", "out", "state", "kept"))
    session = stream_session(spark, 2)
    log_of(spark, [(i, "A") for i in range(10)], root)
    for lot in (None, range(10, 15)):
        if lot:
            log_of(spark, [(i, "A") for i in lot], root)
        read = message_log.stream_log(session, root, kept)
        jobs.catch_up(read.writeStream.format("parquet").option("path", out).option("checkpointLocation", state))
    assert rows_of(spark.read.schema(message_log.MESSAGE).parquet(out), "value") == [(f"A{i}",) for i in range(10, 15)]
    assert message_log.read_log(spark, str(tmp_path / "none")).count() == 0
    with pytest.raises(Exception, match="startingPosition"):
        message_log.LogStream({"path": root, "startingposition": "MIDDLE"})


def test_trailing_stream_over_lots_equals_the_table(lots):
    rng = random.Random(5)
    rule = ZScoreRule(1.5, 5)
    rows = [("AB"[i % 2], rng.choice([10.0, 11.0, 30.0]), i * 7 + rng.random()) for i in range(300)]
    ids = "xxhash64(symbol, price, event_time) AS event_id"
    out, state = lots.path("out"), lots.path("state")
    for lot in (rows[:120], rows[120:150], rows[150:]):
        lots.add(lot)
        found = trailing_zscore_stream(lots.stream().selectExpr("*", ids), 300, "30 seconds", rule, blocks=5, salts=2)
        query = jobs.drain(found.writeStream.format("parquet").option("path", out).option("checkpointLocation", state))
    table = trailing_zscores(lots.table().selectExpr("*", ids), 300, rule, blocks=5)
    end = lots.table().agg(F.max("event_time")).first()[0]
    closed = table.filter(F.timestamp_seconds(F.floor(F.unix_seconds("event_time") / 60) * 60 + 60)
                          <= F.lit(end) - F.expr("INTERVAL 30 SECONDS"))
    def told(df):
        return rows_of(df.select("event_id", "count_trades", *[F.round(c, 6).alias(c) for c in ("mean_price", "z_score")]))
    got = told(lots.spark.read.schema(found.schema).parquet(out))
    assert got == told(closed) and len(got) > 10
    kept = [op["numRowsTotal"] for p in query.recentProgress for op in p["stateOperators"]]
    assert kept[-1] <= 2 * 2 * (5 + 3)               # symbols, salts, the blocks of a span and of the lateness


def test_late_trades_go_to_their_side_and_replays_change_nothing(lots):
    out, state = lots.path("routed"), lots.path("state")
    for lot in ([("A", 1.0, 100)], [("A", 2.0, 60), ("A", 3.0, 71), ("B", 4.0, 200)], [("B", 5.0, 169), ("B", 6.0, 170)]):
        lots.add(lot)
        jobs.drain(late.routing_job(lots.stream(), out, state, "30 seconds"))
    layout = lots.table()
    routed = late.read_routed(lots.spark, out, layout)
    assert rows_of(routed, "side", "price") == [
        ("kept", 1.0), ("kept", 3.0), ("kept", 4.0), ("kept", 6.0), ("late", 2.0), ("late", 5.0)]
    assert rows_of(routed.select(*layout.columns)) == rows_of(layout)
    mark = late._mark(lots.spark, f"{out}/marks", 1, "30 seconds")
    again = late.route(layout.filter("price in (2, 3, 4)"), mark)
    assert rows_of(again.filter("late"), "price") == [(2.0,)]
    assert rows_of(late.read_routed(lots.spark, out, layout, "late"), "price") == [(2.0,), (5.0,)]
    assert late.read_routed(lots.spark, lots.path("none"), layout).count() == 0
