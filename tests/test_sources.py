"""Feeds: lines, envelopes, watch list, census, message stream options."""

import json

import pytest
from pyspark.sql import functions as F

from tickguard.functions.scalars import utf8_text
from tickguard.operators.quotes import quote_snapshot
from tickguard.params import FeedRate, WindowSpec
from tickguard.sources import trades as feed
from tickguard.streaming import sinks
from support import at, rows_of

LINES = [
    '{"s":"A","p":1.5,"v":2,"t":1704067200123,"c":["1"],"extra":1}',
    "connection reset",
    "5",
    '{"s":"B","p":"cheap","v":1,"t":1704067200000}',
    '{"s":"C","p":NaN,"v":1,"t":1704067200000}',
    '{"s":"D","p":1',
    '{"s":"E","p":2.5,"v":1,"t":null}',
    "{}",
]


def test_damaged_lines_are_set_aside(spark, tmp_path):
    (tmp_path / "batch_1.json").write_text("\n".join(LINES) + "\n")
    lines = feed.read_lines(spark, str(tmp_path))
    good = feed.to_transactions(feed.readable(lines))
    assert rows_of(good, "symbol", "price") == [
        ("A", 1.5), ("B", None), ("C", None), ("E", 2.5), (None, None)]
    assert rows_of(feed.quarantined(lines)) == [("5",), ("connection reset",), ('{"s":"D","p":1',)]
    first = good.filter("symbol = 'A'").first()
    assert first.event_time.microsecond == 123000
    text = spark.createDataFrame([(x,) for x in LINES], "value string")
    assert rows_of(feed.to_transactions(feed.readable(feed.parse_lines(text)))) == rows_of(good)


def test_envelopes(spark):
    trade = {"s": "A", "p": 1.0, "v": 2.0, "t": 1, "c": None}
    messages = [
        json.dumps({"type": "trade", "data": [trade, {**trade, "s": "B"}]}),
        json.dumps({"type": "trade"}), json.dumps({"type": "trade", "data": []}),
        json.dumps({"type": "ping"}), json.dumps({"type": "error", "data": [trade]}), "not json"]
    df = spark.createDataFrame([(m,) for m in messages], "value string")
    assert rows_of(feed.open_envelopes(df), "s") == [("A",), ("B",)]


def test_payload_bytes(spark):
    df = spark.createDataFrame([(bytearray("précio".encode()),)], "value binary")
    assert df.select(utf8_text(F.col("value"))).first()[0] == "précio"


def test_watch_list(spark, trades):
    assert feed.watch_list(spark).count() == 22
    df = trades([("AAPL", 1, 1), ("TSLA", 1, 1), (None, 1, 1)])
    assert rows_of(feed.watched(df), "symbol") == [("AAPL",)]


def test_file_census(spark, tmp_path):
    for name in ("batch_1.json", "batch_2.json", "other.json"):
        (tmp_path / name).write_text("")
    assert feed.count_files(spark, str(tmp_path)).first().files == 2


def test_message_options():
    options = feed.message_options("host:9092", "trades", "TRIM_HORIZON", FeedRate(messages_per_trigger=100))
    assert options == {
        "kafka.bootstrap.servers": "host:9092", "subscribe": "trades",
        "startingOffsets": "earliest", "maxOffsetsPerTrigger": "100"}
    assert feed.message_options("h", "t")["startingOffsets"] == "latest"
    with pytest.raises(KeyError):
        feed.message_options("h", "t", "MIDDLE")


def test_keyed_messages_round_trip(trades):
    df = trades([("A", 1.25, 1), ("B", 2.5, 2.345)])
    sent = sinks.keyed_messages(df)
    assert rows_of(sent, "key") == [("A",), ("B",)]
    back = feed.to_transactions(feed.parse_lines(sent.drop("key")))
    assert rows_of(back) == rows_of(df)


def test_first_messages_is_a_top_n(trades):
    df = trades([("A", i, 100 - i) for i in range(50)])
    first = feed.first_messages(df, ["event_time"], 20)
    assert first.count() == 20
    assert "TakeOrderedAndProject" in first._jdf.queryExecution().executedPlan().toString()


def test_quotes(trades):
    day = 86400
    df = trades([("A", 10, 1), ("A", 12, 2), ("A", 9, 3), ("A", 18, day + 5), ("A", None, day + 6),
                 ("A", 0, 2 * day), ("A", 5, 3 * day)])
    got = [tuple(r)[2:] for r in quote_snapshot(df).orderBy("day").collect()]
    assert got == [
        (9.0, None, 10.0, 12.0, 9.0, None, None), (18.0, 9.0, 18.0, 18.0, 18.0, 9.0, 100.0),
        (0.0, 18.0, 0.0, 0.0, 0.0, -18.0, -100.0), (5.0, 0.0, 5.0, 5.0, 5.0, 5.0, None)]


def test_window_spec_rejects_gaps():
    with pytest.raises(ValueError):
        WindowSpec(length_s=10, slide_s=20)
    assert at(0).tzinfo is not None
