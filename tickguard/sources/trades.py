"""Trades from JSON-lines folders, feed envelopes and message streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickguard.functions.scalars import event_time, number, utf8_text
from tickguard.operators.attach import BROADCAST_BYTES, attach, written_bytes
from tickguard.params import FeedRate
from tickguard.schema import CORRUPT, ENVELOPE, RAW_TRADE, RAW_TRADE_LINE
from tickguard.session import settle

# The symbols the feed subscribes to, by sector.
WATCHED_SYMBOLS = {
    "crypto": ["BINANCE:BTCUSDT", "BINANCE:ETHUSDT", "BINANCE:SOLUSDT"],
    "technology": ["AAPL", "NVDA", "MSFT", "GOOGL", "AMZN"],
    "industry": ["PNR", "SMR", "TTWO"],
    "traditional": ["JPM", "XOM", "JNJ", "KO", "GM"],
    "holdings and fintech": ["BRK.B", "NU"],
    "real estate": ["LEN", "O"],
    "funds": ["VOO", "VWO"],
}


def watch_list(spark: SparkSession) -> DataFrame:
    rows = [(symbol, sector) for sector, listed in WATCHED_SYMBOLS.items() for symbol in listed]
    return spark.createDataFrame(rows, "symbol string, sector string")


def watched(trades: DataFrame, watch: DataFrame | list[str] | None = None, **sizes) -> DataFrame:
    """Only trades of watched symbols.

    A list becomes an IN predicate that reaches the scan. A table is settled and
    measured: a short one is broadcast, a long one goes through ``attach``, which
    splits busy symbols.
    """
    if watch is None:
        watch = [symbol for listed in WATCHED_SYMBOLS.values() for symbol in listed]
    if not isinstance(watch, DataFrame):
        return trades.filter(F.col("symbol").isin(list(watch)))
    listed = settle(watch.select("symbol").distinct(), "watch")
    if written_bytes(listed) <= sizes.get("broadcast_bytes", BROADCAST_BYTES):
        kept = trades.join(F.broadcast(listed), "symbol", "left_semi")
    else:
        seen = trades.groupBy("symbol").agg(F.count(F.lit(1)).alias("_seen"))
        kept = attach(trades, seen.join(listed, "symbol"), ["symbol"], "_seen", **sizes)
    return kept.select(*trades.columns)


def _line_options(reader):
    return (reader.schema(RAW_TRADE_LINE)
            .option("multiLine", "false")
            .option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return _line_options(spark.read).json(path)


def stream_lines(spark: SparkSession, path: str, rate: FeedRate = FeedRate()) -> DataFrame:
    """The folder as a stream, oldest files first, a bounded number per trigger."""
    return (_line_options(spark.readStream)
            .option("maxFilesPerTrigger", rate.files_per_trigger)
            .option("latestFirst", "false")
            .json(path))


def has_content(fields: list[str], corrupt: str = CORRUPT) -> Column:
    """True unless the line could not be read at all.

    A mistyped field nulls only itself, so such a line still counts; a line
    marked corrupt without any readable field is set aside. The fields are tested
    through one expression that the JSON scan cannot take over: it would judge a
    cut-off line by the fields before the cut.
    """
    any_field = F.coalesce(*[F.col(f).cast("string") for f in fields])
    return F.col(corrupt).isNull() | any_field.isNotNull()


def readable(lines: DataFrame) -> DataFrame:
    return lines.filter(has_content(RAW_TRADE.names)).drop(CORRUPT)


def quarantined(lines: DataFrame) -> DataFrame:
    return lines.filter(~has_content(RAW_TRADE.names)).select(CORRUPT)


def parse_lines(text: DataFrame, column: str = "value") -> DataFrame:
    """The same reading of JSON text that already sits in a column."""
    parsed = F.from_json(column, RAW_TRADE_LINE, {
        "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    return text.select(*[c for c in text.columns if c != column], once(parsed))


def once(parsed: Column) -> Column:
    """Fields of a parsed struct, through a generator so that no filter parses it again."""
    return F.inline(F.array(parsed))


def to_transactions(raw: DataFrame, *keep: str) -> DataFrame:
    """symbol, price, volume and event time of raw trades; a NaN price is missing."""
    return raw.select(
        *keep,
        F.col("s").alias("symbol"),
        number(F.col("p")).alias("price"),
        F.col("v").alias("volume"),
        event_time(F.col("t")).alias("event_time"))


def to_raw(trades: DataFrame, *keep: str) -> DataFrame:
    """The wire form of transactions."""
    return trades.select(
        *keep,
        F.col("symbol").alias("s"), F.col("price").alias("p"), F.col("volume").alias("v"),
        F.unix_millis("event_time").alias("t"), F.lit(None).cast("string").alias("c"))


def open_envelopes(messages: DataFrame, column: str = "value") -> DataFrame:
    """One raw trade per element of every trade envelope; other messages give none."""
    return (
        messages.select(once(F.from_json(column, ENVELOPE)))
        .filter(F.col("type") == "trade")
        .select(F.inline("data"))
    )


def first_messages(messages: DataFrame, order: list[str], n: int = 20) -> DataFrame:
    """The first ``n`` messages, a top-n that never sorts the rest."""
    return messages.orderBy(*order).limit(n)


def count_files(spark: SparkSession, path: str, pattern: str = "batch_*.json") -> DataFrame:
    """Number of raw files, empty ones included.

    A scan leaves empty files out, so the files are counted in the listing that
    Spark makes for any scan; no name leaves the JVM and no file is opened.
    """
    listed = (spark.read.format("binaryFile").option("pathGlobFilter", pattern)
              .option("recursiveFileLookup", "true").load(path))
    return spark.range(1).select(F.lit(len(listed._jdf.inputFiles())).cast("bigint").alias("files"))


# Start positions of the message stream and the connector's words for them.
START_POSITIONS = {"LATEST": "latest", "TRIM_HORIZON": "earliest"}


def message_options(
    servers: str, topic: str, start: str = "LATEST", rate: FeedRate = FeedRate(),
) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": START_POSITIONS[start],
        "maxOffsetsPerTrigger": str(rate.messages_per_trigger),
    }


def stream_messages(
    spark: SparkSession, servers: str, topic: str, start: str = "LATEST",
    rate: FeedRate = FeedRate(),
) -> DataFrame:
    """Message text from a keyed stream; needs Spark's Kafka package on the cluster."""
    reader = spark.readStream.format("kafka").options(**message_options(servers, topic, start, rate))
    return reader.load().select(utf8_text(F.col("value")).alias("value"))
