"""Registered queries over the event table, each checked against SQL of its own.

The table is sparse (thousands of events over a month), so the queries use
six-hour windows that slide by an hour, and day-long batches.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickguard.functions.scalars import second_stamp
from tickguard.operators import alert_store, dedup, latest, quotes, sketches, volatility, zscore
from tickguard.operators.trailing import trailing_zscores
from tickguard.operators.windows import sliding_stats
from tickguard.params import FeedRate, VolatilityRule, WindowSpec, ZScoreRule
from tickguard.plans import reports
from tickguard.schema import VOLATILITY_ALERT, ZSCORE_ALERT
from tickguard.session import fresh_dir, settle, stream_session
from tickguard.sources import alerts as alert_files
from tickguard.sources import message_log
from tickguard.sources import trades as feed
from tickguard.sources.tables import EVENTS, events_as_trades, stream_events_as_trades
from tickguard.streaming import compaction, jobs, late, sinks
from tickguard.streaming.trailing import trailing_zscore_stream

SPEC = WindowSpec(length_s=6 * 3600, slide_s=3600, lateness_s=3600)
MONTH = WindowSpec(length_s=6 * 3600, slide_s=3600, lateness_s=60 * 86400)
RULE = VolatilityRule(threshold=1.0)
Z_RULE = ZScoreRule()
NOW = "2024-01-31 12:00:00"
SPLIT = "2024-01-16 00:00:00"
CHOSEN = ["click", "purchase", "view"]

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return shown(fn(spark, sf_dir))

    QUERIES[fn.__name__] = run
    return run


MEASURES = {"mean_price", "stddev_price", "volatility_ratio", "z_score", "max_abs_z", "low", "high",
            "bin_from", "bin_to", "q1", "median", "q3", "whisker_low", "whisker_high",
            "band_low", "band_high", "max_measure", "d", "dp"}


def tidy(col: Column) -> Column:
    """Six decimals. The offset moves exact decimal ties off the rounding edge."""
    return F.round(col + F.lit(1e-9), 6)


def shown(df: DataFrame) -> DataFrame:
    """Round computed doubles and give timestamps without a zone."""
    def one(name, kind):
        if name in MEASURES:
            return tidy(F.col(name)).alias(name)
        if kind in ("timestamp", "date"):
            return F.col(name).cast("timestamp_ntz").alias(name)
        return F.col(name)

    return df.select(*[one(name, kind) for name, kind in df.dtypes])


def day_of(time: str = "event_time") -> Column:
    return F.to_date(time)


def daily(trades: DataFrame) -> DataFrame:
    return trades.withColumn("day", day_of())


def scratch(spark: SparkSession, *names: str) -> list[str]:
    base = fresh_dir(spark, "run")
    return [f"{base}/{name}" for name in names]


# --- sources -----------------------------------------------------------------

@query
def trades_projection(spark, sf):
    raw = feed.to_raw(events_as_trades(spark, sf), "event_id")
    return reports.present_columns(
        feed.to_transactions(raw, "event_id"),
        ["event_id", "event_time", "symbol", "price", "volume", "not_there"])


@query
def envelope_flatten(spark, sf):
    # One envelope per ten consecutive event ids and kind: "error" events travel in
    # envelopes of another type, and each of those also comes once without data.
    trades = events_as_trades(spark, sf)
    kind = F.when(F.col("symbol") == "error", "error").otherwise("trade").alias("type")
    chunk = F.floor(F.col("event_id") / 10).alias("chunk")
    raw = F.struct(F.concat_ws("|", "s", F.col("event_id").cast("string")).alias("s"),
                   "p", "v", "t", "c")
    envelopes = (
        feed.to_raw(trades, "event_id", "symbol").groupBy(chunk, kind)
        .agg(F.collect_list(raw).alias("data"))
        .select(F.to_json(F.struct("type", "data")).alias("full"),
                F.when(F.col("type") == "error", F.to_json(F.struct("type"))).alias("bare"))
        .select(F.explode(F.array("full", "bare")).alias("value")))
    flat = feed.to_transactions(feed.open_envelopes(envelopes))
    parts = F.split("symbol", r"\|")
    return flat.select(parts[1].cast("long").alias("event_id"), parts[0].alias("symbol"),
                       "price", "volume", "event_time")


def _lines(spark, sf) -> DataFrame:
    """Events as text lines, some of them damaged in the ways a feed damages them."""
    trades = events_as_trades(spark, sf)
    line = F.to_json(F.struct(F.col("symbol").alias("s"), F.col("price").alias("p"),
                              F.col("volume").alias("v"), F.unix_millis("event_time").alias("t")))
    mistyped = F.to_json(F.struct(
        F.col("symbol").alias("s"), F.col("price").alias("p"), F.lit("many").alias("v"),
        F.unix_millis("event_time").alias("t")))
    k = F.col("volume")
    damaged = (
        F.when(k < 5, F.lit("connection reset"))
        .when(k < 10, F.lit("5"))
        .when(k < 15, F.substring(line, 1, 9))
        .when(k < 20, mistyped)
        .otherwise(line))
    return trades.select("event_id", damaged.alias("value"))


@query
def malformed_skip(spark, sf):
    lines = feed.parse_lines(_lines(spark, sf))
    return feed.to_transactions(feed.readable(lines), "event_id")


@query
def malformed_quarantine(spark, sf):
    lines = feed.quarantined(feed.parse_lines(_lines(spark, sf)))
    return lines.groupBy(F.length("_corrupt_record").cast("long").alias("line_length")).agg(
        F.count(F.lit(1)).alias("lines"))


@query
def watchlist_semi(spark, sf):
    trades = events_as_trades(spark, sf)
    busy = trades.groupBy("symbol").agg(F.max("price").alias("top")).filter("top > 300")
    return feed.watched(feed.watched(trades, CHOSEN), busy)


@query
def first_n(spark, sf):
    return feed.first_messages(events_as_trades(spark, sf), ["event_time", "event_id"])


@query
def quote_snapshot(spark, sf):
    return quotes.quote_snapshot(events_as_trades(spark, sf), tie=("event_id",))


@query
def json_roundtrip(spark, sf):
    (path,) = scratch(spark, "raw")
    sinks.write_lines(events_as_trades(spark, sf), path)
    return feed.to_transactions(feed.readable(feed.read_lines(spark, path)))


@query
def file_census(spark, sf):
    """Lots of raw files, one folder per day, with the trades in each and the files of all.

    A day without a readable line still shows; ``all_counted`` tells whether the
    census of names has as many files as the days together.
    """
    (path,) = scratch(spark, "raw")
    (feed.to_raw(events_as_trades(spark, sf), day_of().alias("lot"))
     .write.partitionBy("lot").json(path))
    lot = F.regexp_extract("path", r"lot=([0-9-]+)", 1).cast("date").alias("lot")
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.json")
             .option("recursiveFileLookup", "true").load(path)
             .select(lot).groupBy("lot").agg(F.count(F.lit(1)).alias("files")))
    lines = feed.readable(feed.read_lines(spark, path).drop("lot"))
    trades = feed.to_transactions(lines).groupBy(day_of().alias("lot")).agg(
        F.count(F.lit(1)).alias("trades"))
    census = feed.count_files(spark, path, "*.json").scalar()
    return (files.join(trades, "lot", "left")
            .select("lot", (F.col("files") > 0).alias("has_files"), F.coalesce("trades", F.lit(0)).alias("trades"),
                    (census == files.agg(F.sum("files")).scalar()).alias("all_counted")))


@query
def symbol_sequence(spark, sf):
    """Every trade with its number in its symbol's order of time."""
    return sinks.numbered(events_as_trades(spark, sf), "event_id").select("event_id", "symbol", "sequence")


@query
def keyed_layout(spark, sf):
    """The keyed messages as they lie: per symbol, how many carry an earlier time than one before them.

    Places come from the written layout: the file is the partition's number, and
    lines keep their order in it. Within a file a message is held against all
    before it, and the files of a symbol against each other by their extremes.
    """
    (path,) = scratch(spark, "layout")
    laid_out = sinks.in_symbol_order(events_as_trades(spark, sf), "event_id")
    (feed.parse_lines(sinks.keyed_messages(laid_out))
     .withColumns({"part": F.spark_partition_id(), "place": F.monotonically_increasing_id()})
     .write.parquet(path))
    sent = spark.read.parquet(path)
    before = Window.partitionBy("key", "part").orderBy("place").rowsBetween(
        Window.unboundedPreceding, -1)
    parts = (sent.withColumn("latest", F.max("t").over(before)).groupBy("key", "part").agg(
        F.count(F.lit(1)).alias("messages"), F.count_if(F.col("key") == F.col("s")).alias("own_key"),
        F.count_if(F.col("t") < F.col("latest")).alias("late"), F.min("t").alias("low"), F.max("t").alias("high")))
    earlier = Window.partitionBy("key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return (parts.withColumn("crossed", F.col("low") < F.max("high").over(earlier)).groupBy("key").agg(
        F.sum("messages").alias("messages"), F.sum("own_key").alias("own_key"),
        (F.sum("late") + F.count_if("crossed")).alias("out_of_order"),
        F.timestamp_millis(F.min("low")).alias("first_time"),
        F.timestamp_millis(F.max("high")).alias("last_time")))


# --- detectors ---------------------------------------------------------------

@query
def window_stats(spark, sf):
    return sliding_stats(events_as_trades(spark, sf), SPEC)


@query
def window_stats_by_user(spark, sf):
    """Many symbols: every user is one."""
    return sliding_stats(events_as_trades(spark, sf, "user_id"), SPEC)


@query
def volatility_sliding(spark, sf):
    return volatility.volatility_alerts(events_as_trades(spark, sf), SPEC, RULE)


def _revisions(spark, sf) -> DataFrame:
    stats = volatility.revised_stats(events_as_trades(spark, sf), SPEC, 2 * 3600)
    rated = volatility.over_threshold(volatility.rated_windows(stats, RULE), RULE)
    return rated.select("batch_id", *volatility.COLUMNS)


@query
def volatility_revisions(spark, sf):
    return _revisions(spark, sf)


@query
def volatility_batch_summary(spark, sf):
    rated = volatility.rated_windows(sliding_stats(events_as_trades(spark, sf), SPEC), RULE)
    return reports.volatility_summary(rated, RULE.threshold, day_of("window_start"))


def _z(spark, sf, *keep: str, batch: str | None = None) -> DataFrame:
    found = zscore.batch_zscores(daily(events_as_trades(spark, sf)), Z_RULE, batch)
    return found.select(*keep, *zscore.COLUMNS)


@query
def zscore_batch(spark, sf):
    return _z(spark, sf, "event_id")


@query
def zscore_bucketed(spark, sf):
    return _z(spark, sf, "event_id", "day", batch="day")


@query
def zscore_batch_summary(spark, sf):
    scored = zscore.score_batch(daily(events_as_trades(spark, sf)), Z_RULE, "day")
    return reports.zscore_summary(scored, Z_RULE.threshold, F.col("day"))


def _sliding_z(spark, sf) -> DataFrame:
    return zscore.sliding_zscores(events_as_trades(spark, sf), SPEC, Z_RULE).select(
        "event_id", "event_time", "symbol", "price", "volume", "window_start", "window_end",
        "mean_price", "stddev_price", "count_trades", "z_score")


@query
def zscore_sliding(spark, sf):
    return _sliding_z(spark, sf)


@query
def zscore_trailing(spark, sf):
    return trailing_zscores(events_as_trades(spark, sf), SPEC.length_s, Z_RULE).select(
        "event_id", *zscore.COLUMNS)


# --- alert reports -----------------------------------------------------------

@query
def alerts_union(spark, sf):
    return alert_files.union_alerts({
        "volatility": volatility.volatility_alerts(events_as_trades(spark, sf), SPEC, RULE),
        "zscore": _z(spark, sf, batch="day"),
    }).select("family", *volatility.COLUMNS, "event_time", "price", "volume", "z_score")


def _flat_files(df: DataFrame, folder: str, stem: str) -> None:
    """CSV files of the flat layout, as a recorder of single batches leaves them: one a task."""
    spark = df.sparkSession
    (made,) = scratch(spark, "flat")
    df.write.option("header", "true").option("timestampFormat", sinks.STAMP).csv(made)
    hadoop = spark._jvm.org.apache.hadoop.fs
    files = hadoop.Path(made).getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(hadoop.Path(folder))
    for k, part in enumerate(files.globStatus(hadoop.Path(f"{made}/part-*.csv"))):
        files.rename(part.getPath(), hadoop.Path(f"{folder}/{stem}_{k}.csv"))


@query
def alert_files_flat(spark, sf):
    """Both families as flat files with reversed and with missing columns, and every row back."""
    (folder,) = scratch(spark, "flat_alerts")
    volatile = volatility.volatility_alerts(events_as_trades(spark, sf), SPEC, RULE)
    scored = _z(spark, sf, batch="day")
    chosen = F.col("symbol").isin(CHOSEN)
    _flat_files(volatile.filter(chosen), folder, "alerts_batch_1_a")
    _flat_files(volatile.filter(~chosen).drop("count_trades"), folder, "alerts_batch_2_b")
    _flat_files(scored.filter(chosen), folder, "zscore_alerts_batch_3_a")
    _flat_files(scored.filter(~chosen).select(*reversed(scored.columns)), folder, "zscore_alerts_batch_4_b")
    return alert_files.union_alerts({
        family: alert_files.read_flat_alerts(spark, folder, family) for family in alert_files.FAMILIES
    }).select("family", "batch_id", *volatility.COLUMNS, "event_time", "price", "volume", "z_score")


@query
def alert_dedup_volatility(spark, sf):
    return dedup.first_volatility_alerts(_revisions(spark, sf), digits=6)


@query
def alert_dedup_zscore(spark, sf):
    return dedup.first_zscore_alerts(_sliding_z(spark, sf).drop("event_id"))


@query
def alert_latest_revision(spark, sf):
    return dedup.latest_revision(_revisions(spark, sf))


@query
def alert_kpis(spark, sf):
    return reports.zscore_kpis(_z(spark, sf, batch="day"))


@query
def alert_bounds(spark, sf):
    return alert_files.union_alerts({
        "volatility": reports.bounds(_revisions(spark, sf), reports.RATIO),
        "zscore": reports.bounds(_z(spark, sf, batch="day"), reports.Z_SIZE)})


@query
def alert_symbols(spark, sf):
    return reports.symbols(_z(spark, sf, batch="day"))


@query
def alert_filter(spark, sf):
    picked = reports.filtered(_z(spark, sf, batch="day"), reports.Z_SIZE, CHOSEN, 3.2, 4.5)
    return reports.present_columns(reports.newest_first(picked, "event_time", "symbol", "price"))


@query
def alert_filter_volatility(spark, sf):
    alerts = volatility.volatility_alerts(events_as_trades(spark, sf), SPEC, RULE)
    picked = reports.filtered(alerts, reports.RATIO, CHOSEN, 1.05, 1.4)
    return reports.newest_first(picked, "window_start", "symbol")


@query
def alert_shown_of_total(spark, sf):
    return reports.shown_of_total(_z(spark, sf, batch="day"), reports.Z_SIZE, CHOSEN, 3.2, 4.5)


@query
def alert_count_by_symbol(spark, sf):
    return reports.count_by_symbol(_z(spark, sf, batch="day"))


@query
def alert_box_stats(spark, sf):
    return reports.box_statistics(settle(
        volatility.volatility_alerts(events_as_trades(spark, sf), SPEC, RULE)))


@query
def price_box_stats(spark, sf):
    """Box statistics over every trade price, by symbol."""
    return reports.box_statistics(events_as_trades(spark, sf), "price")


#: Ranges of days that the sketch store is asked for.
RANGES = [("2024-01-01", "2024-01-31"), ("2024-01-05", "2024-01-05"), ("2024-01-10", "2024-01-19")]


def _sketch_store(spark, sf, symbol: str = "event_type", distinct: str | None = None) -> DataFrame:
    """The store after three batches, each of every third trade."""
    (root,) = scratch(spark, "sketches")
    trades = events_as_trades(spark, sf, symbol)
    for lot in range(3):
        sketches.add_batch(trades.filter(F.col("event_id") % 3 == lot), root, lot, distinct)
    return sketches.read_store(spark, root)


@query
def price_sketch_ranges(spark, sf):
    """Quartiles of ranges of days from stored sketches, each held against its exact rank.

    Estimates depend on the sketch, so the rows tell whether each lies within the stated error:
    the share of trades below it is not above the wanted one by more, nor the share up to it below.
    """
    store = _sketch_store(spark, sf)
    trades = events_as_trades(spark, sf).withColumn("day", day_of())
    made = []
    for first, last in RANGES:
        box = sketches.box(sketches.between(store, first, last), "symbol")
        seen = sketches.between(trades, first, last).join(F.broadcast(box.select("symbol", "q1", "median", "q3")), "symbol")

        def near(name, share):
            below, upto = (F.count_if(F.col("price") < F.col(name)), F.count_if(F.col("price") <= F.col(name)))
            wanted = F.lit(share) * F.count(F.lit(1))
            slack = F.lit(sketches.RANK_ERROR) * F.count(F.lit(1)) + 1
            return ((below <= wanted + slack) & (upto >= wanted - slack)).alias(f"{name}_near")

        ranks = seen.groupBy("symbol").agg(near("q1", 0.25), near("median", 0.5), near("q3", 0.75))
        made.append(box.join(ranks, "symbol").select(
            F.lit(first).alias("first"), F.lit(last).alias("last"), "symbol", "n", "low", "high",
            "q1_near", "median_near", "q3_near"))
    return made[0].unionByName(made[1]).unionByName(made[2])


@query
def sketch_distinct_users(spark, sf):
    """Distinct users of each kind of event and in all, from sketches merged over batches and days."""
    (root,) = scratch(spark, "sketches")
    users = spark.read.schema(EVENTS).parquet(f"{sf}/events.parquet").select(
        "event_id", F.col("event_type").alias("symbol"), F.col("value").alias("price"),
        F.col("ts").cast("timestamp").alias("event_time"), F.col("user_id").alias("user"))
    for lot in range(3):
        sketches.add_batch(users.filter(F.col("event_id") % 3 == lot), root, lot, "user")
    told = sketches.distinct_count(sketches.read_store(spark, root), "symbol")
    exact = users.groupBy("symbol").agg(F.count_distinct("user").alias("users"))
    off = F.abs(F.col("distinct") - F.col("users")) / F.col("users")
    return told.join(exact, "symbol").select("symbol", "users", (off <= sketches.DISTINCT_ERROR).alias("near"))


@query
def alert_latest_maintained(spark, sf):
    """Revisions merged batch by batch, ten days of windows a batch and then all again, into the kept table."""
    (root,) = scratch(spark, "latest")
    revisions = settle(_revisions(spark, sf), "revisions")
    for lot in (F.dayofmonth("window_start") < 11, F.col("batch_id") % 2 == 0, F.col("batch_id") % 2 == 1):
        latest.merge_batch(revisions.filter(lot), root)
    layout = ", ".join(f"`{n}` {k}" for n, k in revisions.dtypes)
    return latest.read_latest(spark, root, layout).drop("day")


@query
def alert_store_range(spark, sf):
    """Two batches into the clustered store, one of them twice; a range of size, symbols and days back."""
    (store,) = scratch(spark, "store")
    alerts = settle(_z(spark, sf, batch="day"))
    early = F.col("event_time") < F.lit(SPLIT).cast("timestamp")
    for batch, part in ((0, early), (1, ~early), (0, early)):
        alert_store.write_batch(alerts.filter(part), store, batch, "event_time", reports.Z_SIZE)
    kept = alert_store.read_range(spark, store, ZSCORE_ALERT, "event_time", CHOSEN, 3.2, 4.5,
                                  since="2024-01-05 06:00:00", until="2024-01-25 18:00:00")
    return kept.select("batch_id", *zscore.COLUMNS)


@query
def alert_histogram(spark, sf):
    return reports.histogram(settle(_z(spark, sf, batch="day")))


@query
def alert_band(spark, sf):
    band = reports.sigma_band(_z(spark, sf, "event_id", batch="day"))
    return reports.oldest_first(band, "event_time", "event_id", per_symbol=True)


@query
def alert_freshness(spark, sf):
    alerts = volatility.volatility_alerts(events_as_trades(spark, sf), SPEC, RULE)
    return reports.volatility_kpis(alerts, F.lit(NOW).cast("timestamp"))


@query
def csv_export_roundtrip(spark, sf):
    """Filtered alerts to a time-stamped CSV folder and back, typed by the schema."""
    (path,) = scratch(spark, "export")
    picked = reports.filtered(_z(spark, sf, batch="day"), reports.Z_SIZE, CHOSEN, 3.0)
    stamp = spark.range(1).select(second_stamp(F.lit(NOW).cast("timestamp"))).first()[0]
    where = sinks.export_csv(picked, path, stamp)
    back = (spark.read.schema(ZSCORE_ALERT).option("header", "true")
            .option("enforceSchema", "false").csv(where))
    return back.withColumn("stamp", F.lit(stamp))


# --- streams -----------------------------------------------------------------

def _raw_stream(spark, path, files: int = 1000) -> DataFrame:
    lines = feed.stream_lines(spark, path, FeedRate(files_per_trigger=files))
    return feed.to_transactions(feed.readable(lines))


@query
def stream_volatility_update(spark, sf):
    """JSON lines through the update-mode detector, in three batches that revise the same windows.

    Every third trade goes to the same lot, and each lot is a run of its own on one
    checkpoint: nearly every window is emitted three times. Returned is the latest alert of
    each window, and how often the window alerted.
    """
    raw, out, state = scratch(spark, "raw", "alerts", "state")
    trades = events_as_trades(spark, sf)
    stream = stream_session(spark)
    stream.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")   # a lot is a batch
    for lot in range(3):
        sinks.write_lines(trades.filter(F.col("event_id") % 3 == lot), raw)
        jobs.drain(jobs.volatility_job(_raw_stream(stream, raw, 1_000_000), out, state, MONTH, RULE))
    alerts = alert_files.read_alerts(spark, out, VOLATILITY_ALERT)
    often = alerts.groupBy(*dedup.WINDOW_KEY).agg(F.count(F.lit(1)).alias("emitted"))
    return (dedup.latest_revision(alerts).join(often, dedup.WINDOW_KEY)
            .select("batch_id", *volatility.COLUMNS, "emitted"))


@query
def stream_zscore_foreachbatch(spark, sf):
    out, state = scratch(spark, "alerts", "state")
    trades = stream_events_as_trades(stream_session(spark), sf).drop("event_id")
    jobs.drain(jobs.zscore_job(trades, out, state, Z_RULE))
    return alert_files.read_alerts(spark, out, ZSCORE_ALERT).select("batch_id", *zscore.COLUMNS)


@query
def stream_zscore_sliding(spark, sf):
    out, state = scratch(spark, "alerts", "state")
    trades = stream_events_as_trades(stream_session(spark), sf)
    found = jobs.sliding_zscore_stream(trades, SPEC, Z_RULE, keep=("event_id",))
    jobs.drain(found.writeStream.outputMode("append").format("parquet")
               .option("path", out).option("checkpointLocation", state))
    return spark.read.schema(found.schema).parquet(out)


@query
def stream_late_drop(spark, sf):
    """Error trades arrive after all others: only windows still open take them in."""
    raw, out, state = scratch(spark, "raw", "stats", "state")
    trades = events_as_trades(spark, sf)
    stream = stream_session(spark)

    def save(stats, batch_id):
        (stats.withColumn("batch_id", F.lit(batch_id).cast("long")).write.mode("overwrite")
         .parquet(f"{out}/batch_id={batch_id}"))

    for lot in (F.col("symbol") != "error", F.col("symbol") == "error"):
        sinks.write_lines(trades.filter(lot), raw)
        stats = jobs.window_stats_stream(_raw_stream(stream, raw), SPEC)
        jobs.drain(stats.writeStream.outputMode("update").foreachBatch(save)
                   .option("checkpointLocation", state))
    revisions = spark.read.parquet(f"{out}/*")
    return dedup.latest_revision(revisions).select(
        "window_start", "window_end", "symbol", "count_trades", "mean_price", "stddev_price")


@query
def stream_restart_idempotent(spark, sf):
    """Two lots, two runs on one checkpoint, then the last batch replayed, and the first to nothing."""
    raw, out, state = scratch(spark, "raw", "alerts", "state")
    trades = events_as_trades(spark, sf)
    stream = stream_session(spark)
    cut = F.lit(SPLIT).cast("timestamp")
    for lot in (F.col("event_time") < cut, F.col("event_time") >= cut):
        sinks.write_lines(trades.filter(lot), raw)
        jobs.drain(jobs.zscore_job(_raw_stream(stream, raw), out, state, Z_RULE))
    millis = trades.filter(F.col("event_time") >= cut).withColumn(
        "event_time", F.date_trunc("millisecond", "event_time"))
    replay = zscore.batch_zscores(millis, Z_RULE).select(*zscore.COLUMNS)
    sinks.write_alerts(replay, out, 1)
    sinks.write_alerts(replay.limit(0), out, 0)
    return alert_files.read_alerts(spark, out, ZSCORE_ALERT).select("batch_id", *zscore.COLUMNS)


@query
def stream_zscore_trailing(spark, sf):
    """The trailing detector on a stream: the trades of closed blocks, each against its own range."""
    out, state = scratch(spark, "alerts", "state")
    trades = stream_events_as_trades(stream_session(spark), sf)
    found = trailing_zscore_stream(trades, 6 * 3600, "1 hour", Z_RULE, salts=2)
    jobs.drain(found.writeStream.outputMode("append").format("parquet")
               .option("path", out).option("checkpointLocation", state))
    return spark.read.schema(found.schema).parquet(out).select("event_id", *zscore.COLUMNS)


@query
def stream_late_routed(spark, sf):
    """Error trades arrive after all others: those behind the watermark go to the late side."""
    raw, out, state = scratch(spark, "raw", "routed", "state")
    trades = events_as_trades(spark, sf).drop("event_id")
    stream = stream_session(spark)
    for lot in (F.col("symbol") != "error", F.col("symbol") == "error"):
        sinks.write_lines(trades.filter(lot), raw)
        jobs.drain(late.routing_job(_raw_stream(stream, raw), out, state, "1 hour"))
    return late.read_routed(spark, out, trades)


@query
def message_log_replay(spark, sf):
    """A keyed log read from both start positions, in polls, with a restart in the middle.

    The first half is logged, then both streams begin; the second half is logged
    between their first run and their second one on the same checkpoints. The
    backlog is read in batches of one poll, then two, four and so on.
    """
    (log,) = scratch(spark, "log")
    trades = events_as_trades(spark, sf)
    stream = stream_session(spark)
    cut = F.lit(SPLIT).cast("timestamp")
    rate = FeedRate(messages_per_shard=2500, polls_per_trigger=64)
    places = {start: scratch(spark, "out", "state", "positions") for start in feed.START_POSITIONS}
    for lot in (F.col("event_time") < cut, F.col("event_time") >= cut):
        messages = sinks.keyed_messages(trades.filter(lot), "event_time", "event_id")
        message_log.append_messages(messages, log, 8, "event_time", "event_id")
        for start, (out, state, positions) in places.items():
            read = message_log.stream_log(stream, log, positions, start, rate)
            jobs.catch_up(read.writeStream.format("parquet").option("path", out)
                          .option("checkpointLocation", state))
    first, second = (spark.read.schema(message_log.MESSAGE).parquet(out).select(F.lit(start).alias("start"), "value")
                     for start, (out, _, _) in places.items())
    lines = feed.readable(feed.parse_lines(first.unionByName(second)))
    return feed.to_transactions(lines, "start")


@query
def stream_json_lots(spark, sf):
    """The relay: a stream of trades into JSON-lines files, read back as a table."""
    raw, state = scratch(spark, "raw", "state")
    trades = stream_events_as_trades(stream_session(spark), sf)
    jobs.drain(sinks.stream_to_lines(trades, raw, state))
    return feed.to_transactions(feed.readable(feed.read_lines(spark, raw)))


@query
def lots_compacted(spark, sf):
    """The relay's lots, compacted after each half of the trades; the second time with the merged files of the first."""
    raw, store = scratch(spark, "raw", "store")
    trades = events_as_trades(spark, sf)
    for half in range(2):
        sinks.write_lines(trades.filter(F.col("event_id") % 2 == half).repartition(12), raw)
        compaction.compact(spark, raw, store)
    return feed.to_transactions(feed.readable(compaction.read_lots(spark, raw, store)))


@query
def stream_dedup_zscore(spark, sf):
    """Alerts of several windows, streamed, keep one row per trade."""
    out, state, found = scratch(spark, "kept", "state", "found")
    stream = stream_session(spark)
    alerts = _sliding_z(spark, sf)
    alerts.write.parquet(found)
    kept = dedup.first_in_stream(
        stream.readStream.schema(alerts.schema).parquet(found), "60 days")
    jobs.drain(kept.writeStream.outputMode("append").format("parquet")
               .option("path", out).option("checkpointLocation", state))
    return spark.read.schema(alerts.schema).parquet(out).select(
        "event_time", "symbol", "price", "volume")
