"""The detectors as streaming queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery, StreamingQueryListener

from tickguard.functions.scalars import number
from tickguard.operators import volatility as V
from tickguard.operators import zscore as Z
from tickguard.operators.windows import direct_sliding_stats, windowed_stats
from tickguard.params import MICROS, FeedRate, VolatilityRule, WindowSpec, ZScoreRule
from tickguard.session import settled_for_now
from tickguard.streaming.sinks import observed, write_alerts, write_summary


def window_stats_stream(trades: DataFrame, spec: WindowSpec = WindowSpec()) -> DataFrame:
    """Sliding statistics kept in state until the watermark passes the window."""
    return direct_sliding_stats(trades.withWatermark("event_time", spec.lateness), spec)


def volatility_job(
    trades: DataFrame, alerts: str, checkpoint: str, spec: WindowSpec = WindowSpec(),
    rule: VolatilityRule = VolatilityRule(), summaries: str | None = None,
    rate: FeedRate = FeedRate(),
) -> DataStreamWriter:
    """Update mode: every batch alerts on the windows it changed. The trigger is the feed's."""

    def on_batch(stats: DataFrame, batch_id: int) -> None:
        rated, seen = observed(V.rated_windows(stats, rule), V.COLUMNS[-1], rule.threshold)
        write_alerts(V.over_threshold(rated, rule).select(*V.COLUMNS), alerts, batch_id)
        if summaries:
            write_summary(seen.get, summaries, batch_id, stats.sparkSession)

    return (window_stats_stream(trades, spec).writeStream.outputMode("update")
            .foreachBatch(on_batch).option("checkpointLocation", checkpoint).trigger(**rate.trigger))


def zscore_job(
    trades: DataFrame, alerts: str, checkpoint: str,
    rule: ZScoreRule = ZScoreRule(), summaries: str | None = None, rate: FeedRate = FeedRate(),
) -> DataStreamWriter:
    """Each micro-batch's trades against that batch's statistics; late trades count too."""

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        # Statistics and trades each read the batch from its source: a batch may be
        # a long backlog, which is not worth a second copy.
        with settled_for_now(batch.sparkSession):
            scored, seen = observed(Z.score_batch(batch, rule), "abs(z_score)", rule.threshold)
            write_alerts(Z.outliers(scored, rule).select(*Z.COLUMNS), alerts, batch_id)
        if summaries:
            write_summary(seen.get, summaries, batch_id, batch.sparkSession)

    return (trades.writeStream.outputMode("append").foreachBatch(on_batch)
            .option("checkpointLocation", checkpoint).trigger(**rate.trigger))


def sliding_zscore_stream(
    trades: DataFrame, spec: WindowSpec = WindowSpec(), rule: ZScoreRule = ZScoreRule(),
    salts: int = 8, keep: tuple[str, ...] = (),
) -> DataFrame:
    """Trades joined to the statistics of their closed sliding windows, as a stream.

    Append mode: a window's alerts appear once, when the watermark closes it. A
    trade waits in state once, under the last window that holds it; the row of a
    closed window is repeated for each slide it covers, which is how it meets the
    trades of all of them. Trades are also dealt over ``salts``, so the state of
    one busy symbol is shared by several tasks.
    """
    if spec.panes is None:
        raise ValueError("the window must be a whole number of slides")
    timed = trades.withWatermark("event_time", spec.lateness)
    at = F.unix_micros("event_time")
    facts = timed.select(
        F.window("event_time", spec.length, spec.slide).alias("window"),
        "symbol", number(F.col("price")).alias("price"), "volume", at.alias("at"), *keep,
        F.floor(F.rand(0) * salts).cast("int").alias("salt"),
    ).filter(F.unix_micros("window.start") + spec.slide_s * MICROS > F.col("at"))

    def later(moment, slides):
        return F.timestamp_micros(
            F.unix_micros(moment) + slides * F.lit(spec.slide_s * MICROS).cast("long"))

    ahead = F.explode(F.sequence(F.lit(0), F.lit(spec.panes - 1))).alias("ahead")
    salt = F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt")
    stats = (
        Z.usable(windowed_stats(timed, spec), rule)
        .withColumnRenamed("window", "closed")
        .select("*", ahead).select("*", salt)
        .withColumn("window", F.struct(later("closed.start", F.col("ahead")).alias("start"),
                                       later("closed.end", F.col("ahead")).alias("end"))))
    joined = facts.join(stats, ["window", "symbol", "salt"])
    return Z.outliers(Z.scored(joined), rule).select(
        *keep, F.timestamp_micros("at").alias("event_time"), "symbol", "price", "volume",
        F.col("closed.start").alias("window_start"), F.col("closed.end").alias("window_end"),
        "mean_price", "stddev_price", "count_trades", "z_score")


def drain(writer: DataStreamWriter) -> StreamingQuery:
    """Run over everything available now, then stop."""
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def catch_up(writer: DataStreamWriter) -> StreamingQuery:
    """Run in polls until a poll finds nothing new, then stop.

    For sources that hand out a limited range a poll, which a run over everything
    available would take as all there is.
    """
    query = writer.trigger(processingTime="0 seconds").start()
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return query


class RunTotals(StreamingQueryListener):
    """Batches, input rows and late rows of every query, for as long as the application lives.

    A query's own ``recentProgress`` forgets all but its last hundred batches. Register
    with ``spark.streams.addListener``. One entry a query is kept, whatever it runs.
    """

    def __init__(self):
        self.totals: dict[str, dict[str, int]] = {}

    def onQueryStarted(self, event) -> None:
        self.totals.setdefault(str(event.id), {"batches": 0, "input_rows": 0, "late_rows": 0})

    def onQueryProgress(self, event) -> None:
        p = event.progress
        total = self.totals.setdefault(str(p.id), {"batches": 0, "input_rows": 0, "late_rows": 0})
        total["batches"] += 1
        total["input_rows"] += p.numInputRows
        total["late_rows"] += sum(op.numRowsDroppedByWatermark for op in p.stateOperators)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def of(self, query: StreamingQuery) -> dict[str, int]:
        return self.totals.get(str(query.id), {"batches": 0, "input_rows": 0, "late_rows": 0})


def progress(query: StreamingQuery) -> dict[str, int]:
    """Input rows, and rows that came too late, over the query's recent batches only."""
    recent = query.recentProgress
    return {
        "batches": len(recent),
        "input_rows": sum(p["numInputRows"] for p in recent),
        "late_rows": sum(op["numRowsDroppedByWatermark"]
                         for p in recent for op in p["stateOperators"]),
    }
