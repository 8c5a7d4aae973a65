"""Record layouts."""

from pyspark.sql import types as T

RAW_TRADE = T.StructType([
    T.StructField("s", T.StringType()),
    T.StructField("p", T.DoubleType()),
    T.StructField("v", T.DoubleType()),
    T.StructField("t", T.LongType()),
    T.StructField("c", T.StringType()),
])

CORRUPT = "_corrupt_record"
RAW_TRADE_LINE = T.StructType([*RAW_TRADE.fields, T.StructField(CORRUPT, T.StringType())])

ENVELOPE = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("data", T.ArrayType(RAW_TRADE)),
])

TRANSACTION = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("volume", T.DoubleType()),
    T.StructField("event_time", T.TimestampType()),
])

VOLATILITY_ALERT = T.StructType([
    T.StructField("window_start", T.TimestampType()),
    T.StructField("window_end", T.TimestampType()),
    T.StructField("symbol", T.StringType()),
    T.StructField("count_trades", T.LongType()),
    T.StructField("mean_price", T.DoubleType()),
    T.StructField("stddev_price", T.DoubleType()),
    T.StructField("volatility_ratio", T.DoubleType()),
])

ZSCORE_ALERT = T.StructType([
    T.StructField("event_time", T.TimestampType()),
    T.StructField("symbol", T.StringType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("volume", T.DoubleType()),
    T.StructField("mean_price", T.DoubleType()),
    T.StructField("stddev_price", T.DoubleType()),
    T.StructField("count_trades", T.LongType()),
    T.StructField("z_score", T.DoubleType()),
])
