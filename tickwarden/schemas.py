"""Column types of every table the library reads or writes."""

from pyspark.sql import types as T

# Field names of the wire message.
TRADE = T.StructType(
    [
        T.StructField("c", T.ArrayType(T.StringType(), True), True),
        T.StructField("p", T.DoubleType(), True),
        T.StructField("s", T.StringType(), True),
        T.StructField("t", T.LongType(), True),
        T.StructField("v", T.DoubleType(), True),
    ]
)
ENVELOPE = T.StructType(
    [
        T.StructField("data", T.ArrayType(TRADE, True), True),
        T.StructField("type", T.StringType(), True),
    ]
)
# Wire name -> table name.
TRADE_NAMES = {
    "c": "trade_conditions",
    "p": "price",
    "s": "symbol",
    "t": "trade_ts",
    "v": "volume",
}

TRADES = T.StructType(
    [
        T.StructField("trade_conditions", T.ArrayType(T.StringType(), True), True),
        T.StructField("price", T.DoubleType(), True),
        T.StructField("symbol", T.StringType(), True),
        T.StructField("trade_ts", T.TimestampType(), True),
        T.StructField("volume", T.DoubleType(), True),
        T.StructField("type", T.StringType(), True),
        T.StructField("uuid", T.StringType(), True),
        T.StructField("ingestion_ts", T.TimestampType(), True),
    ]
)
STOCKS = T.StructType(
    [
        T.StructField("uuid", T.StringType(), True),
        T.StructField("price", T.DoubleType(), True),
        T.StructField("symbol", T.StringType(), True),
        T.StructField("trade_ts", T.TimestampType(), True),
        T.StructField("ingestion_ts", T.TimestampType(), True),
        T.StructField("volume", T.DoubleType(), True),
        T.StructField("batch_size", T.LongType(), True),
    ]
)
PRICE_ANOMALIES = T.StructType([f for f in STOCKS.fields if f.name != "volume"])
VOLUME_ANOMALIES = T.StructType([f for f in STOCKS.fields if f.name != "price"])
TABLE_SCHEMAS = {
    "stocks": STOCKS, "price_anomalies": PRICE_ANOMALIES, "volume_anomalies": VOLUME_ANOMALIES,
}

# Recorded trades as text files hold them; times stay text until parsed leniently.
RECORDED_CSV = T.StructType(
    [
        T.StructField("symbol", T.StringType(), True),
        T.StructField("trade_ts", T.StringType(), True),
        T.StructField("price", T.DoubleType(), True),
        T.StructField("trade_conditions", T.StringType(), True),
        T.StructField("type", T.StringType(), True),
        T.StructField("volume", T.DoubleType(), True),
    ]
)
LABELLED_CSV = T.StructType(
    [
        *RECORDED_CSV.fields,
        T.StructField("price_anomaly", T.DoubleType(), True),
        T.StructField("volume_anomaly", T.DoubleType(), True),
    ]
)
DAILY_CSV = T.StructType(
    [
        T.StructField("Date", T.StringType(), True),
        T.StructField("Close/Last", T.DoubleType(), True),
        T.StructField("Open", T.DoubleType(), True),
        T.StructField("High", T.DoubleType(), True),
        T.StructField("Low", T.DoubleType(), True),
    ]
)
# Text form of times in exported files.
TIME_TEXT = "yyyy-MM-dd HH:mm:ss.SSSSSSZ"
