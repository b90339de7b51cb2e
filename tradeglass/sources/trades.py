"""Trade events: JSON text to typed trades."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from tradeglass.functions.dates import stored_second
from tradeglass.functions.text import is_empty, market_base, market_quote
from tradeglass.schemas import PRICE, TRADE_EVENT


def read_events(spark: SparkSession, path: str) -> DataFrame:
    """Landed events, one JSON text per line, as column ``value``."""
    return spark.read.text(path)


def stream_events(spark: SparkSession, path: str, *, files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.format("text")
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def stream_topic(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """The same events from a topic (needs the Kafka connector on the cluster)."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
    return reader.option("subscribe", topic).load().select(F.col("value").cast("string").alias("value"))


def decode_events(events: DataFrame, column: str = "value") -> DataFrame:
    """Parse each text into the event columns; ``usable`` tells whether it is a trade.

    The parsed struct is expanded by a generator, so each text is parsed once: filters on the result
    are not pushed into the parser.
    """
    parsed = events.select(column, F.inline(F.array(F.from_json(F.col(column), TRADE_EVENT))))
    parsed = parsed.withColumns({name: F.col(name).try_cast("bigint") for name in ("t", "stid")})
    required = [F.col("stid"), F.col("t"), F.col("p").try_cast(PRICE), F.col("q").try_cast(PRICE)]
    complete = reduce(lambda a, b: a & b, [part.isNotNull() for part in required])
    return parsed.withColumn("usable", complete & ~is_empty(F.col("m")))


def trades_from(decoded: DataFrame) -> DataFrame:
    """Typed trades of the usable events; ``volume`` (USD) is set later by pricing."""
    market = F.col("m")
    return decoded.filter("usable").select(
        F.col("stid").alias("trade_id"),
        market.alias("market"),
        market_base(market).alias("base_asset_id"),
        market_quote(market).alias("quote_asset_id"),
        F.col("p").cast(PRICE).alias("price"),
        F.col("q").cast(PRICE).alias("quantity"),
        F.col("vq").try_cast(PRICE).alias("volume_quote"),
        stored_second(F.col("t")).alias("timestamp"),
        *("m_id", "t_id", "m_cid", "t_cid", "m_side", "t_side"),
        F.col("trade_id").alias("trade_oid"),
    )


def rejected_events(decoded: DataFrame, column: str = "value") -> DataFrame:
    """Texts that could not be used, for the quarantine folder."""
    return decoded.filter(~F.col("usable")).select(column)


def parse_events(events: DataFrame, column: str = "value") -> DataFrame:
    return trades_from(decode_events(events, column))
