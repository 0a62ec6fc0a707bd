"""Generated trades."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.texts import hashed_fraction

# The choices a trade is drawn from.
STOCK_FIRST = ["V", "W", "X", "Y", "Z"]
STOCK_SECOND = ["A", "B", "C", "D", "E"]
VOLUMES = [50, 100, 300]
ORIGINS = ["DMA", "Algo", "Internet"]
SHORT_SELL_TYPES = ["", "PDT", "RSS"]
TRADES = 1001
ACCOUNT_BASE = 100_000_000


def _whole(i: Column, salt: str, low: int, high: int) -> Column:
    """A whole number from low to high, both included."""
    return (F.lit(low) + F.floor(hashed_fraction(i, salt) * (high - low + 1))).cast("int")


def _pick(i: Column, salt: str, choices: list) -> Column:
    return F.element_at(F.array(*[F.lit(c) for c in choices]), _whole(i, salt, 1, len(choices)))


def trades(numbers: DataFrame, number: str, total: int = TRADES) -> DataFrame:
    """One trade for every number in `numbers`, drawn from a hash of the number.

    Brokers and accounts of the two sides count up and down from the number.
    """
    i = F.col(number)
    volume = _pick(i, "volume", VOLUMES)
    price = F.lit(0.1) + hashed_fraction(i, "price") * F.lit(0.9)
    origin = _pick(i, "origin", ORIGINS)
    stock = F.concat(
        _whole(i, "stock", 1000, 9999).cast("string"),
        _pick(i, "first", STOCK_FIRST), _pick(i, "second", STOCK_SECOND),
    )
    return numbers.select(
        F.concat(_whole(i, "day", 5, 30).cast("string"), F.lit("/5/20")).alias("Trading_Date"),
        F.lit("Buy").alias("Transaction_Type"),
        stock.alias("Stock_Code"),
        volume.cast("string").alias("Volume"),
        F.substring(price.cast("string"), 1, 4).alias("Price"),
        F.substring((volume * price).cast("string"), 1, 4).alias("Value"),
        F.lit("MYR").alias("Currency"),
        i.cast("string").alias("Buy_Broker_Code"),
        (F.lit(total) - i).cast("string").alias("Sell_Broker_Code"),
        (F.lit(ACCOUNT_BASE) + i).cast("string").alias("Buy_Account_Code"),
        (F.lit(ACCOUNT_BASE + total) - i).cast("string").alias("Sell_Account_Code"),
        origin.alias("Buy_Trade_Origin"),
        origin.alias("Sell_Trade_Origin"),
        _pick(i, "short", SHORT_SELL_TYPES).alias("Short_Sell_Type"),
        F.lit("OMT").alias("Market_Type"),
    )


def generated_trades(spark: SparkSession, total: int = TRADES) -> DataFrame:
    """Trades numbered 0 to total - 1."""
    return trades(spark.range(total), "id", total)
