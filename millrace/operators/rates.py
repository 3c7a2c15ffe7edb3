"""Exchange rates: from raw text to a daily table that is refreshed incrementally."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import decimal_text


def clean_landed(rates: DataFrame) -> DataFrame:
    """Landed rates without the request range columns some files carry."""
    return rates.drop("start_date", "end_date")


def rate_from_document(documents: DataFrame, symbol: str) -> DataFrame:
    """(rate, date) of one symbol from latest-rate documents; null rate when not quoted."""
    return documents.select(
        F.try_element_at("rates", F.lit(symbol)).alias("rate"), F.col("date")
    )


def parse_rates(raw: DataFrame) -> DataFrame:
    """Text rates to typed columns; decimal comma or point, malformed text becomes null."""
    return raw.select(
        "base",
        F.col("code").alias("symbol"),
        decimal_text(F.col("rate")).alias("rate"),
        F.col("date").try_cast("date").alias("date"),
    )


def daily_rates(rates: DataFrame) -> DataFrame:
    """Minimum, mean and maximum rate per base, symbol and date, with the load time."""
    return (
        rates.groupBy("base", "symbol", "date")
        .agg(
            F.min("rate").alias("min_rate"),
            F.avg("rate").alias("avg_rate"),
            F.max("rate").alias("max_rate"),
        )
        .select(
            "base",
            "symbol",
            "min_rate",
            "avg_rate",
            "max_rate",
            "date",
            F.current_timestamp().alias("timestamp"),
        )
    )


def drop_last_day(daily: DataFrame) -> DataFrame:
    """Stored rows except those of the newest date; undated rows stay."""
    newest = daily.agg(F.max("date")).scalar()
    return daily.where(F.coalesce(F.col("date") != newest, F.lit(True)))


def rows_of_new_days(rates: DataFrame, daily: DataFrame) -> DataFrame:
    """Rates of days the stored table does not hold yet.

    Broadcasting the stored days is safe at any size: the date type has fewer than four
    million values, whatever the table holds. The rates are filtered without a shuffle.
    """
    days = daily.select("date").distinct()
    return rates.join(F.broadcast(days), "date", "left_anti").select(*rates.columns)


def row_count(rates: DataFrame) -> DataFrame:
    return rates.agg(F.count("*").alias("cnt"))
