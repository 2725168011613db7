"""Auction statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# Columns of the auction file, by position, and the price an expensive one exceeds.
AUCTIONS = (
    "`Auction Id` string, bid double, bidtime double, bidder string, bidderdate int, "
    "openbid double, price double, item string, dtl int"
)
EXPENSIVE = 75.0


def auction_total(bids: DataFrame) -> DataFrame:
    return bids.agg(F.count_distinct("Auction Id").alias("auctions"))


def bids_per_item(bids: DataFrame) -> DataFrame:
    """Number, lowest, highest and mean bid of each item, in one aggregation."""
    return bids.groupBy("item").agg(
        F.count("*").alias("bids"),
        F.min("bid").alias("min_bid"),
        F.max("bid").alias("max_bid"),
        F.avg("bid").alias("avg_bid"),
    )


def expensive_auctions(bids: DataFrame, above: float = EXPENSIVE) -> DataFrame:
    return bids.where(F.col("price") > above).select("Auction Id", "item", "price").distinct()
