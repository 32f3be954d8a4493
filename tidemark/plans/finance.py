"""Share prices."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import to_zone
from tidemark.operators.incremental import watermark_gate
from tidemark.operators.loading import merge_upsert
from tidemark.operators.windows import price_movements


def load(batch: DataFrame, stored: DataFrame, state: DataFrame, now: dt.datetime) -> tuple[DataFrame, DataFrame]:
    """Merge a batch by id if it passes the watermark; returns table and new state."""
    accepted, new_state = watermark_gate(batch, state, "date_time", now)
    return merge_upsert(stored, accepted, ["id"], ["date_time"]), new_state


def base_gsheets_finance(prices: DataFrame) -> DataFrame:
    rows = price_movements(prices, ["stock"], "price", "date_time", "id")
    return rows.select(
        "id",
        "stock",
        F.col("price").cast("decimal(18,3)").alias("price"),
        to_zone("date_time").alias("date_time"),
        "price_spread",
        "relative_price_movement",
        "abs_price_movement",
        "num_stock_entries",
    )
