"""Sliding counters over event time, recent items and score normalisation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def sliding_count(events: DataFrame, keys: list[str], width_us: int) -> DataFrame:
    """Adds cnt: events of the key in (ts - width, ts], on integer microseconds in ts_us; an event exactly `width` old is out.

    Each event is counted in its own stretch of time and sent once more to the next one, so a key that holds a third of
    all events is spread over as many tasks as it has stretches, and none of them sorts the whole key.
    """
    stretch = F.floor(F.col("ts_us") / width_us)
    twice = F.explode(F.array(F.struct(stretch.alias("s"), F.lit(True).alias("own")), F.struct((stretch + 1).alias("s"), F.lit(False).alias("own"))))
    spread = events.withColumn("_c", twice)
    window = W.partitionBy(*keys, F.col("_c.s")).orderBy("ts_us").rangeBetween(-(width_us - 1), 0)
    return spread.withColumn("cnt", F.count("*").over(window)).filter("_c.own").drop("_c")


def recent(events: DataFrame, keys: list[str], item: str, order: str, most: int, since: int | None = None) -> DataFrame:
    """Latest entry per (key, item), then the newest `most` items of each key (ties by item)."""
    last = events.groupBy(*keys, item).agg(F.max(order).alias(order))
    if since is not None:
        last = last.filter(F.col(order) >= since)
    return last.withColumn("rank", F.row_number().over(W.partitionBy(*keys).orderBy(F.desc(order), item))).filter(F.col("rank") <= most)


def share_of_max(value: Column, keys: list[str]) -> Column:
    top = F.max(value).over(W.partitionBy(*keys))
    return F.when(top > 0, value / top).otherwise(F.lit(0.0))
