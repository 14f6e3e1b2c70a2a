"""Thin adapters to systems outside Spark; nothing here runs without them."""

from __future__ import annotations

import re
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

_CHARSET = re.compile(r"charset\s*=\s*[\"']?\s*([A-Za-z0-9_.:\-]+)", re.I)
HEADERS = "array<struct<key:string,value:binary>>"


def header_map(headers):
    """Broker headers as map<string,string>; of repeated keys the last one counts."""
    entries = F.transform(headers, lambda h: F.struct(h["key"].alias("key"), h["value"].cast("string").alias("value")))
    last = F.filter(entries, lambda e, i: F.size(F.filter(F.slice(entries, i + 2, F.size(entries)), lambda o: o["key"] == e["key"])) == 0)
    return F.map_from_entries(last)


def header_entries(headers):
    return F.transform(F.map_entries(headers), lambda e: F.struct(e["key"].alias("key"), e["value"].cast("binary").alias("value")))


def topic_stream(spark: SparkSession, servers: str, topics: str) -> DataFrame:
    """Topic from its first offset; the checkpoint stands for committed offsets.  Needs the broker package on the classpath."""
    stream = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topics)
    stream = stream.option("startingOffsets", "earliest").option("includeHeaders", "true").load()
    return stream.withColumn("headers", header_map(F.col("headers")))


def publish(messages: DataFrame, servers: str, checkpoint: str):
    """messages(topic, key, value, headers): partitioned by key."""
    out = messages.withColumn("headers", header_entries(F.col("headers")))
    return out.writeStream.format("kafka").option("kafka.bootstrap.servers", servers).option("checkpointLocation", checkpoint)


def first_header(entries, name: str):
    """First value of a response header in array<struct<key,value>>, its name in any case; null without one."""
    hit = F.filter(entries, lambda h: F.lower(h["key"]) == name.lower())
    return F.try_element_at(F.transform(hit, lambda h: h["value"]), F.lit(1))


def page_text(body, content_type):
    """Bytes of a response as text: by the charset of the content type, else that of the page's head, else UTF-8.

    Unknown charsets are read as UTF-8; bytes that do not fit become U+FFFD.
    """

    @F.pandas_udf("string")
    def decode(data: pd.Series, kind: pd.Series) -> pd.Series:
        def one(d: bytes | None, k: str | None) -> str | None:
            if d is None:
                return None
            named = _CHARSET.search(k or "") or _CHARSET.search(d[:2048].decode("latin-1"))
            try:
                return d.decode(named.group(1) if named else "utf-8", "replace")
            except LookupError:
                return d.decode("utf-8", "replace")

        return pd.Series([one(d, k) for d, k in zip(data, kind)], dtype=object)

    return decode(body, content_type)


def observed(df: DataFrame, name: str, **figures) -> tuple[DataFrame, Observation]:
    """df with figures (aggregates by name) gathered while it is written: the counters of a stage without a pass of their own."""
    seen = Observation(name)
    return df.observe(seen, *[c.alias(k) for k, c in figures.items()]), seen


#: Fetchers by kind: functions from jobs(url) to pages; plugged in by the caller, as the library does no network access.
FETCHERS: dict[str, Callable[[DataFrame], DataFrame]] = {}


def fetch(jobs: DataFrame, kind: str) -> DataFrame:
    if kind not in FETCHERS:
        raise LookupError(f"no fetcher is registered for {kind!r}")
    return FETCHERS[kind](jobs)
