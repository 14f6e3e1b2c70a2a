"""Mixed timestamp notations and zones normalised to one instant in UTC (problem 3)."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime, timedelta, timezone

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harrowmill.functions.datetimes import epoch_number_ms, local_epoch_ms, notation_parts, part, written_offset_minutes

CANONICAL = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}Z$"
FIRST_YEAR, LAST_YEAR = 1900, 2100


def _zone_intervals(name: str) -> list[tuple[int, int, int]]:
    """(local start ms, local end ms, offset minutes) of each period of one offset, by bisection on UTC days."""
    from zoneinfo import ZoneInfo

    try:
        zone = ZoneInfo(name)
    except Exception:  # unknown names simply have no interval
        return []

    def offset(t: int) -> int:
        return int(datetime.fromtimestamp(t, timezone.utc).astimezone(zone).utcoffset() / timedelta(seconds=1))

    begin = int(datetime(FIRST_YEAR - 1, 12, 30, tzinfo=timezone.utc).timestamp())
    end = int(datetime(LAST_YEAR + 1, 1, 2, tzinfo=timezone.utc).timestamp())
    step, out, start, now = 7 * 86400, [], begin, offset(begin)
    t = begin
    while t < end:
        nxt = min(t + step, end)
        if (o := offset(nxt)) != now:
            lo, hi = t, nxt
            while hi - lo > 1:
                mid = (lo + hi) // 2
                lo, hi = (mid, hi) if offset(mid) == now else (lo, mid)
            out.append(((start + now) * 1000, (hi + now) * 1000, now))
            start, now = hi, offset(hi)
            t = hi
            continue
        t = nxt
    out.append(((start + now) * 1000, (end + now) * 1000, now))
    return out


def zone_offset_intervals(zones: DataFrame) -> DataFrame:
    """zones(zone) -> (zone, year, local_start, local_end, offset_s): each interval exploded to the local years it touches.

    Size bound: the public zone database has fewer than 600 names; the 201 years that the parser takes with at most four
    intervals each give under 485,000 rows of 40 bytes, so the table may be broadcast.
    """

    def expand(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for name in batch["zone"]:
                for a, b, o in _zone_intervals(name):
                    first = datetime.fromtimestamp(a / 1000, timezone.utc).year
                    last = datetime.fromtimestamp(b / 1000 - 1, timezone.utc).year
                    rows += [(name, y, a, b, o) for y in range(first, last + 1)]
            yield pd.DataFrame(rows, columns=["zone", "year", "local_start", "local_end", "offset_s"])

    named = zones.select("zone").filter(F.col("zone").isNotNull()).distinct()
    return named.mapInPandas(expand, "zone string, year int, local_start bigint, local_end bigint, offset_s int")


def normalize_timestamps(rows: DataFrame, text: str = "text", zone: str = "zone", country: str = "country") -> DataFrame:
    """Adds epoch_ms and status to rows with a timestamp string, its clock's zone name and a country.

    status: absent (null, blank), unreadable (relative or meaningless values, impossible dates), direct (zone or
    offset written), exact (one interval holds the local time), ambiguous (two do; the earlier instant is given),
    nonexistent (none does: skipped by a clock change; epoch_ms null), no_zone (neither written nor known).
    Null zones are allowed.  Rows are neither dropped nor repeated, repeated rows included; columns of rows other
    than epoch_ms and status are kept.
    """
    kept = rows.columns
    base = rows.withColumn("_p", notation_parts(F.col(text)))
    base = base.withColumn("_local", local_epoch_ms(F.col("_p"), F.coalesce(F.col(country) == "US", F.lit(False))))
    base = base.withColumn("_off", written_offset_minutes(part(F.col("_p"), "z"))).withColumn("_number", epoch_number_ms(F.col("_p")))
    base = base.withColumn("_wall", F.when(F.col("_number").isNull() & part(F.col("_p"), "z").isNull(), F.col("_local")))
    base = base.withColumn("_year", F.year(F.timestamp_millis(F.col("_wall"))))
    # As-of join on (zone, local year) with the interval bounds as residual condition.  Two matches are folded by
    # collecting the offsets per zone year first, so the left side is never multiplied or shuffled.
    spans = zone_offset_intervals(rows.select(F.col(zone).alias("zone")))
    spans = spans.groupBy("zone", "year").agg(F.collect_list(F.struct("local_start", "local_end", "offset_s")).alias("_spans"))
    spans = spans.select(F.col("zone").alias("_zone"), F.col("year").alias("_span_year"), "_spans")
    joined = base.join(F.broadcast(spans), (F.col(zone) == F.col("_zone")) & (F.col("_year") == F.col("_span_year")), "left")
    hits = F.filter("_spans", lambda s: (s["local_start"] <= F.col("_wall")) & (F.col("_wall") < s["local_end"]))
    joined = joined.withColumn("_hits", hits).withColumn("_n", F.size(F.coalesce("_hits", F.array())))
    earliest = F.col("_wall") - F.array_max(F.transform("_hits", lambda s: s["offset_s"])).cast("bigint") * 1000
    direct = F.coalesce(F.col("_number"), F.when(F.col("_off").isNotNull(), F.col("_local") - F.col("_off").cast("bigint") * 60000))
    blank = F.col(text).isNull() | F.col(text).rlike(r"(?U)^\s*$")
    status = (
        F.when(blank, F.lit("absent"))
        .when(direct.isNotNull(), F.lit("direct"))
        .when(F.col("_wall").isNull(), F.lit("unreadable"))
        .when(F.col("_spans").isNull(), F.lit("no_zone"))
        .when(F.col("_n") == 0, F.lit("nonexistent"))
        .when(F.col("_n") == 1, F.lit("exact"))
        .otherwise(F.lit("ambiguous"))
    )
    return joined.select(
        *[joined[c] for c in kept if c not in ("epoch_ms", "status")], F.coalesce(direct, earliest).alias("epoch_ms"), status.alias("status")
    )


def content_clock(contents: DataFrame, sources: DataFrame) -> DataFrame:
    """(record_table, record_id, text, zone, country) of contents.published_at."""
    src = sources.select(F.col("source_id").alias("_sid"), F.col("timezone").alias("_tz"), F.col("country").alias("_country"))
    src = src.filter(F.col("_sid").isNotNull()).dropDuplicates(["_sid"])
    c = contents.select("id", "source_id", "published_at", "country")
    return c.join(src, c.source_id == src._sid, "left").select(
        F.lit("contents").alias("record_table"),
        F.col("id").alias("record_id"),
        F.col("published_at").alias("text"),
        F.col("_tz").alias("zone"),
        F.coalesce("_country", "country").alias("country"),
    )


def raw_clock(raw: DataFrame) -> DataFrame:
    """(record_table, record_id, text, zone, country) of raw_contents.fetched_at, zone from metadata.node_tz."""
    return raw.select(
        F.lit("raw_contents").alias("record_table"),
        F.col("id").alias("record_id"),
        F.col("fetched_at").alias("text"),
        F.get_json_object("metadata", "$.node_tz").alias("zone"),
        F.col("source.country").alias("country"),
    )


def found_instants(contents: DataFrame, raw: DataFrame, sources: DataFrame) -> DataFrame:
    """Records whose timestamp names an instant and is not written canonically yet."""
    rows = content_clock(contents, sources).unionByName(raw_clock(raw))
    known = normalize_timestamps(rows)
    return known.filter(F.col("epoch_ms").isNotNull() & ~F.col("text").rlike(CANONICAL)).select("record_table", "record_id", "epoch_ms")
