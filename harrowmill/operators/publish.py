"""The publish chain: urls are normalised, guarded, let in once per TTL and turned into jobs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harrowmill.functions.urls import first_denied, normalize_or_keep
from harrowmill.operators.folds import ttl_accepts

#: How long a url is kept out after it was let in, in microseconds, by what it leads to.
TTL_US = {"article": 24 * 3600 * 1_000_000, "category": 60 * 1_000_000}
TOPICS = {1: "crawl.high", 2: "crawl.normal", 3: "crawl.low"}


def ttl_of(target_type: Column) -> Column:
    return F.when(target_type == "category", F.lit(TTL_US["category"])).otherwise(F.lit(TTL_US["article"]))


def job_topic(priority: Column) -> Column:
    return F.when(priority == 1, TOPICS[1]).when(priority == 3, TOPICS[3]).otherwise(TOPICS[2])


def job_id(*parts: Column) -> Column:
    """32 hexadecimal digits made from the job's own parts, so that a replay gives the same id."""
    return F.substring(F.sha2(F.concat_ws("\u0001", *[p.cast("string") for p in parts]), 256), 1, 32)


def publish_jobs(requests: DataFrame, denied: Sequence[str] = ()) -> DataFrame:
    """requests(id, crawler, url, target_type, priority, ts_us) -> jobs (job_id, topic, key, url, crawler, target_type, priority, ts_us).

    Urls that cannot be normalised go on as they are; urls that hold a denied part, blank ones and those let in less
    than a TTL before (per url, in (ts_us, id) order) are left out.
    """
    norm = requests.withColumn("url", normalize_or_keep(F.col("url"))).filter(F.coalesce(F.col("url"), F.lit("")) != "")
    open_ = norm.filter(first_denied(F.col("url"), denied).isNull()).withColumn("_ttl", ttl_of(F.col("target_type")))
    let_in = ttl_accepts(open_.select("url", "ts_us", "id", "_ttl"), ["url"], "_ttl").filter("accepted").select("url", "ts_us", "id")
    jobs = open_.join(let_in, ["url", "ts_us", "id"], "left_semi").dropDuplicates(["url", "ts_us", "id"])
    key = F.sha2(F.concat(F.lit("ingestion:url:"), F.sha2("url", 256)), 256)
    return jobs.select(job_id(F.col("crawler"), F.col("url"), F.col("ts_us")).alias("job_id"), job_topic(F.col("priority")).alias("topic"), key.alias("key"), "url", "crawler", "target_type", "priority", "ts_us")


def release(held: DataFrame, failed: DataFrame) -> DataFrame:
    """held(url, until_us) without the urls whose publication failed: they may be let in again at once."""
    return held.join(failed.select("url").distinct(), "url", "left_anti")


def pending_pushes(entries: DataFrame, keys: list[str], most: int = 1000) -> DataFrame:
    """entries(keys, id, arrival) with place and accepted: the first `most` arrivals of each key wait, later ones are refused.

    Places are counted over time slices first, so that no key is sorted in one task: a slice before the one in which
    the limit falls is accepted as a whole.
    """
    from pyspark.sql import Window as W

    slices = entries.withColumn("_slice", F.date_trunc("hour", "arrival"))
    sizes = slices.groupBy(*keys, "_slice").agg(F.count("*").alias("_n"))
    before = sizes.withColumn("_before", F.sum("_n").over(W.partitionBy(*keys).orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)))
    within = slices.withColumn("_k", F.row_number().over(W.partitionBy(*keys, "_slice").orderBy("arrival", "id")))
    placed = within.join(before.select(*keys, "_slice", F.coalesce("_before", F.lit(0)).alias("_before")), [*keys, "_slice"])
    place = F.col("_before") + F.col("_k")
    return placed.withColumns({"place": place, "accepted": place <= most}).drop("_slice", "_k", "_before")
