"""Idempotent storage: ids, deduplication, upserts, retention and dead letters as DataFrame rewrites."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def content_id(url: Column) -> Column:
    return F.substring(F.sha2(url, 256), 1, 32)


def content_hash(body: Column) -> Column:
    return F.sha2(body, 256)


def word_count(body: Column) -> Column:
    return F.size(F.filter(F.split(body, r"(?U)\s+"), lambda w: w != ""))


def dedup_by_hash(batch: DataFrame, stored: DataFrame, order: str = "arrival") -> DataFrame:
    """batch(id, content_hash, arrival) -> (id, kept_id, duplicate): a body stored before, or earlier in the batch, is a duplicate.

    The first of the batch is a min over (arrival, id), so a hash that many rows share is combined on the map side.
    """
    first = batch.groupBy("content_hash").agg(F.min(F.struct(order, "id")).alias("_f"))
    before = stored.groupBy("content_hash").agg(F.min("id").alias("_stored"))
    known = first.join(before, "content_hash", "left").select("content_hash", F.coalesce("_stored", "_f.id").alias("kept_id"))
    return batch.join(known, "content_hash").select("id", "kept_id", (F.col("id") != F.col("kept_id")).alias("duplicate"))


def store_raw(batch: DataFrame, stored: DataFrame) -> DataFrame:
    """Inserts pages whose url is not stored; of one url in the batch the smallest id stays."""
    fresh = batch.join(stored.select("url").distinct(), "url", "left_anti")
    keep = fresh.groupBy("url").agg(F.min("id").alias("id"))
    return stored.unionByName(fresh.join(keep, ["url", "id"], "left_semi").dropDuplicates(["url"]))


def store_outcome(batch: DataFrame, stored: DataFrame) -> DataFrame:
    """batch(id, url) -> (id, url, stored_id, duplicate): the id each page is stored under, its own or that of an earlier page with its url."""
    first = batch.groupBy("url").agg(F.min("id").alias("_new"))
    known = first.join(stored.groupBy("url").agg(F.min("id").alias("_old")), "url", "left").select("url", F.coalesce("_old", "_new").alias("stored_id"))
    return batch.join(known, "url").select("id", "url", "stored_id", (F.col("id") != F.col("stored_id")).alias("duplicate"))


#: Columns that the incoming row overwrites when the hash differs; all others keep their first value.
OVERWRITTEN = ["title", "author", "updated_at", "category", "tags", "canonical_url", "content_hash", "reliability"]


def upsert_contents(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """Upsert by url: partial columns change only with the hash, body and summary always; new urls are inserted whole.

    incoming holds one row a url (reduce it first); columns of both frames are those of stored.
    """
    new = incoming.select(F.col("url"), *[F.col(c).alias(f"_{c}") for c in stored.columns if c != "url"], F.lit(True).alias("_in"))
    both = stored.withColumn("_have", F.lit(True)).join(new, "url", "full")
    changed = F.coalesce(~F.col("content_hash").eqNullSafe(F.col("_content_hash")), F.lit(True))
    out = []
    for c in stored.columns:
        if c == "url":
            out.append(F.col("url"))
            continue
        if c in OVERWRITTEN:
            value = F.when(F.col("_in") & changed, F.col(f"_{c}")).otherwise(F.col(c))
        elif c in ("body", "summary", "word_count"):
            value = F.when(F.col("_in"), F.col(f"_{c}")).otherwise(F.col(c))
        else:
            value = F.col(c)
        out.append(F.when(F.col("_have").isNull(), F.col(f"_{c}")).otherwise(value).alias(c))
    return both.select(*out)


def latest_per_key(rows: DataFrame, keys: list[str], *order: str) -> DataFrame:
    """The row with the greatest order columns per key, whole; no window, hence no sort of a hot key."""
    rest = [c for c in rows.columns if c not in keys]
    best = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_r"))
    return best.select(*keys, "_r.*")


def dead_letters(messages: DataFrame, error: Column) -> tuple[DataFrame, DataFrame]:
    """(good, dead): rows with an error get the headers original-topic and error besides their own."""
    marked = messages.withColumn("_error", error)
    extra = F.map_from_arrays(F.array(F.lit("original-topic"), F.lit("error")), F.array(F.col("topic"), F.col("_error")))
    own = F.map_filter("headers", lambda k, _: ~k.isin("original-topic", "error"))
    dead = marked.filter(F.col("_error").isNotNull()).withColumn("headers", F.map_concat(own, extra)).drop("_error")
    return marked.filter(F.col("_error").isNull()).drop("_error"), dead


def analyze_sources(rows: DataFrame) -> DataFrame:
    """rows(source_id, country, language, source_type, host, base_host, rph) -> one row per source with its hosts.

    host is the one of the base url where records have it, else the first by name; mismatch names the first of country,
    language, type and rate that the rows of a source disagree in, for which the caller rejects it.
    """
    differs = lambda c: F.count_distinct(c) > 1
    mismatch = F.when(differs("country"), "country").when(differs("language"), "language").when(differs("source_type"), "type").when(differs("rph"), "rate")
    host = F.coalesce(F.min(F.when(F.col("host") == F.col("base_host"), F.col("host"))), F.min("host"))
    hosts = F.array_sort(F.collect_set("host"))
    return rows.groupBy("source_id").agg(
        host.alias("host"), F.count_distinct("host").alias("hosts"), F.array_join(hosts, ",").alias("all_hosts"), mismatch.alias("mismatch"), F.max("rph").alias("requests_per_hour")
    )
