"""At-least-once deliveries reduced to one copy per message (problem 7)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harrowmill.functions.urls import normalize_or_keep


def _arrival() -> Column:
    """Order of deliveries: earliest delivered_at (null last), then smallest delivery_id."""
    return F.struct(F.col("delivered_at").isNull().alias("late"), "delivered_at", "delivery_id")


def message_identity(deliveries: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(topic, message, delivered_at, delivery_id, named_url) with one identifier for all copies of a message.

    The id identifies a message within its topic.  Where it is null or empty, the normalised url
    tells which message was delivered: the id first seen with that url in the topic (earliest
    delivery, then smallest delivery_id), or the url itself if no identified delivery has it.  A
    delivery with neither id nor url is a message of its own.  A null topic is a topic of its own.
    Rows without delivery_id are left out.  Extra columns of any name are ignored.

    known: ids that earlier batches had with an url, as known_ids gives them; they take part in "first seen".
    named_url: the normalised url of a delivery that has an id and an url, else null.
    """
    rows = deliveries.select(
        F.coalesce(F.col("topic"), F.lit("\u0000")).alias("topic"),
        F.when(F.col("id") != "", F.col("id")).alias("_id"),
        # A delivery without a url gets a key of its own, so that such rows never meet in one task.
        F.coalesce(
            F.when(F.col("url") != "", normalize_or_keep(F.col("url"))),
            F.concat(F.lit("\u0000"), F.col("delivery_id").cast("string")),
        ).alias("_url"),
        "delivered_at",
        "delivery_id",
    ).filter(F.col("delivery_id").isNotNull())
    named = rows.filter(F.col("_id").isNotNull())
    loose = rows.filter(F.col("_id").isNull())
    wanted = loose.select("topic", "_url").distinct()
    # Partial aggregation collapses a hot url before the shuffle; only urls of loose rows are kept.
    seen = named.select("topic", "_url", "_id", _arrival().alias("_at"))
    if known is not None:
        seen = seen.unionByName(known)
    first_id = _first_ids(seen.join(wanted, ["topic", "_url"], "left_semi")).withColumnRenamed("_id", "_found")
    loose = loose.join(first_id, ["topic", "_url"], "left")
    message = F.coalesce(
        F.concat(F.lit("i:"), F.col("_found")),
        F.concat(F.lit("u:"), F.col("_url")),
    )
    cols = ["topic", "message", "delivered_at", "delivery_id", "named_url"]
    url = F.when(~F.col("_url").startswith("\u0000"), F.col("_url"))
    return (
        named.withColumn("message", F.concat(F.lit("i:"), F.col("_id"))).withColumn("named_url", url).select(*cols)
        .unionByName(loose.withColumn("message", message).withColumn("named_url", F.lit(None).cast("string")).select(*cols))
    )


def _first_ids(seen: DataFrame) -> DataFrame:
    """(topic, _url, _id): the id first seen with each url."""
    return seen.groupBy("topic", "_url").agg(F.min(F.struct("_at", "_id")).alias("_m")).select("topic", "_url", F.col("_m._id").alias("_id"))


def _kept(identified: DataFrame) -> DataFrame:
    return (
        identified.groupBy("topic", "message")
        .agg(F.min(_arrival()).alias("_first"), F.count("*").alias("copies"))
        .select("topic", "message", F.col("_first.delivery_id").alias("delivery_id"), "copies")
    )


def _with_urls(identified: DataFrame) -> DataFrame:
    """The kept deliveries with the urls their id came with; copies are reduced to one row per url before they are gathered."""
    per_url = identified.groupBy("topic", "message", "named_url").agg(F.min(_arrival()).alias("_first"), F.count("*").alias("copies"))
    return (
        per_url.groupBy("topic", "message")
        .agg(
            F.min("_first").alias("_first"), F.sum("copies").alias("copies"),
            F.collect_list(F.when(F.col("named_url").isNotNull(), F.struct(F.col("named_url").alias("url"), F.col("_first").alias("at")))).alias("urls"),
        )
        .select("topic", "message", F.col("_first.delivery_id").alias("delivery_id"), "copies", "urls")
    )


def first_deliveries(deliveries: DataFrame) -> DataFrame:
    """The kept delivery of each message: earliest delivered_at (null last), then smallest delivery_id.

    Rank one is taken by a min over (arrival, tie-break) rather than a window, so that a message
    holding a third of all rows is reduced on the map side and never sorted in one task.  urls: the
    normalised urls the id was delivered with and when first; later batches need them (new_messages).
    """
    return _with_urls(message_identity(deliveries))


def redundant_deliveries(deliveries: DataFrame) -> DataFrame:
    """delivery_id of every copy that is not kept; the anti-join key is unique, hence never skewed."""
    kept = _kept(message_identity(deliveries)).select("delivery_id")
    every = deliveries.select("delivery_id").filter(F.col("delivery_id").isNotNull()).distinct()
    return every.join(kept, "delivery_id", "left_anti")


def unique_deliveries(deliveries: DataFrame) -> DataFrame:
    """All columns of the kept deliveries; exactly repeated rows of a delivery_id appear once."""
    kept = _kept(message_identity(deliveries)).select("delivery_id")
    return deliveries.join(kept, "delivery_id", "left_semi").dropDuplicates(["delivery_id"])


def known_ids(stored: DataFrame) -> DataFrame:
    """(topic, _url, _id, _at): the ids that the stored messages had with an url."""
    rows = stored.select("topic", "message", F.explode("urls").alias("_u"))
    return rows.select("topic", F.col("_u.url").alias("_url"), F.expr("substring(message, 3)").alias("_id"), F.col("_u.at").alias("_at"))


def _claimed(identified: DataFrame, stored: DataFrame, known: DataFrame) -> DataFrame:
    """(topic, message) of ids that a batch is the first to give to an url stored without one: the url's message is theirs."""
    # What the store once decided stays: an url whose message has found its id is not given to another.
    without = stored.filter(F.col("message").startswith("u:")).select("topic", F.expr("substring(message, 3)").alias("_url"))
    without = without.join(known.select("topic", "_url").distinct(), ["topic", "_url"], "left_anti")
    named = identified.filter(F.col("named_url").isNotNull())
    seen = named.select("topic", F.col("named_url").alias("_url"), F.expr("substring(message, 3)").alias("_id"), _arrival().alias("_at"))
    first = _first_ids(seen.join(without, ["topic", "_url"], "left_semi"))
    return first.select("topic", F.concat(F.lit("i:"), F.col("_id")).alias("message")).distinct()


def new_messages(batch: DataFrame, stored: DataFrame) -> DataFrame:
    """Kept deliveries of a batch whose message is not stored yet.

    stored: as returned by first_deliveries or store_after.  Identities are resolved over store and
    batch together: a delivery without id takes the id that either had first with its url, and an id
    that is first to come with an url stored without one is that stored message.  Anti-joins, no
    broadcast is forced.
    """
    known = known_ids(stored)
    identified = message_identity(batch, known)
    old = stored.select("topic", "message").unionByName(_claimed(identified, stored, known))
    return _kept(identified).join(old, ["topic", "message"], "left_anti")


def store_after(stored: DataFrame, batch: DataFrame) -> DataFrame:
    """The store with a batch taken in: new messages, ids found for stored urls, further urls of stored ids."""
    rows = stored.withColumn("_new", F.lit(False)).unionByName(_with_urls(message_identity(batch, known_ids(stored))).withColumn("_new", F.lit(True)))
    merged = rows.groupBy("topic", "message").agg(
        F.min_by("delivery_id", "_new").alias("delivery_id"), F.sum("copies").alias("copies"), F.flatten(F.collect_list("urls")).alias("_u")
    )
    # One entry per url, at its first arrival.
    first = F.filter("_u", lambda x: ~F.exists("_u", lambda y: (y["url"] == x["url"]) & (y["at"] < x["at"])))
    return merged.select("topic", "message", "delivery_id", "copies", F.array_distinct(first).alias("urls"))
