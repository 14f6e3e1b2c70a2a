"""Priority queues, buffers, retries, backlog and schedules as set operations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

PRIORITY_STEP = 10**13


def priority_of(value: Column, default: int = 2) -> Column:
    """1, 2 or 3; anything else, unreadable text included, is the default."""
    p = value.try_cast("int")
    return F.when(p.between(1, 3), p).otherwise(F.lit(default))


def priority_score(priority: Column, arrival_ms: Column) -> Column:
    return priority_of(priority).cast("bigint") * PRIORITY_STEP + arrival_ms


def push_capped(events: DataFrame, cap: int) -> DataFrame:
    """events(id, priority, arrival_ms): the last push of an id counts, the best `cap` scores stay (ties by id)."""
    last = events.groupBy("id").agg(F.max_by(F.struct("priority", "arrival_ms"), F.struct("arrival_ms", "priority")).alias("e"))
    scored = last.select("id", priority_score(F.col("e.priority"), F.col("e.arrival_ms")).alias("score"))
    return scored.orderBy("score", "id").limit(cap)


def drain_fifo(buffer: DataFrame, keys: list[str], cap: int, n: int) -> DataFrame:
    """Per label: the newest `cap` entries stay, the oldest n of them are taken."""
    newest = buffer.withColumn("_new", F.row_number().over(W.partitionBy(*keys).orderBy(F.desc("arrival"), F.desc("id")))).filter(F.col("_new") <= cap)
    return newest.withColumn("rank", F.row_number().over(W.partitionBy(*keys).orderBy("arrival", "id"))).filter(F.col("rank") <= n).drop("_new")


def drain_quota(target: Column, backlog: Column, batch: Column, length: Column) -> Column:
    return F.greatest(F.least(target - backlog, batch, length), F.lit(0))


def backoff_seconds(attempt: Column, first: float, factor: float, most: float, jitter: float = 0.0, seed: int | None = None) -> Column:
    base = F.least(F.lit(first) * F.pow(F.lit(factor), attempt - 1), F.lit(most))
    return base if not jitter else base * (1 + jitter * (2 * F.rand(seed) - 1))


def backlog(latest: DataFrame, committed: DataFrame, keys: list[str]) -> DataFrame:
    """Sum of latest minus committed per topic, never below zero; unknown commits and unmatched partitions are skipped."""
    both = latest.join(committed.filter("committed >= 0"), [*keys, "partition_no"])
    return both.groupBy(*keys).agg(F.sum(F.greatest(F.col("latest") - F.col("committed"), F.lit(0))).alias("backlog"))


def throttled(backlog: Column, most: Column) -> Column:
    """Above the limit; no limit (zero or less) and an unknown backlog never throttle."""
    return F.coalesce((most > 0) & (backlog > most), F.lit(False))


def schedule_diff(running: DataFrame, desired: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """added, removed, changed or same for each entry of either side."""
    a = running.select(*keys, F.struct(*values).alias("_old"))
    b = desired.select(*keys, F.struct(*values).alias("_new"))
    j = a.join(b, keys, "full")
    change = F.when(F.col("_old").isNull(), "added").when(F.col("_new").isNull(), "removed").when(~F.col("_old").eqNullSafe(F.col("_new")), "changed").otherwise("same")
    return j.select(*keys, change.alias("change"))


def schedule_ticks(entries: DataFrame, start_s: int, end_s: int) -> DataFrame:
    """One row per emission: at the start and then each interval; entries without a positive interval emit nothing."""
    ticks = F.sequence(F.lit(start_s).cast("bigint"), F.lit(end_s).cast("bigint"), F.col("interval_s").cast("bigint"))
    return entries.filter("interval_s > 0").withColumn("tick_s", F.explode(ticks))


def stage_slots(workers: Column, configured: Column) -> Column:
    """Slots of a stage: half its workers, at least one, and no more than configured where that is positive."""
    half = F.greatest(F.floor(workers / 2), F.lit(1))
    return F.when(configured > 0, F.least(half, configured)).otherwise(half).cast("int")


def due_retries(schedule: DataFrame, entries: DataFrame, now_ms: DataFrame, most: int) -> tuple[DataFrame, DataFrame]:
    """(due, orphans) of schedule(id, due_ms): the `most` earliest due ones with their entries(id, ...), and due ids without an entry.

    now_ms is a one-row table (now_ms), so nothing runs before the query does.
    """
    due = schedule.join(F.broadcast(now_ms.select("now_ms")), F.col("due_ms") <= F.col("now_ms")).select("id", "due_ms")
    first = due.orderBy("due_ms", "id").limit(most)
    return first.join(entries, "id"), first.join(entries.select("id"), "id", "left_anti").select("id")


def provider_order(providers: DataFrame, request: str, *order: Column | str) -> DataFrame:
    """providers with rank: their place for a request by the given order, ties by the place they are stated in."""
    return providers.withColumn("rank", F.row_number().over(W.partitionBy(request).orderBy(*order, "place")))


def first_of(rows: DataFrame, keys: list[str], most: int, *order: Column | str) -> DataFrame:
    """The first `most` rows of each key with their rank; rows beyond are cut within each task before they meet."""
    return rows.withColumn("rank", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).filter(F.col("rank") <= most)


def republished(due: DataFrame, failed: DataFrame, now_ms: Column, wait_ms: int) -> tuple[DataFrame, DataFrame]:
    """(messages to publish, schedule after the round) of due(id, due_ms, attempts).

    At least once: an entry is taken off the schedule only after its publication; those in failed(id) stay, later by
    wait_ms for each attempt.
    """
    bad = due.join(failed.select("id").distinct(), "id", "left_semi")
    later = bad.select("id", (now_ms + wait_ms * (F.col("attempts") + 1)).cast("bigint").alias("due_ms"), (F.col("attempts") + 1).alias("attempts"))
    return due, later


def intake(messages: DataFrame, cap: int) -> DataFrame:
    """messages(id, priority, arrival_ms) -> the queue after it took them: blank ids are dropped, then as push_capped."""
    return push_capped(messages.filter(F.coalesce("id", F.lit("")) != ""), cap)
