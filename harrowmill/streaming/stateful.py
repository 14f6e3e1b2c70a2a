"""Structured Streaming versions of the ordered operators: one row of state per key, timers for expiry."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from harrowmill.session import ensure_checkpoint_dir


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below the cluster's checkpoint folder, for stream checkpoints and sinks."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def event_stream(spark: SparkSession, folder: str, files: str, schema: Any, per_trigger: int = 4) -> DataFrame:
    """File stream that stands in for a topic where no broker is at hand."""
    return spark.readStream.schema(schema).option("pathGlobFilter", files).option("maxFilesPerTrigger", per_trigger).parquet(folder)


def run_to_end(stream: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """Runs a stream over all that is available and returns the rows it wrote."""
    spark = stream.sparkSession
    base = shared_folder(spark, name)
    q = stream.writeStream.format("parquet").outputMode(mode).option("checkpointLocation", f"{base}/check").option("path", f"{base}/out").trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{base}/out")


def _timed(events: DataFrame, late: str) -> DataFrame:
    """events with their time as watermark: state expires when the watermark has passed what it can still decide.

    A watermark begins at 1970; events of that instant or before are put just behind it, so that none is late at the start.
    """
    return events.withColumn("at", F.timestamp_micros(F.greatest("ts_us", F.lit(0)) + 1000)).withWatermark("at", late)


def _in_order(batches: Iterator[pd.DataFrame], columns: list[str]) -> pd.DataFrame:
    """The rows of one key in one micro-batch in (ts_us, id) order; a trigger bounds how many these are."""
    return pd.concat([b[columns] for b in batches]).sort_values(["ts_us", "id"], kind="stable")


def ttl_dedup_stream(events: DataFrame, ttl_us: int, late: str = "7 days") -> DataFrame:
    """events(key, id, ts_us, kind) -> accepted rows: one per key and TTL; kind 'release' frees the key at once.

    State is the time of the last acceptance of the key; rejects do not extend it.  Rows of a batch are taken in
    (ts_us, id) order.  A key's state is dropped once the watermark has passed its TTL; events later than `late` are
    not promised to count.
    """
    schema = "key string, id bigint, ts_us bigint"

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        last = state.get[0] if state.exists else None
        out = []
        rows = _in_order(batches, ["id", "ts_us", "kind"])
        for i, t, kind in zip(rows["id"], rows["ts_us"], rows["kind"]):
            if kind == "release":
                last = None
            elif last is None or t >= last + ttl_us:
                last = int(t)
                out.append((key[0], int(i), int(t)))
        if last is None:
            if state.exists:
                state.remove()
        else:
            state.update((last,))
            state.setTimeoutTimestamp(max((last + ttl_us) // 1000 + 1, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame(out, columns=["key", "id", "ts_us"])

    return _timed(events, late).groupBy("key").applyInPandasWithState(step, schema, "last bigint", "append", GroupStateTimeout.EventTimeTimeout)


def failure_count_stream(events: DataFrame, width_us: int, threshold: int, late: str = "7 days") -> DataFrame:
    """events(key, id, ts_us) -> rows at which a key has had `threshold` or more failures within the window.

    State holds the times within one window of the last event and is dropped once the watermark has passed that window.
    """
    schema = "key string, id bigint, cnt int"

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        kept = list(state.get[0]) if state.exists else []
        out = []
        for t, same in _in_order(batches, ["id", "ts_us"]).groupby("ts_us", sort=True):
            kept = [x for x in kept if x > t - width_us] + [int(t)] * len(same)
            if len(kept) >= threshold:
                out += [(key[0], int(i), len(kept)) for i in same["id"]]
        state.update((kept,))
        state.setTimeoutTimestamp(max((kept[-1] + width_us) // 1000 + 1, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame(out, columns=["key", "id", "cnt"])

    return _timed(events, late).groupBy("key").applyInPandasWithState(step, schema, "times array<bigint>", "append", GroupStateTimeout.EventTimeTimeout)


def retry_route(messages: DataFrame, most: int = 3) -> DataFrame:
    """Stateless step of the retry loop: below the limit a message is scheduled again with backoff, else it is dead."""
    from harrowmill.operators.queueing import backoff_seconds

    n = F.col("retry_count") + 1
    again = F.col("retry_count") < most
    return messages.withColumns({"route": F.when(again, "requeue").otherwise("dead"), "wait_s": F.when(again, backoff_seconds(n, 5.0, 2.0, 300.0))})


def store_stream(stream: DataFrame, merge: Callable[[DataFrame, DataFrame | None], DataFrame], name: str) -> DataFrame:
    """Runs a stream into a store that each batch is merged with: merge(batch, store so far or null) -> the new store.

    Every batch writes its own version of the store, under its number, which repeats after a restart: a batch that was
    written in part is written again as a whole.  Returns the last version.
    """
    spark = stream.sparkSession
    base = shared_folder(spark, name)
    last: list[str | None] = [None]

    def sink(batch: DataFrame, number: int) -> None:
        before = batch.sparkSession.read.parquet(last[0]) if last[0] else None
        merge(batch, before).write.mode("overwrite").parquet(f"{base}/store-{number}")
        last[0] = f"{base}/store-{number}"

    stream.writeStream.foreachBatch(sink).option("checkpointLocation", f"{base}/check").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(last[0]) if last[0] else merge(spark.createDataFrame([], stream.schema), None)
