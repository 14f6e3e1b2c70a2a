"""Streams run over all that is available, beside their batch twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from harrowmill.functions.datetimes import ntz_micros
from harrowmill.operators import queueing as Q, validate as V
from harrowmill.plans import fixtures as X
from harrowmill.plans.registry import Registry
from harrowmill.plans.writing import _CODED, _EV, _HOUR
from harrowmill.sources.tables import table
from harrowmill.streaming import stateful as S

query = Registry()


def _events(spark, d):
    schema = table(spark, d, "events").schema
    e = S.event_stream(spark, d, "events.parquet", schema)
    return e.select(F.col("user_id").cast("string").alias("key"), F.col("event_id").alias("id"), ntz_micros("ts").alias("ts_us"), F.col("event_type").alias("kind"))


@query("stream_validate", f"{_CODED} select id, valid, code from coded")
def stream_validate(spark, d):
    schema = table(spark, d, "contents").schema
    readable = F.col("published_at").rlike(X.CANONICAL_DATE) & ~F.col("published_at").startswith("0001")
    c = S.event_stream(spark, d, "contents.parquet", schema).withColumn("published_s", F.when(readable, F.unix_timestamp(F.to_timestamp("published_at"))))
    return S.run_to_end(V.validated(c).select("id", "valid", "code"), "validate")


@query("stream_dedup", f"with recursive {_EV}, o as (select host, ts_us, id, row_number() over (partition by host order by ts_us, id) as rn from ev), f as (select host, rn, id, ts_us as last, true as accepted from o where rn = 1 "
       f"union all select o.host, o.rn, o.id, case when o.ts_us >= f.last + {24 * _HOUR} then o.ts_us else f.last end, o.ts_us >= f.last + {24 * _HOUR} from f join o on o.host = f.host and o.rn = f.rn + 1) select id from f where accepted")
def stream_dedup(spark, d):
    return S.run_to_end(S.ttl_dedup_stream(_events(spark, d), 24 * _HOUR), "dedup").select("id")


@query("stream_release", f"with recursive {_EV}, o as (select host, ts_us, id, event_type = 'signup' as freed, row_number() over (partition by host order by ts_us, id) as rn from ev), f as (select host, rn, id, case when not freed then ts_us end as last, not freed as accepted from o where rn = 1 "
       f"union all select o.host, o.rn, o.id, case when o.freed then null when f.last is null or o.ts_us >= f.last + {24 * _HOUR} then o.ts_us else f.last end, not o.freed and (f.last is null or o.ts_us >= f.last + {24 * _HOUR}) from f join o on o.host = f.host and o.rn = f.rn + 1) select id from f where accepted")
def stream_release(spark, d):
    e = _events(spark, d).withColumn("kind", F.when(F.col("kind") == "signup", "release").otherwise(F.col("kind")))
    return S.run_to_end(S.ttl_dedup_stream(e, 24 * _HOUR), "release").select("id")


@query("stream_failure_window", f"with {_EV}, w as (select id, count(*) over (partition by host order by ts_us range between {48 * _HOUR - 1} preceding and current row) as cnt from ev where event_type = 'error') select id, cnt::int as cnt from w where cnt >= 2")
def stream_failure_window(spark, d):
    return S.run_to_end(S.failure_count_stream(_events(spark, d).filter("kind = 'error'"), 48 * _HOUR, 2), "failures").select("id", "cnt")


@query("stream_retry", "select event_id as id, case when event_id % 5 < 3 then 'requeue' else 'dead' end as route, case when event_id % 5 < 3 then 5.0::double * pow(2, event_id % 5) end as wait_s from events where event_type = 'error'")
def stream_retry(spark, d):
    e = _events(spark, d).filter("kind = 'error'").withColumn("retry_count", F.col("id") % 5)
    return S.run_to_end(S.retry_route(e).select("id", "route", "wait_s"), "retry")


@query("stream_priority_intake", "select delivery_id as id, case when length(id) % 4 between 1 and 3 then length(id) % 4 else 2 end::int as priority from content_refs where id <> ''")
def stream_priority_intake(spark, d):
    """Messages without id are dropped at the intake, the rest get their class."""
    r = S.event_stream(spark, d, "content_refs.parquet", table(spark, d, "content_refs").schema).filter(F.col("id") != "")
    return S.run_to_end(r.select(F.col("delivery_id").alias("id"), Q.priority_of((F.length("id") % 4).cast("string")).alias("priority")), "intake")


@query("stream_upsert", "select url, arg_max(id, (created_at, id)) as id, count(*)::bigint as seen from raw_contents where url is not null group by 1")
def stream_upsert(spark, d):
    """Pages arriving in batches merged into a store by url: the latest id, and how often the page came."""
    schema = table(spark, d, "raw_contents").schema
    pages = S.event_stream(spark, d, "raw_contents.parquet", schema).filter("url is not null").select("url", "id", "created_at", F.lit(1).cast("bigint").alias("seen"))

    def merge(batch, store):
        rows = batch if store is None else store.unionByName(batch)
        return rows.groupBy("url").agg(F.max(F.struct("created_at", "id")).alias("m"), F.sum("seen").alias("seen")).select("url", "m.id", "m.created_at", "seen")

    return S.store_stream(pages, merge, "pages").select("url", "id", "seen")


QUERIES, SQL = query.queries, query.sql
