"""Queries of the general data-quality problems (3 and 7) over the project's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harrowmill.functions import datetimes as D
from harrowmill.operators import messages, timestamps
from harrowmill.sources.tables import table


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timestamps.found_instants(
        table(spark, sf_dir, "contents"), table(spark, sf_dir, "raw_contents"), table(spark, sf_dir, "sources")
    )


def p3_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many timestamps of each table were read in which way."""
    rows = timestamps.content_clock(table(spark, sf_dir, "contents"), table(spark, sf_dir, "sources")).unionByName(
        timestamps.raw_clock(table(spark, sf_dir, "raw_contents"))
    )
    return timestamps.normalize_timestamps(rows).groupBy("record_table", "status").agg(F.count("*").alias("n"))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages.redundant_deliveries(table(spark, sf_dir, "content_refs"))


def p7_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages.unique_deliveries(table(spark, sf_dir, "content_refs")).select("delivery_id", "topic", "batch_id")


def p7_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of the later half of the batches that the earlier half has not stored."""
    refs = table(spark, sf_dir, "content_refs")
    late = F.substring("batch_id", -1, 1).cast("int") >= 5
    stored = messages.first_deliveries(refs.filter(~late))
    return messages.new_messages(refs.filter(late), stored).select("topic", "message", "delivery_id", "copies")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "p3_found": p3_found,
    "p3_status": p3_status,
    "p7_found": p7_found,
    "p7_unique": p7_unique,
    "p7_incremental": p7_incremental,
}

_URL = r"""
  case when url = '' then url
       when regexp_matches(url, '[\x00-\x1f\x7f]') then url
       when not regexp_matches(url, '^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]+') then url
       else concat(
         case when lower(regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.\-]*)://', 1)) = 'http' then 'https'
              else lower(regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.\-]*)://', 1)) end,
         '://', lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)', 1)),
         case when length(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)', 1)) > 1
              then regexp_replace(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)', 1), '/+$', '')
              else regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)', 1) end) end
"""
#: Deliveries with their message identifier; {where} restricts the batch.
_MESSAGES = """
  base_{n} as (select topic, delivery_id, delivered_at, batch_id, nullif(id, '') as mid, {url} as nurl from content_refs where {where}),
  named_{n} as (select topic, nurl, arg_min(mid, (delivered_at, delivery_id)) as found from base_{n}
            where mid is not null group by all),
  msg_{n} as (select b.topic, b.delivery_id, b.delivered_at, b.batch_id,
                 coalesce('i:' || b.mid, 'i:' || n.found, 'u:' || b.nurl) as message
          from base_{n} b left join named_{n} n on b.mid is null and n.topic = b.topic and n.nurl = b.nurl),
  ranked_{n} as (select *, row_number() over (partition by topic, message order by delivered_at, delivery_id) as rn,
                    count(*) over (partition by topic, message) as copies from msg_{n})
"""


def _ranked(n: str, where: str = "true") -> str:
    return _MESSAGES.format(n=n, url=_URL, where=where)


def _map(pairs: dict) -> str:
    return "map {" + ", ".join(f"'{k}': {v}" for k, v in pairs.items()) + "}"


def _months() -> dict[str, int]:
    out: dict[str, int] = {}
    for names in D.MONTHS.values():
        for i, name in enumerate(names, 1):
            for short in {name, name[:3]}:
                out.setdefault(short, i)
    return {**out, "sept": 9}


def _captured(name: str) -> str:
    """The text of one part under the first notation that fits."""
    cases = []
    for k, (_, pattern, groups) in enumerate(D.NOTATIONS):
        at = [i for i, g in enumerate(groups.split(), 1) if g == name]
        text = " || ".join(f"regexp_extract(t, '{pattern}', {i})" for i in at) or "''"
        cases.append(f"when {k} then {text}")
    return f"nullif(case fit {' '.join(cases)} end, '')"


_FITS = "case " + " ".join(f"when regexp_matches(t, '{pattern}') then {k}" for k, (_, pattern, _) in enumerate(D.NOTATIONS)) + " end"
_BLANKS = r"[\s\x{00a0}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{0085}\x{1680}]+"
#: Instants worked out apart from the operator: the offsets in force a day before and after are tried on the wall clock,
#: and those that give it back are its instants.
_P3 = rf"""
  src as (select source_id as sid, timezone as tz, country as cc from sources),
  given as (select 'contents' as record_table, id as record_id, published_at as txt, tz, coalesce(cc, country) as cc from contents left join src on sid = source_id
            union all select 'raw_contents', id, fetched_at, json_extract_string(metadata, '$.node_tz'), source.country from raw_contents),
  fitted as (select *, {_FITS} as fit from (select *, regexp_replace(txt, '^{_BLANKS}|{_BLANKS}$', '', 'g') as t from given)),
  parts as (select *, {", ".join(f"{_captured(n)} as p_{'mon' if n == 'M' else n}" for n in D.PARTS)} from fitted),
  nums as (select *, coalesce(p_m::int, {_map(_months())}[lower(p_mon)], case when cc = 'US' then p_a::int else p_b::int end) as mo, coalesce(p_d::int, case when cc = 'US' then p_b::int else p_a::int end) as da,
             coalesce(p_h::int, 0) as h0, coalesce(p_i::int, 0) as mi, coalesce(p_s::int, 0) as se, rpad(coalesce(p_f, ''), 3, '0')[1:3]::int as ms, lower(p_p) as half from parts),
  clocks as (select *, case when half is null then h0 when h0 > 12 then 99 else h0 % 12 + case when starts_with(half, 'p') or half = '오후' then 12 else 0 end end as ho,
             try_cast(p_y || '-' || lpad(mo::varchar, 2, '0') || '-' || lpad(da::varchar, 2, '0') as date) as dt from nums),
  walls as (select *, case when ho between 0 and 23 and mi < 60 and se < 60 and p_y::int between 1900 and 2100 then dt + to_hours(ho) + to_minutes(mi) + to_seconds(se) end as wall,
             case when regexp_matches(p_z, '^[+-]') then case when p_z[1] = '-' then -1 else 1 end * (replace(p_z[2:], ':', '')[1:2]::int * 60 + coalesce(nullif(replace(p_z[2:], ':', '')[3:4], '')::int, 0))
                  else {_map(D.ZONE_ABBREVIATIONS)}[upper(p_z)] end as off,
             case length(p_n) when 10 then p_n::bigint * 1000 else p_n[1:13]::bigint end as num from clocks),
  direct as (select *, coalesce(num, epoch_ms(wall) + ms - off * 60000) as sure, case when num is null and p_z is null then wall end as free from walls),
  tried as (select *, [x for x in list_distinct([free - (timezone(tz, timezone('UTC', free + d)) - (free + d)) for d in [interval '-1 day', interval '1 day']])
                       if timezone(tz, timezone('UTC', x)) = free] as opts from direct where free is not null and tz is not null
            union all select *, null from direct where free is null or tz is null),
  p3 as (select record_table, record_id, txt, coalesce(sure, epoch_ms(list_min(opts)) + ms) as epoch_ms,
           case when regexp_matches(coalesce(txt, ''), '^{_BLANKS}$') or coalesce(txt, '') = '' then 'absent' when sure is not null then 'direct' when free is null then 'unreadable' when tz is null then 'no_zone'
                when len(opts) = 0 then 'nonexistent' when len(opts) = 1 then 'exact' else 'ambiguous' end as status from tried)"""

SQL: dict[str, str] = {
    "p3_found": f"with {_P3} select record_table, record_id, epoch_ms from p3 where epoch_ms is not null and not regexp_matches(txt, '^\\d{{4}}-\\d{{2}}-\\d{{2}}T\\d{{2}}:\\d{{2}}:\\d{{2}}Z$')",
    "p3_status": f"with {_P3} select record_table, status, count(*) as n from p3 group by all",
    "p7_found": f"with {_ranked('a')} select delivery_id from ranked_a where rn > 1",
    "p7_unique": f"with {_ranked('a')} select delivery_id, topic, batch_id from ranked_a where rn = 1",
    "p7_incremental": f"with {_ranked('a', 'right(batch_id, 1)::int < 5')}, {_ranked('b', 'right(batch_id, 1)::int >= 5')}, "
    "first_ids as (select topic, nurl, arg_min(mid, (delivered_at, delivery_id)) as found from (select * from base_a union all select * from base_b) where mid is not null group by all), "
    "late as (select b.topic, b.delivery_id, b.delivered_at, coalesce('i:' || b.mid, 'i:' || f.found, 'u:' || b.nurl) as message from base_b b left join first_ids f on b.mid is null and f.topic = b.topic and f.nurl = b.nurl), "
    "claimed as (select topic, 'i:' || arg_min(mid, (delivered_at, delivery_id)) as message from base_b b where mid is not null and exists (select 1 from ranked_a a where a.topic = b.topic and a.message = 'u:' || b.nurl) "
    "and not exists (select 1 from base_a a where a.topic = b.topic and a.nurl = b.nurl and a.mid is not null) group by topic, nurl), "
    "old as (select topic, message from ranked_a union select topic, message from claimed) "
    "select topic, message, arg_min(delivery_id, (delivered_at, delivery_id)) as delivery_id, count(*)::bigint as copies from late l where not exists (select 1 from old o where o.topic = l.topic and o.message = l.message) group by all",
}
