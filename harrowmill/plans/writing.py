"""Queries over validation, storage, queues, windows and state machines."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from harrowmill.functions import urls as U
from harrowmill.functions.datetimes import ntz_micros
from harrowmill.operators import folds, publish as Pb, queueing as Q, store as St, validate as V, windows as Wn
from harrowmill.plans import fixtures as X
from harrowmill.plans.general import _URL
from harrowmill.plans.reading import _HOST
from harrowmill.plans.registry import Registry
from harrowmill.sources.tables import table

query = Registry()

# --- validation --------------------------------------------------------------------------------------------------

_T = "coalesce(title, '') || ' ' || coalesce(body, '')"
_COUNT = "(length({t}) - length(regexp_replace({t}, '{p}', '', 'g')))::double / length({t})"
_WC = "coalesce(word_count, 0)::double"
#: Share of the characters of a text that stand in runs of four or more equal ones, per id.
_FLOOD = """ch as (select id, unnest(string_split(body, '')) as c, unnest(range(length(body))) as i from contents where body <> ''),
 runs as (select id, c, count(*) as n from (select *, i - row_number() over (partition by id, c order by i) as g from ch) group by id, c, g having count(*) >= 4),
 floods as (select t.id, coalesce(any_value(r.n), 0)::double / any_value(length(body)) as flood from contents t left join (select id, sum(n) as n from runs group by id) r using (id) where body <> '' group by t.id)"""
_VALID = rf"""{_FLOOD}, scored as (select *,
  case when source_type = 'community' then ((case when length(coalesce(body, '')) < 50 then 0.0::double when length(coalesce(body, '')) >= 200 then 1.0::double else length(coalesce(body, '')) / 200.0::double end) * 0.6::double
      + ((case when coalesce(title, '') <> '' then 0.4::double else 0 end) + (case when published_s is not null then 0.3::double else 0 end) + (case when trim(coalesce(url, '')) <> '' then 0.3::double else 0 end)) * 0.4::double)::float
    else ((case when {_WC} <= 0 then 0.5::double when {_WC} >= 200 then 1.0::double when {_WC} < 50 then {_WC} / 50 * 0.5::double else 0.5::double + ({_WC} - 50) / 150 * 0.5::double end) * 0.4::double
      + ((case when coalesce(author, '') <> '' then 0.4::double else 0 end) + (case when coalesce(category, '') <> '' then 0.3::double else 0 end) + (case when len(coalesce(tags, [])) > 0 then 0.3::double else 0 end)) * 0.3::double
      + ((case when coalesce(url, '') <> '' then 0.3::double else 0 end) + (case when coalesce(summary, '') <> '' then 0.3::double else 0 end) + (case when contains(coalesce(body, ''), chr(10)) then 0.4::double else 0 end)) * 0.3::double)::float end as quality,
  {_COUNT.format(t='(' + _T + ')', p='[^\\p{Lu}]')} as not_caps,
  1 - {_COUNT.format(t='(' + _T + ')', p='[\\p{P}\\p{S}]')} as not_punct from content_rows left join floods using (id)),
 judged as (select *, list_filter([
   case when source_type <> 'community' and length(coalesce(title, '')) < 10 then 'min_length' when source_type <> 'community' and length(coalesce(title, '')) > 500 then 'max_length' end,
   case when source_type <> 'community' and length(coalesce(body, '')) < 100 then 'min_length' when source_type <> 'community' and length(coalesce(body, '')) > 50000 then 'max_length' end,
   case when source_type <> 'community' and article and published_s is null then 'required' end,
   case when source_type <> 'community' and 1 - not_caps > 0.20 then 'spam_caps' end,
   case when source_type <> 'community' and 1 - not_punct > 0.10 then 'spam_punct' end,
   case when source_type = 'community' and length(coalesce(body, '')) < 50 then 'min_length' end,
   case when source_type = 'community' and flood > 0.30 then 'spam_flood' end], lambda x: x is not null) as found from scored),
 verdicts as (select *, case when len(found) = 0 and quality < (case when source_type = 'community' then 0.4::float else 0.5::float end) then ['quality_low'] else found end as rules from judged),
 coded as (select *, len(rules) = 0 as valid, case rules[1] when 'min_length' then 'VAL_003' when 'max_length' then 'VAL_004' when 'required' then 'VAL_001' when 'spam_caps' then 'VAL_006' when 'spam_punct' then 'VAL_006' when 'spam_flood' then 'VAL_006' when 'quality_low' then 'VAL_005' end as code from verdicts)"""
_CODED = f"with {X.CONTENTS}, {_VALID}"


def _validated(spark, d):
    return V.validated(X.contents(spark, d))


@query("validate_news", f"{_CODED} select id, round(quality::double, 4) as quality, array_to_string(rules, ',') as rules from coded where source_type <> 'community'")
def validate_news(spark, d):
    v = _validated(spark, d).filter("source_type <> 'community'")
    return v.select("id", F.round(F.col("quality").cast("double"), 4).alias("quality"), F.array_join(F.transform("errors", lambda e: e["rule"]), ",").alias("rules"))


@query("validate_community", f"{_CODED} select id, round(quality::double, 4) as quality, array_to_string(rules, ',') as rules from coded where source_type = 'community'")
def validate_community(spark, d):
    v = _validated(spark, d).filter("source_type = 'community'")
    return v.select("id", F.round(F.col("quality").cast("double"), 4).alias("quality"), F.array_join(F.transform("errors", lambda e: e["rule"]), ",").alias("rules"))


@query("validate_codes", f"{_CODED} select source_type, valid, code, count(*) as n from coded group by all")
def validate_codes(spark, d):
    return _validated(spark, d).groupBy("source_type", "valid", "code").agg(F.count("*").alias("n"))


@query("quality_histogram", f"{_CODED} select source_id, floor(quality::double * 10)::bigint as bin, count(*) as n from coded group by all")
def quality_histogram(spark, d):
    return _validated(spark, d).groupBy("source_id", F.floor(F.col("quality").cast("double") * 10).alias("bin")).agg(F.count("*").alias("n"))


@query("article_date_required", f"with {X.CONTENTS} select id from content_rows where source_type <> 'community' and article and published_s is null")
def article_date_required(spark, d):
    v = V.validated(X.contents(spark, d).filter("source_type <> 'community'"), F.coalesce("article", F.lit(False)))
    return v.filter(F.exists("errors", lambda e: e["rule"] == "required")).select("id")


@query("flood_runs", f"with {_FLOOD} select id, round(flood, 6) as share from floods")
def flood_runs(spark, d):
    """Share of the characters of each body that stand in runs of four or more equal ones."""
    t = table(spark, d, "contents").filter("body <> ''")
    return t.select("id", F.round(V.repeat_share(F.col("body")), 6).alias("share"))


_ROUTED = f"""{_CODED}, routed as (select *, case when try_cast(substr(id, 1, 1) as int) > 0 then try_cast(substr(id, 1, 1) as int) else 0 end as reparses, coalesce(word_count, 0) % 5 as retries from coded)"""


def _routed(spark, d):
    """Counters as a message carries them: the reparse count in a header (text, sometimes no number), the retries beside it."""
    v = _validated(spark, d).withColumn("headers", F.create_map(F.lit("reparse_count"), F.substring("id", 1, 1)))
    return v.withColumns({"reparses": V.header_count(F.col("headers"), "reparse_count"), "retries": F.coalesce("word_count", F.lit(0)) % 5})


@query("validate_route", f"{_ROUTED} select id, case when valid then 'validated' when code in ('VAL_001', 'VAL_003') and reparses < 2 then 'reparse' when retries < 3 then 'requeue' else 'dead' end as route from routed")
def validate_route(spark, d):
    route = V.validation_route(F.col("valid"), F.col("code"), F.col("reparses"), F.col("retries"))
    return _routed(spark, d).select("id", route.alias("route"))


@query("reparse_gate", f"{_ROUTED} select id, reparses::int as reparses, coalesce(code in ('VAL_001', 'VAL_003') and reparses < 2, false) as eligible from routed")
def reparse_gate(spark, d):
    r = _routed(spark, d)
    return r.select("id", "reparses", V.may_reparse(F.col("code"), F.col("reparses")).alias("eligible"))


@query("validation_status", f"{_CODED} select id, case when valid then 'passed' else 'rejected' end as validation_status, case when not valid then code end as reject_code, case when not valid then rules[1] end as reject_rule from coded")
def validation_status(spark, d):
    v = V.with_status(_validated(spark, d))
    return v.select("id", "validation_status", "reject_code", F.substring_index("reject_detail", ": ", -1).alias("reject_rule"))


# --- storage -----------------------------------------------------------------------------------------------------


@query("content_ids", "select id, substr(sha256(url), 1, 32) as new_id, sha256(coalesce(body, '')) as new_hash, len(list_filter(regexp_split_to_array(coalesce(body, ''), '[\\s\\x{00a0}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}\\x{0085}\\x{1680}]+'), lambda x: x <> ''))::int as words from contents")
def content_ids(spark, d):
    body = F.coalesce("body", F.lit(""))
    return table(spark, d, "contents").select("id", St.content_id(F.col("url")).alias("new_id"), St.content_hash(body).alias("new_hash"), St.word_count(body).alias("words"))


_HALF = "(ascii(right(id, 1)) % 2 = 0)"


@query("dedup_by_hash", f"with s as (select content_hash, min(id) as sid from contents where {_HALF} and content_hash <> '' group by 1), b as (select id, content_hash, created_at from contents where not {_HALF} and content_hash <> ''), "
       "f as (select content_hash, arg_min(id, (created_at, id)) as fid from b group by 1) select b.id, coalesce(sid, fid) as kept_id, b.id <> coalesce(sid, fid) as duplicate from b join f using (content_hash) left join s using (content_hash)")
def dedup_by_hash(spark, d):
    c = table(spark, d, "contents").filter("content_hash <> ''").select("id", "content_hash", F.col("created_at").alias("arrival"))
    half = F.ascii(F.substring("id", -1, 1)) % 2 == 0
    return St.dedup_by_hash(c.filter(~half), c.filter(half))


@query("raw_store", f"with s as (select id, url from raw_contents where {_HALF}), b as (select url, min(id) as id from raw_contents where not {_HALF} and url not in (select url from s) group by 1) select id, url from s union all select id, url from b")
def raw_store(spark, d):
    r = table(spark, d, "raw_contents").select("id", "url")
    half = F.ascii(F.substring("id", -1, 1)) % 2 == 0
    return St.store_raw(r.filter(~half), r.filter(half))


@query("content_upsert", f"with s as (select * from contents where {_HALF}), n as (select *, sha256(coalesce(body, '') || '#') as h from contents where word_count % 3 = 0 or not {_HALF}), "
       "j as (select coalesce(s.url, n.url) as url, coalesce(s.id, n.id) as id, s.id is not null as have, n.id is not null as inc, s.title as st, n.title || '!' as nt, s.body as sb, n.body as nb, s.content_hash as sh, n.h as nh from s full join n on s.url = n.url) "
       "select url, id, case when not have then nt when inc and sh is distinct from nh then nt else st end as title, case when inc then nh else sh end as content_hash, length(case when inc then nb else sb end)::int as n_chars from j")
def content_upsert(spark, d):
    c = table(spark, d, "contents").select("url", "id", "title", "body", "content_hash", "word_count")
    half = F.ascii(F.substring("id", -1, 1)) % 2 == 0
    new = c.filter((F.col("word_count") % 3 == 0) | ~half)
    new = new.withColumns({"content_hash": F.sha2(F.concat(F.coalesce("body", F.lit("")), F.lit("#")), 256), "title": F.concat("title", F.lit("!"))})
    return St.upsert_contents(c.filter(half), new).select("url", "id", "title", "content_hash", F.length("body").alias("n_chars"))


@query("enriched_upsert", "select content_id, arg_max(claim_id, (claim_idx, claim_id)) as claim_id, arg_max(coalesce(predicate, '{}'), (claim_idx, claim_id)) as facts from claims group by 1")
def enriched_upsert(spark, d):
    c = table(spark, d, "claims").select("content_id", "claim_idx", "claim_id", F.coalesce("predicate", F.lit("{}")).alias("facts"))
    return St.latest_per_key(c, ["content_id"], "claim_idx", "claim_id").select("content_id", "claim_id", "facts")


@query("raw_retention", "select count(*) filter (created_at >= cutoff) as kept, count(*) filter (created_at < cutoff) as dropped from raw_contents, (select max(created_at) - interval 90 day as cutoff from raw_contents)")
def raw_retention(spark, d):
    r = table(spark, d, "raw_contents").select("created_at")
    last = F.broadcast(r.agg((F.max("created_at") - F.expr("interval 90 days")).alias("cutoff")))  # one row
    kept = F.col("created_at") >= F.col("cutoff")
    return r.join(last).agg(F.count_if(kept).alias("kept"), F.count_if(~kept).alias("dropped"))


@query("delete_by_id", "select count(*) as n from entities e where not exists (select 1 from contents c where c.id = e.content_id and c.word_count = 0)")
def delete_by_id(spark, d):
    gone = table(spark, d, "contents").filter("word_count = 0").select(F.col("id").alias("content_id"))
    return table(spark, d, "entities").join(gone, "content_id", "left_anti").agg(F.count("*").alias("n"))


@query("exists_by_url", "select count(*) as n from raw_contents r where exists (select 1 from contents c where c.url = r.url)")
def exists_by_url(spark, d):
    return table(spark, d, "raw_contents").join(table(spark, d, "contents").select("url"), "url", "left_semi").agg(F.count("*").alias("n"))


@query("dlq_split", "select id, status_code, map_extract_value(map_from_entries([('original-topic', 'fetched'), ('error', 'HTTP ' || status_code)]), 'error') as error, len(map_keys(headers))::int + 2 as n_headers from raw_contents where status_code >= 400")
def dlq_split(spark, d):
    r = table(spark, d, "raw_contents").select("id", "status_code", "headers", F.lit("fetched").alias("topic"))
    _, dead = St.dead_letters(r, F.when(F.col("status_code") >= 400, F.concat(F.lit("HTTP "), F.col("status_code").cast("string"))))
    return dead.select("id", "status_code", F.col("headers")["error"].alias("error"), F.size("headers").alias("n_headers"))


@query("count_by_country", "select k.country, coalesce(n, 0)::bigint as n from (values ('US'), ('KR'), ('JP')) k(country) left join (select country, count(*) as n from contents, (select max(created_at) - interval 365 day as cut from contents) where created_at >= cut group by 1) c using (country)")
def count_by_country(spark, d):
    c = table(spark, d, "contents").select("country", "created_at")
    last = F.broadcast(c.agg((F.max("created_at") - F.expr("interval 365 days")).alias("cutoff")))  # one row
    n = c.join(last, F.col("created_at") >= F.col("cutoff")).groupBy("country").agg(F.count("*").alias("n"))
    return spark.createDataFrame([("US",), ("KR",), ("JP",)], "country string").join(n, "country", "left").select("country", F.coalesce("n", F.lit(0)).alias("n"))


_SEEN = f"seen as (select source_id, country, language, source_type, {_HOST} as host from contents where url is not null)"


@query("source_analysis", f"with {_SEEN}, b as (select source_id, lower(regexp_extract(base_url, '^[a-z]+://([^/]*)', 1)) as base_host, coalesce(requests_per_hour, 0) as rph, type from sources), "
       "g as (select s.source_id, count(distinct s.country) as nc, count(distinct s.language) as nl, count(distinct s.source_type) as nt, min(host) filter (host = base_host) as exact, min(host) as low, count(distinct host) as hosts, string_agg(distinct host, ',' order by host) as all_hosts, any_value(rph) as rph from seen s join b using (source_id) group by 1) "
       "select source_id, coalesce(exact, low) as host, hosts, all_hosts, case when nc > 1 then 'country' when nl > 1 then 'language' when nt > 1 then 'type' end as mismatch, rph::int as requests_per_hour from g")
def source_analysis(spark, d):
    """Hosts of each source, its canonical one (that of its base url, else the first), and the first field its records disagree in."""
    b = table(spark, d, "sources").select("source_id", U.url_hostname(F.col("base_url")).alias("base_host"), F.coalesce("requests_per_hour", F.lit(0)).alias("rph"))
    c = table(spark, d, "contents").filter("url is not null").select("source_id", "country", "language", "source_type", U.url_hostname(F.col("url")).alias("host"))
    return St.analyze_sources(c.join(b, "source_id"))


@query("sample_cap", "select source_id, least(count(distinct url), 100) as kept from contents group by 1")
def sample_cap(spark, d):
    c = table(spark, d, "contents").select("source_id", "url", "created_at")
    return Wn.recent(c, ["source_id"], "url", "created_at", 100).groupBy("source_id").agg(F.count("*").alias("kept"))


# --- queues ------------------------------------------------------------------------------------------------------

_JOBS = "jobs as (select o_orderkey as id, try_cast(left(o_orderpriority, 1) as int) as p, epoch_ms(o_orderdate) as ms from orders)"
_P = "case when p between 1 and 3 then p else 2 end"


def _jobs(spark, d):
    o = table(spark, d, "orders")
    ms = F.floor(ntz_micros("o_orderdate") / 1000)
    return o.select(F.col("o_orderkey").alias("id"), F.substring("o_orderpriority", 1, 1).alias("priority"), ms.alias("arrival_ms"))


@query("priority_pop", f"with {_JOBS} select id, ({_P})::bigint * 10000000000000 + ms as score from jobs order by score, id limit 100")
def priority_pop(spark, d):
    return Q.push_capped(_jobs(spark, d), 100)


@query("priority_classes", f"with {_JOBS} select ({_P})::int as priority, count(*) as n, min(ms) as first_ms from jobs group by 1")
def priority_classes(spark, d):
    return _jobs(spark, d).groupBy(Q.priority_of(F.col("priority")).alias("priority")).agg(F.count("*").alias("n"), F.min("arrival_ms").alias("first_ms"))


@query("fifo_drain", f"with {_JOBS}, n as (select *, row_number() over (partition by p order by ms desc, id desc) as nr from jobs), k as (select *, row_number() over (partition by p order by ms, id) as rank from n where nr <= 500) select p::varchar as label, id, rank from k where rank <= 20")
def fifo_drain(spark, d):
    j = _jobs(spark, d).select(F.col("priority").alias("label"), "id", F.col("arrival_ms").alias("arrival"))
    return Q.drain_fifo(j, ["label"], 500, 20).select("label", "id", "rank")


@query("drain_quota", f"with {_JOBS} select p::varchar as label, greatest(least(3000 - count(*), 100, count(*)), 0) as n from jobs group by 1")
def drain_quota(spark, d):
    j = _jobs(spark, d).groupBy(F.col("priority").alias("label")).agg(F.count("*").alias("len"))
    return j.select("label", Q.drain_quota(F.lit(3000), F.col("len"), F.lit(100), F.col("len")).alias("n"))


@query("retry_due", f"with {_JOBS} select id, ms, p::varchar as priority from (select * from jobs where p = 1 and ms <= (select (min(ms) + max(ms)) // 2 from jobs) order by ms, id limit 50) where id % 7 <> 0")
def retry_due(spark, d):
    j = _jobs(spark, d)
    now = j.agg(F.floor((F.min("arrival_ms") + F.max("arrival_ms")) / 2).alias("now_ms"))
    schedule = j.filter("priority = '1'").select("id", F.col("arrival_ms").alias("due_ms"))
    due, _ = Q.due_retries(schedule, j.filter("id % 7 <> 0").select("id", "priority"), now, 50)
    return due.select("id", F.col("due_ms").alias("ms"), "priority")


@query("retry_orphans", f"with {_JOBS} select id from (select id from jobs where p = 1 and ms <= (select (min(ms) + max(ms)) // 2 from jobs) order by ms, id limit 50) where id % 7 = 0")
def retry_orphans(spark, d):
    """Scheduled ids whose entry is gone are taken off the schedule."""
    j = _jobs(spark, d)
    now = j.agg(F.floor((F.min("arrival_ms") + F.max("arrival_ms")) / 2).alias("now_ms"))
    schedule = j.filter("priority = '1'").select("id", F.col("arrival_ms").alias("due_ms"))
    return Q.due_retries(schedule, j.filter("id % 7 <> 0").select("id", "priority"), now, 50)[1]


@query("retry_backoff", "select l_orderkey, l_linenumber, least(5.0::double * pow(2, l_linenumber - 1), 300) as wait_s, l_linenumber >= 3 as dead from lineitem where l_returnflag = 'R'")
def retry_backoff(spark, d):
    n = F.col("l_linenumber")
    return table(spark, d, "lineitem").filter("l_returnflag = 'R'").select("l_orderkey", n, Q.backoff_seconds(n, 5.0, 2.0, 300.0).alias("wait_s"), (n >= 3).alias("dead"))


_OFFSETS = "lat as (select topic, partition_no, max(offset_no) as latest from content_refs group by topic, partition_no), com as (select topic, partition_no, case when partition_no = 3 then -1 else max(offset_no) - partition_no * 7 end as committed from content_refs where partition_no <> 5 group by topic, partition_no)"


def _offsets(spark, d):
    r = table(spark, d, "content_refs").groupBy("topic", "partition_no").agg(F.max("offset_no").alias("latest"))
    com = r.filter("partition_no <> 5").select("topic", "partition_no", F.when(F.col("partition_no") == 3, -1).otherwise(F.col("latest") - F.col("partition_no") * 7).alias("committed"))
    return r, com


@query("backlog_total", f"with {_OFFSETS} select topic, sum(greatest(latest - committed, 0))::bigint as backlog from lat join com using (topic, partition_no) where committed >= 0 group by 1")
def backlog_total(spark, d):
    return Q.backlog(*_offsets(spark, d), ["topic"])


@query("throttle", f"with {_OFFSETS}, b as (select topic, sum(greatest(latest - committed, 0)) as backlog from lat join com using (topic, partition_no) where committed >= 0 group by 1) select topic, m as most, m > 0 and backlog > m as throttled from b, (values (0), (100), (150), (1000)) t(m)")
def throttle(spark, d):
    b = Q.backlog(*_offsets(spark, d), ["topic"]).withColumn("most", F.explode(F.array(*[F.lit(x) for x in (0, 100, 150, 1000)])))
    return b.select("topic", "most", Q.throttled(F.col("backlog"), F.col("most")).alias("throttled"))


@query("schedule_diff", "with a as (select source_id, base_url, coalesce(requests_per_hour, 60) as v from sources where country <> 'AU'), b as (select source_id, base_url, case when country = 'KR' then 10 else coalesce(requests_per_hour, 60) end as v from sources where country <> 'FR') "
       "select coalesce(a.source_id, b.source_id) as source_id, case when a.source_id is null then 'added' when b.source_id is null then 'removed' when a.v <> b.v then 'changed' else 'same' end as change from a full join b on a.source_id = b.source_id and a.base_url = b.base_url")
def schedule_diff(spark, d):
    s = table(spark, d, "sources").select("source_id", "base_url", "country", F.coalesce("requests_per_hour", F.lit(60)).alias("v"))
    new = s.filter("country <> 'FR'").withColumn("v", F.when(F.col("country") == "KR", 10).otherwise(F.col("v")))
    return Q.schedule_diff(s.filter("country <> 'AU'"), new, ["source_id", "base_url"], ["v"]).select("source_id", "change")


@query("schedule_ticks", "select source_id, unnest(range(1704067200, 1704067200 + 7201, case when type = 'community' then 600 else 1800 end))::bigint as tick_s from sources")
def schedule_ticks(spark, d):
    s = table(spark, d, "sources").select("source_id", F.when(F.col("type") == "community", 600).otherwise(1800).alias("interval_s"))
    return Q.schedule_ticks(s, 1704067200, 1704067200 + 7200).select("source_id", "tick_s")


@query("keyword_pages", "with hits as (select country as k, url, row_number() over (partition by country order by created_at, url) as n from contents where country is not null), paged as (select k, url, (n - 1) // 10 * 10 + 1 as start from hits where n <= 100) "
       "select k, start::int as start, count(distinct url) as n from paged group by all")
def keyword_pages(spark, d):
    """Search results read ten at a time up to a hundred: the page plan joined to ranked hits, each url once."""
    c = table(spark, d, "contents").filter("country is not null").select(F.col("country").alias("k"), "url", "created_at")
    best = Q.first_of(c, ["k"], 100, "created_at", "url")
    plan = best.groupBy("k").agg(F.count("*").alias("n")).select("k", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"), F.lit(10))).alias("start"))
    page = best.withColumn("start", (F.floor((F.col("rank") - 1) / 10) * 10 + 1).cast("int"))
    return plan.join(page, ["k", "start"]).groupBy("k", "start").agg(F.count_distinct("url").alias("n"))


@query("keyword_hosts", f"select {_HOST} as host, count(distinct url) as n from contents where title ilike '%budget%' or title ilike '%harbor%' or title ilike '%tram%' group by 1")
def keyword_hosts(spark, d):
    t = F.col("title")
    c = table(spark, d, "contents").filter(t.ilike("%budget%") | t.ilike("%harbor%") | t.ilike("%tram%"))
    return c.select(U.url_hostname(F.col("url")).alias("host"), "url").groupBy("host").agg(F.count_distinct("url").alias("n"))


@query("buffer_split", f"with {_JOBS} select case when {_P} = 1 then 'direct' else 'buffer' end as lane, case {_P} when 1 then 'high' when 2 then 'normal' else 'low' end as label, count(*) as n from jobs group by all")
def buffer_split(spark, d):
    p = Q.priority_of(F.col("priority"))
    label = F.when(p == 1, "high").when(p == 2, "normal").otherwise("low")
    return _jobs(spark, d).groupBy(F.when(p == 1, "direct").otherwise("buffer").alias("lane"), label.alias("label")).agg(F.count("*").alias("n"))


@query("error_counter", "select event_type, count(*) as n from events where event_type in ('error', 'signup') group by 1 order by n desc, event_type")
def error_counter(spark, d):
    e = table(spark, d, "events").filter(F.col("event_type").isin("error", "signup"))
    return e.groupBy("event_type").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "event_type")


_CHAIN_URL = _URL
_REQUESTS = f"""req as (select delivery_id as id, {_CHAIN_URL} as url, case when topic = 'normalized' then 'category' else 'article' end as target_type, epoch_us(delivered_at) as ts_us from content_refs),
  open as (select *, case target_type when 'category' then 60000000 else 86400000000 end as ttl, row_number() over (partition by url order by ts_us, id) as rn from req where url <> '' and lower(url) not like '%/sports/%')"""
_LET_IN = """let_in as (select url, rn, id, ts_us, ts_us + ttl as until_us, true as accepted, target_type from open where rn = 1
  union all select o.url, o.rn, o.id, o.ts_us, case when o.ts_us >= l.until_us then o.ts_us + o.ttl else l.until_us end, o.ts_us >= l.until_us, o.target_type from let_in l join open o on o.url = l.url and o.rn = l.rn + 1)"""


def _requests(spark, d):
    r = table(spark, d, "content_refs")
    kind = F.when(F.col("topic") == "normalized", "category").otherwise("article")
    priority = F.when(kind == "category", 1).otherwise(2)
    return r.select(F.col("delivery_id").alias("id"), F.lit("feed").alias("crawler"), "url", kind.alias("target_type"), priority.alias("priority"), ntz_micros("delivered_at").alias("ts_us"))


@query("publish_chain", f"with recursive {_REQUESTS}, {_LET_IN} select url, ts_us, target_type, case target_type when 'category' then 'crawl.high' else 'crawl.normal' end as topic, sha256('ingestion:url:' || sha256(url)) as key, "
       "substr(sha256('feed' || chr(1) || url || chr(1) || ts_us), 1, 32) as job_id from let_in where accepted")
def publish_chain(spark, d):
    """Normalise, guard, once per TTL by target type, jobs with topic, key and a replayable id."""
    return Pb.publish_jobs(_requests(spark, d), ["/sports/"]).select("url", "ts_us", "target_type", "topic", "key", "job_id")


@query("seed_publish", "with recursive t as (select source_id, base_url as url, type, unnest(range(1704067200, 1704067200 + 90001, case when type = 'community' then 600 else 1800 end))::bigint * 1000000 as ts_us from sources where requests_per_hour is not null), "
       "open as (select *, case type when 'community' then 60000000 else 86400000000 end as ttl, row_number() over (partition by url order by ts_us) as rn from t), "
       "let_in as (select url, rn, source_id, ts_us, ts_us + ttl as until_us, true as accepted from open where rn = 1 union all select o.url, o.rn, o.source_id, o.ts_us, case when o.ts_us >= l.until_us then o.ts_us + o.ttl else l.until_us end, o.ts_us >= l.until_us from let_in l join open o on o.url = l.url and o.rn = l.rn + 1) "
       "select source_id, count(*) as published from let_in where accepted group by 1")
def seed_publish(spark, d):
    """Ticks of a day and an hour through the chain: category seeds pass each time, article seeds once a day; the rest is skipped."""
    s = table(spark, d, "sources").filter("requests_per_hour is not null").withColumn("interval_s", F.when(F.col("type") == "community", 600).otherwise(1800))
    ticks = Q.schedule_ticks(s, 1704067200, 1704067200 + 90000)
    kind = F.when(F.col("type") == "community", "category").otherwise("article")
    req = ticks.select(F.col("tick_s").alias("id"), F.col("source_id").alias("crawler"), F.col("base_url").alias("url"), kind.alias("target_type"), F.lit(2).alias("priority"), (F.col("tick_s") * 1_000_000).alias("ts_us"))
    return Pb.publish_jobs(req).groupBy(F.col("crawler").alias("source_id")).agg(F.count("*").alias("published"))


# --- windows and state -------------------------------------------------------------------------------------------

_EV = "ev as (select event_id as id, user_id as host, epoch_us(ts) as ts_us, event_type, value from events)"
_HOUR = 3_600_000_000


def _events(spark, d):
    e = table(spark, d, "events")
    return e.select(F.col("event_id").alias("id"), F.col("user_id").alias("host"), ntz_micros("ts").alias("ts_us"), "event_type", "value")


@query("failure_window", f"with {_EV}, w as (select id, host, ts_us, count(*) over (partition by host order by ts_us range between {48 * _HOUR - 1} preceding and current row) as cnt from ev where event_type = 'error') select id, cnt from w where cnt >= 2")
def failure_window(spark, d):
    e = _events(spark, d).filter("event_type = 'error'")
    return Wn.sliding_count(e, ["host"], 48 * _HOUR).filter("cnt >= 2").select("id", "cnt")


@query("stale_fire", f"with {_EV}, w as (select id, host, event_type, count(*) over (partition by host, event_type order by ts_us range between {96 * _HOUR - 1} preceding and current row) as cnt from ev) select host, event_type, count(*) as fired from w where cnt = 3 group by all")
def stale_fire(spark, d):
    w = Wn.sliding_count(_events(spark, d), ["host", "event_type"], 96 * _HOUR)
    return w.filter("cnt = 3").groupBy("host", "event_type").agg(F.count("*").alias("fired"))


@query("recent_failed", f"with {_EV}, l as (select host, id, max(ts_us) as ts_us from ev where event_type = 'error' group by all) select host, id, rank from (select *, row_number() over (partition by host order by ts_us desc, id) as rank from l) where rank <= 5")
def recent_failed(spark, d):
    return Wn.recent(_events(spark, d).filter("event_type = 'error'"), ["host"], "id", "ts_us", 5).select("host", "id", "rank")


@query("auto_upgrade", f"with {_EV}, w as (select host, count(*) over (partition by host order by ts_us range between {720 * _HOUR - 1} preceding and current row) as cnt from ev where event_type = 'error') select host, max(cnt) as peak, max(cnt) >= 3 as upgrade from w group by 1")
def auto_upgrade(spark, d):
    w = Wn.sliding_count(_events(spark, d).filter("event_type = 'error'"), ["host"], 720 * _HOUR)
    return w.groupBy("host").agg(F.max("cnt").alias("peak"), (F.max("cnt") >= 3).alias("upgrade"))


@query("provider_hybrid", "with s as (select s_nationkey as request, s_suppkey as id, greatest(s_acctbal, 0) as cost, (s_suppkey % 7)::double as lat from supplier), n as (select *, case when max(cost) over (partition by request) > 0 then cost / max(cost) over (partition by request) else 0 end * 0.6 + case when max(lat) over (partition by request) > 0 then lat / max(lat) over (partition by request) else 0 end * 0.4 as score from s) "
       "select request, id, row_number() over (partition by request order by round(score, 9), id) as rank from n")
def provider_hybrid(spark, d):
    s = table(spark, d, "supplier").select(F.col("s_nationkey").alias("request"), F.col("s_suppkey").alias("id"), F.greatest("s_acctbal", F.lit(0.0)).alias("cost"), (F.col("s_suppkey") % 7).cast("double").alias("lat"))
    s = s.withColumn("score", Wn.share_of_max(F.col("cost"), ["request"]) * 0.6 + Wn.share_of_max(F.col("lat"), ["request"]) * 0.4)
    return s.withColumn("rank", F.row_number().over(W.partitionBy("request").orderBy(F.round("score", 9), "id"))).select("request", "id", "rank")


@query("ttl_dedup", f"with recursive {_EV}, o as (select host, ts_us, id, row_number() over (partition by host order by ts_us, id) as rn from ev), f as (select host, rn, ts_us, ts_us as last, true as accepted from o where rn = 1 "
       f"union all select o.host, o.rn, o.ts_us, case when o.ts_us >= f.last + {24 * _HOUR} then o.ts_us else f.last end, o.ts_us >= f.last + {24 * _HOUR} from f join o on o.host = f.host and o.rn = f.rn + 1) select host, count(*) as n, sum(accepted::int)::bigint as accepted from f group by 1")
def ttl_dedup(spark, d):
    a = folds.ttl_accepts(_events(spark, d), ["host"], 24 * _HOUR)
    return a.groupBy("host").agg(F.count("*").alias("n"), F.sum(F.col("accepted").cast("int")).alias("accepted"))


@query("token_bucket", f"with recursive {_EV}, o as (select host, ts_us, row_number() over (partition by host order by ts_us, id) as rn from ev), "
       "f as (select host, rn, ts_us, 1.0::double as tokens, true as allowed from o where rn = 1 union all select o.host, o.rn, o.ts_us, t.x - (t.x >= 1)::int, t.x >= 1 from f join o on o.host = f.host and o.rn = f.rn + 1, lateral (select least(f.tokens + (o.ts_us - f.ts_us) / 1e6 * (0.02 / 3600.0), 2.0::double) as x) t) "
       "select host, count(*) filter (allowed) as allowed, count(*) filter (not allowed) as refused from f group by 1")
def token_bucket(spark, d):
    """Two tokens a user, refilled at one in fifty hours."""
    return folds.token_bucket(_events(spark, d), ["host"], 0.02, 2)


_FOLD = "with recursive {ev}, o as (select host, ts_us, event_type, row_number() over (partition by host order by ts_us, id) as rn from ev), "


@query("circuit_breaker", _FOLD.format(ev=_EV) + f"f as (select host, rn, 1 as admitted, case when event_type = 'error' then 1 else 0 end as run, null::bigint as until_us, 0 as opened, 0 as refused from o where rn = 1 "
       f"union all select o.host, o.rn, case when v.shut then 0 else 1 end, case when v.shut then f.run when v.bad and (v.probe or f.run >= 1) then 0 when v.bad then f.run + 1 else 0 end, "
       f"case when v.shut then f.until_us when v.bad and (v.probe or f.run >= 1) then o.ts_us + {48 * _HOUR} end, case when not v.shut and v.bad and (v.probe or f.run >= 1) then 1 else 0 end, case when v.shut then 1 else 0 end "
       "from f join o on o.host = f.host and o.rn = f.rn + 1, lateral (select coalesce(o.ts_us < f.until_us, false) as shut, f.until_us is not null as probe, o.event_type = 'error' as bad) v) "
       "select host, sum(admitted)::bigint as admitted, sum(refused)::bigint as rejected, sum(opened)::bigint as opened from f group by 1")
def circuit_breaker(spark, d):
    e = _events(spark, d).withColumn("ok", F.col("event_type") != "error")
    return folds.circuit_breaker(e, ["host"], 2, 48 * _HOUR)


@query("host_breaker", _FOLD.format(ev=_EV) + f"f as (select host, rn, 1 as admitted, case when event_type = 'error' then 1 else 0 end as run, null::bigint as until_us, 0 as blocked from o where rn = 1 "
       f"union all select o.host, o.rn, case when v.shut then 0 else 1 end, case when v.shut then f.run else v.run end, case when v.shut then f.until_us when v.run >= 2 then o.ts_us + {96 * _HOUR} end, case when not v.shut and v.run >= 2 then 1 else 0 end "
       "from f join o on o.host = f.host and o.rn = f.rn + 1, lateral (select coalesce(o.ts_us < f.until_us, false) as shut, case when o.event_type <> 'error' then 0 when f.until_us is not null then 1 else f.run + 1 end as run) v) "
       "select host, sum(admitted)::bigint as admitted, sum(1 - admitted)::bigint as refused, sum(blocked)::bigint as blocked from f group by 1")
def host_breaker(spark, d):
    """Two rate-limit answers in a row shut a host for four days (three and ten minutes by default)."""
    e = _events(spark, d).withColumn("limited", F.col("event_type") == "error")
    return folds.host_breaker(e, ["host"], 2, 96 * _HOUR)


@query("latency_ema", f"with recursive {_EV}, o as (select host, value, event_type, row_number() over (partition by host order by ts_us, id) as rn from ev), f as (select host, rn, value::double as ema, (event_type = 'error')::int as bad from o where rn = 1 "
       "union all select o.host, o.rn, 0.2 * o.value + 0.8 * f.ema, f.bad + (o.event_type = 'error')::int from f join o on o.host = f.host and o.rn = f.rn + 1) select host, round(arg_max(ema, rn), 4) as ema, max(rn)::int as n, max(bad)::int as failures, round(max(bad)::double / max(rn), 6) as failure_rate from f group by 1")
def latency_ema(spark, d):
    e = _events(spark, d).withColumn("failed", F.col("event_type") == "error")
    return folds.smoothed(e, ["host"], "value", failed="failed").select("host", F.round("ema", 4).alias("ema"), "n", "failures", F.round("failure_rate", 6).alias("failure_rate"))


@query("raw_outcome", f"with s as (select id, url from raw_contents where {_HALF}), b as (select id, url from raw_contents where not {_HALF} and url is not null) "
       "select id, url, coalesce((select min(s.id) from s where s.url = b.url), min(id) over (partition by url)) as stored_id, id <> coalesce((select min(s.id) from s where s.url = b.url), min(id) over (partition by url)) as duplicate from b")
def raw_outcome(spark, d):
    """The id each page of a batch is stored under."""
    r = table(spark, d, "raw_contents").select("id", "url")
    half = F.ascii(F.substring("id", -1, 1)) % 2 == 0
    return St.store_outcome(r.filter(~half), r.filter(half))


@query("retry_republish", f"with {_JOBS}, due as (select id, ms, (id % 3)::int as attempts from jobs where p = 1 order by ms, id limit 200) select id, 1800000000000 + 5000 * (attempts + 1) as due_ms, attempts + 1 as attempts from due where id % 4 = 0")
def retry_republish(spark, d):
    """The schedule after a round in which every fourth publication failed."""
    due = _jobs(spark, d).filter("priority = '1'").orderBy("arrival_ms", "id").limit(200).select("id", F.col("arrival_ms").alias("due_ms"), (F.col("id") % 3).cast("int").alias("attempts"))
    return Q.republished(due, due.filter("id % 4 = 0"), F.lit(1_800_000_000_000), 5000)[1]


QUERIES, SQL = query.queries, query.sql
