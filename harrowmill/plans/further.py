"""Further queries over rules, headers, queues and sets."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from harrowmill.functions import urls as U
from harrowmill.functions.datetimes import ntz_micros
from harrowmill.operators import enrich as E, html as H, inference as I, publish as Pb, queueing as Q, store as St, windows as Wn
from harrowmill.plans import fixtures as X
from harrowmill.plans.reading import _BLACK, _HOST, _PAGES, _PATH, _pages
from harrowmill.plans.registry import Registry
from harrowmill.plans.writing import _EV, _HOUR, _JOBS, _P, _events, _jobs
from harrowmill.sources import connectors as C
from harrowmill.sources.tables import table

query = Registry()


@query("handler_lookup", "select s.source_id, coalesce(h.handler, 'general') as handler from sources s left join (values ('community', 'forum'), ('social', 'feed')) h(type, handler) using (type)")
def handler_lookup(spark, d):
    h = spark.createDataFrame([("community", "forum"), ("social", "feed")], "type string, handler string")
    return table(spark, d, "sources").join(h, "type", "left").select("source_id", F.coalesce("handler", F.lit("general")).alias("handler"))


@query("header_defaults", "select id, coalesce(try_cast(nullif(map_extract_value(headers, 'x-timeout'), '') as int), 30) as timeout_s, coalesce(map_extract_value(headers, 'content-type'), 'text/html') as content_type from raw_contents")
def header_defaults(spark, d):
    t = F.col("headers")["x-timeout"].try_cast("int")
    return table(spark, d, "raw_contents").select("id", F.when(t > 0, t).otherwise(30).alias("timeout_s"), F.coalesce(F.col("headers")["content-type"], F.lit("text/html")).alias("content_type"))


_MESSAGE = "case when contains(lower(html), 'budget') then 'Maximum Context of 9 exceeded' else 'bad' end"


@query("error_class_model", f"with m as (select case when status_code between 400 and 499 and status_code not in (401, 403, 429) then 400 else status_code end as s, {_MESSAGE} as msg from raw_contents), "
       "c as (select s, case when s in (401, 403) then 'auth' when s = 429 then 'rate_limit' when s between 500 and 599 then 'server' when s = 400 and msg like 'Maximum%' then 'context_limit' when s between 400 and 499 then 'bad_request' else 'unknown' end as class from m) select s as status, class, class <> 'bad_request' as delegate, count(*) as n from c group by all")
def error_class_model(spark, d):
    """Client errors are read as 400, with a message that for some pages speaks of a too long input."""
    code = F.col("status_code")
    s = F.when(code.between(400, 499) & ~code.isin(401, 403, 429), 400).otherwise(code)
    said = F.when(F.lower("html").contains("budget"), "Maximum Context of 9 exceeded").otherwise("bad")
    kind = E.error_class(F.col("status"), F.col("message"))
    r = table(spark, d, "raw_contents").select(s.alias("status"), said.alias("message"))
    return r.groupBy("status", kind.alias("class"), E.may_delegate(kind).alias("delegate")).agg(F.count("*").alias("n"))


@query("retryable_errors", "select delivery_id % 5 as kind, count(*) as n from content_refs where country is not null and delivery_id % 5 in (0, 1, 2) group by 1")
def retryable_errors(spark, d):
    """Retried only if the error is flagged (here: deliveries with a country) and of a category that the policy names."""
    k = F.col("delivery_id") % 5
    category = F.when(k == 0, "network").when(k == 1, "timeout").when(k == 2, "rate_limit").when(k == 3, "validation").otherwise("internal")
    r = table(spark, d, "content_refs").withColumns({"category": category, "flagged": F.col("country").isNotNull(), "kind": k})
    return r.filter(F.col("flagged") & F.col("category").isin("network", "timeout", "rate_limit")).groupBy("kind").agg(F.count("*").alias("n"))


@query("tagged_union", f"select 'article' as lane, id from contents where article union all select 'list', id from contents where not article and {_PATH} like '/sports/%'")
def tagged_union(spark, d):
    c = table(spark, d, "contents")
    lists = c.filter(~F.col("article") & U.url_path(F.col("url")).startswith("/sports/"))
    return c.filter("article").select(F.lit("article").alias("lane"), "id").unionByName(lists.select(F.lit("list").alias("lane"), "id"))


@query("tracked_minus_done", "select count(*) as n from (select distinct id from content_refs where topic = 'normalized' and id <> '' except select id from content_refs where topic = 'validated')")
def tracked_minus_done(spark, d):
    r = table(spark, d, "content_refs").filter("id <> ''")
    done = r.filter("topic = 'validated'").select("id")
    return r.filter("topic = 'normalized'").select("id").distinct().join(done, "id", "left_anti").agg(F.count("*").alias("n"))


@query("ordered_distinct", "select name, first_pos from (select name, min(mention_id) as first_pos from entities where type = 'location' group by 1) order by first_pos limit 100")
def ordered_distinct(spark, d):
    e = table(spark, d, "entities").filter("type = 'location'").groupBy("name").agg(F.min("mention_id").alias("first_pos"))
    return e.orderBy("first_pos").limit(100)


@query("queue_lengths", f"with {_JOBS} select ({_P})::int as priority, count(distinct id) as n from jobs group by 1")
def queue_lengths(spark, d):
    return _jobs(spark, d).groupBy(Q.priority_of(F.col("priority")).alias("priority")).agg(F.count_distinct("id").alias("n"))


@query("priority_intake", "with m as (select id, case when length(topic) % 4 between 1 and 3 then length(topic) % 4 else 2 end as p, epoch_ms(delivered_at) as ms, length(topic) % 4 as raw from content_refs where id <> ''), "
       "l as (select id, arg_max(struct_pack(p := p, ms := ms), (ms, raw::varchar)) as e from m group by 1) select id, e.p * 10000000000000 + e.ms as score from l order by score, id limit 500")
def priority_intake(spark, d):
    """Deliveries pushed to a queue of five hundred: those without id are dropped, the last push of an id counts."""
    r = table(spark, d, "content_refs")
    m = r.select("id", (F.length("topic") % 4).cast("string").alias("priority"), F.floor(ntz_micros("delivered_at") / 1000).alias("arrival_ms"))
    return Q.intake(m, 500)


@query("pending_queue", "select source_id, id, row_number() over (partition by source_id order by created_at, id) as place, row_number() over (partition by source_id order by created_at, id) <= 30 as accepted from contents where created_at is not null")
def pending_queue(spark, d):
    """Thirty wait per source in order of arrival, later ones are refused."""
    c = table(spark, d, "contents").filter("created_at is not null").select("source_id", "id", F.col("created_at").alias("arrival"))
    return Pb.pending_pushes(c, ["source_id"], 30).select("source_id", "id", "place", "accepted")


@query("stage_slots", "select source_id, case when requests_per_hour > 0 then least(greatest(length(name) // 2, 1), requests_per_hour // 20) else greatest(length(name) // 2, 1) end::int as slots from sources")
def stage_slots(spark, d):
    s = table(spark, d, "sources")
    limit = F.when(F.col("requests_per_hour") > 0, F.floor(F.col("requests_per_hour") / 20))
    return s.select("source_id", Q.stage_slots(F.length("name"), limit).alias("slots"))


@query("header_codec", "select id, array_to_string(list_sort(list_transform(map_entries(headers), lambda e: e.key || '=' || coalesce(e.value, ''))), ';') as entries, len(map_keys(headers))::int as n from raw_contents where headers is not null")
def header_codec(spark, d):
    """Headers to broker entries and back; of keys given twice the last one counts."""
    r = table(spark, d, "raw_contents").filter("headers is not null")
    twice = F.concat(F.transform(F.map_keys("headers"), lambda k: F.struct(k.alias("key"), F.lit("old").cast("binary").alias("value"))), C.header_entries(F.col("headers")))
    back = C.header_map(twice)
    text = F.array_join(F.array_sort(F.transform(F.map_entries(back), lambda e: F.concat(e["key"], F.lit("="), F.coalesce(e["value"], F.lit(""))))), ";")
    return r.select("id", text.alias("entries"), F.size(back).alias("n"))


@query("sample_accumulate", f"with auto as (select source_id from sources where requests_per_hour is not null), s as (select source_id, url, min(created_at) as t from contents join auto using (source_id) where not coalesce(article, false) group by all) "
       "select source_id, count(*) as n from (select *, row_number() over (partition by source_id order by t, url) as rn from s) where rn <= 100 group by 1")
def sample_accumulate(spark, d):
    """Samples gather only under automatic catch-all rules (here: of sources with a rate, for pages that are no articles)."""
    auto = table(spark, d, "sources").filter("requests_per_hour is not null").select("source_id")
    c = table(spark, d, "contents").filter(~F.coalesce("article", F.lit(False))).join(auto, "source_id", "left_semi")
    s = c.groupBy("source_id", "url").agg(F.min("created_at").alias("t"))
    return Q.first_of(s, ["source_id"], 100, "t", "url").groupBy("source_id").agg(F.count("*").alias("n"))


@query("host_fallbacks", f"select id, {_HOST} as host, case when {_HOST} = '' then url else {_HOST} end as host_or_url, case when {_HOST} = '' then '_unknown_' else {_HOST} end as host_or_unknown from (select id, case when word_count % 5 = 0 then '/relative/' || id when word_count % 5 = 1 then replace(url, '.example/', '.example:8080/') else url end as url from contents where url is not null)")
def host_fallbacks(spark, d):
    """Hosts of absolute urls, with a port and of relative ones, by each fallback."""
    n, u = F.col("word_count"), F.col("url")
    asked = F.when(n % 5 == 0, F.concat(F.lit("/relative/"), "id")).when(n % 5 == 1, F.replace(u, F.lit(".example/"), F.lit(".example:8080/"))).otherwise(u)
    c = table(spark, d, "contents").filter("url is not null").select("id", asked.alias("url"))
    return c.select("id", U.url_hostname(u).alias("host"), U.host_or_url(u).alias("host_or_url"), U.host_or_unknown(u).alias("host_or_unknown"))


@query("backoff_jitter")
def backoff_jitter(spark, d):
    """Waits with a jitter factor of 0.5 to 1.5 stay within half and one and a half times the plain wait."""
    n = F.col("l_linenumber")
    plain, wide = Q.backoff_seconds(n, 2.0, 2.0, 60.0), Q.backoff_seconds(n, 2.0, 2.0, 60.0, jitter=0.5, seed=3)
    return table(spark, d, "lineitem").filter("l_returnflag = 'R'").select("l_orderkey", n, ((wide >= plain * 0.5) & (wide <= plain * 1.5)).alias("within"))


@query("samples_list", "select source_id, url from (select source_id, url, row_number() over (partition by source_id order by created_at desc, url) as rn from contents) where rn <= 3")
def samples_list(spark, d):
    c = table(spark, d, "contents").select("source_id", "url", "created_at")
    return c.withColumn("rn", F.row_number().over(W.partitionBy("source_id").orderBy(F.desc("created_at"), "url"))).filter("rn <= 3").select("source_id", "url")


@query("blacklist_insert", f"with {_PAGES}, {_BLACK} select distinct host, '^' || regexp_replace(path, '([\\\\.+*?()|\\[\\]{{}}^$])', '\\\\\\1', 'g') || '$' as path_pattern, 'drop' as mode from pages where path like '/travel/%' and not exists (select 1 from b where b.host_pattern = host and b.path_pattern = '')")
def blacklist_insert(spark, d):
    """Decisions for single pages become exact patterns; unknown modes are drop, patterns that exist are no-ops."""
    whole = X.blacklist(spark).filter("path_pattern = ''").select(F.col("host_pattern").alias("host"))
    p = _pages(spark, d).filter(F.col("path").startswith("/travel/")).join(whole, "host", "left_anti")
    asked = F.lit("remove-it")
    mode = F.when(asked.isin("drop", "extract_links_only"), asked).otherwise("drop")
    return p.select("host", F.concat(F.lit("^"), U.quote_regex(F.col("path")), F.lit("$")).alias("path_pattern"), mode.alias("mode")).distinct()


@query("auto_demote")
def auto_demote(spark, d):
    """Pages that are mere indexes become exact block-list entries unless they are listed already."""
    raw = table(spark, d, "raw_contents").select("id", "url", "html").filter("html is not null")
    c = X.contents(spark, d).select("url", "body", "published_s").dropDuplicates(["url"])
    verdict = H.index_only(raw.select("id", "url").join(c, "url").drop("url"), H.anchor_figures(raw)).filter("index_only")
    rows = raw.join(verdict, "id", "left_semi").select(U.host_with_port(F.col("url")).alias("host_pattern"), U.exact_path_pattern(F.col("url")).alias("path_pattern"))
    return rows.distinct().join(X.blacklist(spark), ["host_pattern", "path_pattern"], "left_anti")


@query("auto_downgrade", "select source_id, case when requests_per_hour > 150 then 'plain' else 'browser' end as fetcher, requests_per_hour > 150 as changed from sources where requests_per_hour is not null")
def auto_downgrade(spark, d):
    s = table(spark, d, "sources").filter("requests_per_hour is not null")
    auto = F.col("requests_per_hour") > 150
    return s.select("source_id", F.when(auto, "plain").otherwise("browser").alias("fetcher"), auto.alias("changed"))


@query("fetcher_rule_upsert", f"select {_HOST} as host, arg_max(case when created_at is null then 'plain' else ['plain', 'browser'][1 + word_count % 2] end, (created_at, id)) as kind from contents where url is not null and created_at is not null and word_count % 3 < 2 group by 1")
def fetcher_rule_upsert(spark, d):
    """One rule a host, the last one stated; hosts in any case and with blanks, unknown kinds left out."""
    n = F.col("word_count")
    kind = F.when(n % 3 == 2, "magic").when(n % 2 == 0, "plain").otherwise("browser")
    host = F.concat(F.lit(" "), F.upper(U.url_hostname(F.col("url"))), F.lit(" "))
    r = table(spark, d, "contents").filter("url is not null and created_at is not null").select(host.alias("host"), kind.alias("kind"), "created_at", "id")
    good = r.filter(F.col("kind").isin("plain", "browser")).withColumn("host", F.lower(F.trim("host")))
    return St.latest_per_key(good, ["host"], "created_at", "id").select("host", "kind")


@query("provider_orders", "select s_nationkey as request, s_suppkey as id, row_number() over (partition by s_nationkey order by s_suppkey) as fixed, row_number() over (partition by s_nationkey order by coalesce(nullif(s_suppkey % 7, 0), 1000), s_suppkey) as latency from supplier")
def provider_orders(spark, d):
    """In the order stated, and by measured latency with unmeasured providers last."""
    s = table(spark, d, "supplier").select(F.col("s_nationkey").alias("request"), F.col("s_suppkey").alias("id"), F.col("s_suppkey").alias("place"), F.nullif(F.col("s_suppkey") % 7, F.lit(0)).alias("latency_ms"))
    fixed = Q.provider_order(s, "request").withColumnRenamed("rank", "fixed")
    return Q.provider_order(fixed, "request", F.asc_nulls_last("latency_ms")).select("request", "id", "fixed", F.col("rank").alias("latency"))


@query("provider_cheapest", "select s_nationkey as request, s_suppkey as id, row_number() over (partition by s_nationkey order by floor(s_acctbal / 1000), s_acctbal, s_suppkey) as rank from supplier")
def provider_cheapest(spark, d):
    order = [F.floor(F.col("s_acctbal") / 1000), "s_acctbal", "s_suppkey"]
    s = table(spark, d, "supplier")
    return s.select(F.col("s_nationkey").alias("request"), F.col("s_suppkey").alias("id"), F.row_number().over(W.partitionBy("s_nationkey").orderBy(*order)).alias("rank"))


@query("provider_random")
def provider_random(spark, d):
    """Weighted order without replacement, weight 1/(latency+1), seeded."""
    s = table(spark, d, "supplier").select(F.col("s_nationkey").alias("request"), F.col("s_suppkey").alias("id"), (F.col("s_suppkey") % 7).alias("lat"))
    u = (F.pmod(F.xxhash64(F.lit(5), "id"), F.lit(1_000_003)) + 1) / 1_000_004.0
    return s.withColumn("rank", F.row_number().over(W.partitionBy("request").orderBy(-F.log(u) * (F.col("lat") + 1), "id"))).select("request", "id", "rank")


@query("context_parse", "select claim_id, claim_id % 3 = 0 as has_background, claim_id % 3 <> 0 as empty from claims")
def context_parse(spark, d):
    """Missing lists are empty, implications without text are null; a context without either is empty."""
    items = F.when(F.col("claim_id") % 3 == 0, F.lit('"background": [{"text": "x"}]')).otherwise(F.lit('"background": null'))
    text = F.concat(F.lit("{"), items, F.lit(', "implications": {"political": "", "social": ""}}'))
    j = F.from_json(E.strip_fences(text), "background array<struct<text:string>>, timeline array<struct<text:string>>, implications struct<political:string,social:string,technical:string>")
    n = F.coalesce(F.size(j["background"]), F.lit(0))
    some = F.concat_ws("", j["implications"]["political"], j["implications"]["social"], j["implications"]["technical"]) != ""
    return table(spark, d, "claims").select("claim_id", (n > 0).alias("has_background"), ((n + F.coalesce(F.size(j["timeline"]), F.lit(0)) == 0) & ~some).alias("empty"))


@query("response_salvage", "select claim_id, claim_id % 2 = 0 as valid from claims where claim_id % 5 <> 0")
def response_salvage(spark, d):
    """The verdict of a cut-off answer, read by pattern; answers without one are left out."""
    said = F.when(F.col("claim_id") % 5 == 0, F.lit('{"reason": "cut')).otherwise(F.concat(F.lit('{"valid" :  '), (F.col("claim_id") % 2 == 0).cast("string"), F.lit(', "rea')))
    got = F.regexp_extract(said, r'"valid"\s*:\s*(true|false)', 1)
    return table(spark, d, "claims").withColumn("v", got).filter("v <> ''").select("claim_id", (F.col("v") == "true").alias("valid"))


@query("first_line_pattern", "select claim_id, case claim_id % 5 when 0 then '^/.*$' when 1 then '/.+' else '^/' || coalesce(predicate, 'x') || '$' end as pattern, claim_id % 5 in (0, 1) as broad from claims")
def first_line_pattern(spark, d):
    """The first line that is not blank, or the first one within code fences; patterns for any path are broad."""
    n = F.col("claim_id")
    line = F.when(n % 5 == 0, "^/.*$").when(n % 5 == 1, "/.+").otherwise(F.concat(F.lit("^/"), F.coalesce("predicate", F.lit("x")), F.lit("$")))
    said = F.when(n % 2 == 0, F.concat(F.lit("\n  \n"), line, F.lit("  \nbecause"))).otherwise(F.concat(F.lit("The pattern is\n```regex\n\n  "), line, F.lit("\n```\nas asked.")))
    first = E.trimmed(F.filter(F.split(E.strip_fences(said), "\n"), lambda x: E.trimmed(x) != "")[0])
    return table(spark, d, "claims").select("claim_id", first.alias("pattern"), I.is_too_broad(first).alias("broad"))


@query("selector_sanity")
def selector_sanity(spark, d):
    hits = H.selector_hits(table(spark, d, "raw_contents").filter("html is not null"), {"title": ("h1, h2, h3", None), "main": ("p, div", None), "container": ("li, div", None), "link": ("a[href]", "href")})
    h = F.col("hits")
    page, listed = (h["title"] > 0) & (h["main"] > 0), (h["container"] > 0) & (h["link"] > 0)
    return hits.groupBy(page.alias("page_sane"), listed.alias("list_sane")).agg(F.count("*").alias("n"))


@query("ingestion_keys", "select id, 'ingestion:url:' || sha256(url) as key from contents where url is not null")
def ingestion_keys(spark, d):
    return table(spark, d, "contents").filter("url is not null").select("id", F.concat(F.lit("ingestion:url:"), F.sha2("url", 256)).alias("key"))


@query("keyword_entries", "select s.source_id, k.keyword from sources s, (values ('budget'), ('tram')) k(keyword) where s.type = 'community'")
def keyword_entries(spark, d):
    """Every keyword for every search entry: the stated keywords are exploded beside each entry, no join is needed."""
    s = table(spark, d, "sources").filter("type = 'community'")
    return s.select("source_id", F.explode(F.array(F.lit("budget"), F.lit("tram"))).alias("keyword"))


@query("upgrade_republish", f"with {_EV}, w as (select host, id, ts_us, count(*) over (partition by host order by ts_us range between {720 * _HOUR - 1} preceding and current row) as cnt from ev where event_type = 'error'), u as (select host from w group by 1 having max(cnt) >= 3) "
       "select host, id from (select host, id, row_number() over (partition by host order by ts_us desc, id) as rank from w join u using (host)) where rank <= 20")
def upgrade_republish(spark, d):
    e = _events(spark, d).filter("event_type = 'error'")
    hot = Wn.sliding_count(e, ["host"], 720 * _HOUR).groupBy("host").agg(F.max("cnt").alias("m")).filter("m >= 3").select("host")
    return Wn.recent(e.join(hot, "host", "left_semi"), ["host"], "id", "ts_us", 20).select("host", "id")


QUERIES, SQL = query.queries, query.sql
