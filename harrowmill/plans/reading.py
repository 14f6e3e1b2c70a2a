"""Queries over stored contents, URLs and rules."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from harrowmill.functions import urls as U
from harrowmill.operators import rules as R
from harrowmill.operators import search as S
from harrowmill.plans import fixtures as X
from harrowmill.plans.registry import Registry
from harrowmill.sources.tables import table

query = Registry()
T0, T1 = 1704067200, 1767225599  # the years 2024 and 2025 in UTC


@query("content_search", f"with {X.CONTENTS} select id, published_s, round(reliability::double, 6) as rel from content_rows where country = 'US' and published_s >= {T0} "
       f"and published_s <= {T1} and list_has_all(tags, ['culture']) and reliability::double >= 0.1 order by published_s desc nulls last, id limit 50")
def content_search(spark, d):
    c = X.contents(spark, d).filter(S.content_filter(country="US", published_from=T0, published_to=T1, tags=["culture"], min_reliability=0.1))
    return S.page(c.select("id", "published_s", F.round(F.col("reliability").cast("double"), 6).alias("rel")), F.desc_nulls_last("published_s"), F.asc("id"))


@query("content_list_page2", f"with {X.CONTENTS} select id, source_id, title from content_rows where language = 'en' and category = 'science' order by published_s desc nulls last, id limit 20 offset 20")
def content_list_page2(spark, d):
    c = S.list_view(X.contents(spark, d)).filter(S.content_filter(language="en", category="science"))
    return S.page(c, F.desc_nulls_last("published_s"), F.asc("id"), limit=20, offset=20).select("id", "source_id", "title")


@query("content_count", f"with {X.CONTENTS} select count(*) as n from content_rows where source_type = 'news' and list_has_all(tags, ['culture', 'politics'])")
def content_count(spark, d):
    return X.contents(spark, d).filter(S.content_filter(source_type="news", tags=["culture", "politics"])).agg(F.count("*").alias("n"))


@query("content_full", "select c.id, title, coalesce(body, '') as body, coalesce(summary, '') as summary, coalesce(word_count, 0) as word_count, len(coalesce(image_urls, []))::int as images from contents c where country = 'GB'")
def content_full(spark, d):
    c = table(spark, d, "contents")
    bodies = c.select(F.col("id").alias("content_id"), "body", "summary", "word_count")
    meta = c.select(F.col("id").alias("content_id"), "image_urls")
    full = S.full_view(c.select("id", "title", "country").filter("country = 'GB'"), bodies, meta)
    return full.select("id", "title", "body", "summary", "word_count", F.size("image_urls").alias("images"))


@query("evidence_candidates", f"with {X.CONTENTS} select id, title, country from content_rows where country = 'US' and published_s >= {T0} and title ilike '%budget%' order by published_s desc nulls last, id limit 20")
def evidence_candidates(spark, d):
    c = S.list_view(X.contents(spark, d)).filter(S.content_filter(country="US", published_from=T0) & F.col("title").ilike("%budget%"))
    return S.page(c, F.desc_nulls_last("published_s"), F.asc("id"), limit=20).select("id", "title", "country")


@query("raw_list", "select id, status_code, epoch_us(created_at) as created_us from raw_contents where source.country = 'GB' and status_code = 200 order by created_at desc, id limit 50")
def raw_list(spark, d):
    r = table(spark, d, "raw_contents").filter(S.raw_filter(country="GB", status_code=200))
    return S.page(r, F.desc("created_at"), F.asc("id")).select("id", "status_code", F.unix_micros("created_at").alias("created_us"))


@query("raw_by_url", "select id, url from raw_contents where url = (select min(url) from raw_contents)")
def raw_by_url(spark, d):
    r = table(spark, d, "raw_contents").select("id", "url")
    return r.filter(F.col("url") == r.agg(F.min("url")).first()[0])


@query("content_by_hash", "select content_hash, arg_min(id, id) as id, count(*) as copies from contents where content_hash <> '' group by content_hash")
def content_by_hash(spark, d):
    c = table(spark, d, "contents").filter(F.col("content_hash") != "")
    return c.groupBy("content_hash").agg(F.min("id").alias("id"), F.count("*").alias("copies"))


@query("claim_check_join", "select r.delivery_id, c.id as content_id, length(c.body)::int as n_chars from content_refs r join contents c on c.id = r.id where r.topic = 'validated'")
def claim_check_join(spark, d):
    refs = table(spark, d, "content_refs").filter("topic = 'validated'").select("delivery_id", "id")
    c = table(spark, d, "contents").select("id", F.length("body").alias("n_chars"))
    return refs.join(c, "id").select("delivery_id", F.col("id").alias("content_id"), "n_chars")


@query("claim_check_missing", "select r.topic, count(*) as n from content_refs r where not exists (select 1 from contents c where c.id = r.id) group by r.topic")
def claim_check_missing(spark, d):
    refs = table(spark, d, "content_refs").select("topic", "id")
    return refs.join(table(spark, d, "contents").select("id"), "id", "left_anti").groupBy("topic").agg(F.count("*").alias("n"))


@query("enabled_entries", "select source_id, base_url, case when type = 'community' then 600 else 1800 end as interval_s from sources where requests_per_hour is not null and type = 'news' order by source_id")
def enabled_entries(spark, d):
    s = table(spark, d, "sources").filter(F.col("requests_per_hour").isNotNull() & (F.col("type") == "news"))
    return s.select("source_id", "base_url", F.when(F.col("type") == "community", 600).otherwise(1800).alias("interval_s")).orderBy("source_id")


@query("rules_list", f"with {X.values('r', X.RULE_COLUMNS, X.PARSER_RULES)} select source_name, host_pattern, target_type, version from r where enabled and article order by source_name, host_pattern, target_type, version desc")
def rules_list(spark, d):
    r = X.parser_rules(spark).filter(S.rule_filter(only_enabled=True, article=True))
    return r.select("source_name", "host_pattern", "target_type", "version").orderBy("source_name", "host_pattern", "target_type", F.desc("version"))


# --- URLs --------------------------------------------------------------------------------------------------------

from harrowmill.plans.general import _URL  # noqa: E402

_HOST = "lower(regexp_replace(regexp_replace(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\\-]*://([^/?#]*)', 1), '^.*@', ''), ':[0-9]*$', ''))"
_PATH = "regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\\-]*://[^/?#]*([^?#]*)', 1)"


@query("url_normalize", f"select delivery_id, {_URL} as norm from content_refs where url is not null")
def url_normalize(spark, d):
    return table(spark, d, "content_refs").filter("url is not null").select("delivery_id", U.normalize_or_keep(F.col("url")).alias("norm"))


@query("url_publish_batch", f"select norm, count(*) as n from (select {_URL} as norm from content_refs) where norm <> '' group by norm having count(*) > 3")
def url_publish_batch(spark, d):
    n = table(spark, d, "content_refs").select(U.normalize_or_keep(F.col("url")).alias("norm")).filter("norm <> ''")
    return n.groupBy("norm").agg(F.count("*").alias("n")).filter("n > 3")


@query("url_options", "select delivery_id, regexp_replace(regexp_replace(lower(regexp_extract(url, '^([^/]+//[^/?#]*)', 1)), '//www\\.', '//'), '^', '') || "
       f"{_PATH} as kept from content_refs where url is not null")
def url_options(spark, d):
    opts = {"force_https": False, "strip_www": True, "strip_trailing_slash": False}
    return table(spark, d, "content_refs").filter("url is not null").select("delivery_id", U.normalize_or_keep(F.col("url"), **opts).alias("kept"))


_ASKED = "asked as (select delivery_id, coalesce(topic, '') || '=' || coalesce(id, '') || ' é*~' as v, topic from content_refs)"


@query("url_allowed_params", f"with {_ASKED} select delivery_id, 'A=' || replace(replace(replace(url_encode(v), '%20', '+'), '%7E', '~'), '*', '%2A') || '&A=2&page=' || (delivery_id % 7) || '&v=a%3Db' as query from asked")
def url_allowed_params(spark, d):
    """Values with further "=", blanks, accents and signs; repeated, foreign and empty parameters."""
    v = F.concat(F.coalesce("topic", F.lit("")), F.lit("="), F.coalesce("id", F.lit("")), F.lit(" é*~"))
    asked = F.concat(F.lit("https://WWW.site.example/a?x=1&v=a=b&&A="), F.url_encode(v), F.lit("&utm=%20&page="), (F.col("delivery_id") % 7).cast("string"), F.lit("&A=2&page2"))
    norm = U.normalize_or_keep(asked, allowed_params={"site.example": ["a", "V", "page"]})
    return table(spark, d, "content_refs").select("delivery_id", U.url_query(norm).alias("query"))


@query("url_guard", "select id, case when lower(url) like '%/sports/%' then '/sports/' when lower(url) like '%council%' then 'Council' end as denied from contents")
def url_guard(spark, d):
    return table(spark, d, "contents").select("id", U.first_denied(F.col("url"), ["/sports/", "", "Council"]).alias("denied"))


@query("url_host_groups", f"select {_HOST} as host, count(*) as n, count(distinct url) as urls from content_refs group by 1")
def url_host_groups(spark, d):
    return table(spark, d, "content_refs").select(U.url_hostname(F.col("url")).alias("host"), "url").groupBy("host").agg(F.count("*").alias("n"), F.count_distinct("url").alias("urls"))


@query("url_exact_pattern", f"select id, '^' || regexp_replace({_PATH}, '([\\\\.+*?()|\\[\\]{{}}^$])', '\\\\\\1', 'g') || '$' as pattern from contents where url is not null")
def url_exact_pattern(spark, d):
    return table(spark, d, "contents").filter("url is not null").select("id", U.exact_path_pattern(F.col("url")).alias("pattern"))


@query("url_unique_limit", "with f as (select source_info.name as source, url, min(delivery_id) as pos from content_refs group by all) "
       "select source, url from (select *, row_number() over (partition by source order by pos) as rn from f) where rn <= 200")
def url_unique_limit(spark, d):
    f = table(spark, d, "content_refs").groupBy(F.col("source_info.name").alias("source"), "url").agg(F.min("delivery_id").alias("pos"))
    return f.withColumn("rn", F.row_number().over(W.partitionBy("source").orderBy("pos"))).filter("rn <= 200").select("source", "url")


@query("same_origin", "select c.id, starts_with(lower(c.url), lower(s.base_url) || '/') as same from contents c join sources s using (source_id)")
def same_origin(spark, d):
    c, s = table(spark, d, "contents").select("id", "source_id", "url"), table(spark, d, "sources").select("source_id", "base_url")
    return c.join(s, "source_id").select("id", (U.url_origin(F.col("url")) == U.url_origin(F.concat("base_url", F.lit("/")))).alias("same"))


@query("path_prefixes", f"select id from contents where starts_with({_PATH}, '/politics') or starts_with({_PATH}, '/economy')")
def path_prefixes(spark, d):
    return table(spark, d, "contents").filter(U.has_path_prefix(F.col("url"), ["/politics", "/economy"])).select("id")


@query("host_variants", f"select delivery_id, coalesce(nullif({_HOST}, ''), '_unknown_') as host_known from content_refs")
def host_variants(spark, d):
    return table(spark, d, "content_refs").select("delivery_id", U.host_or_unknown(F.col("url")).alias("host_known"))


@query("http_status_class", "select id, case when status_code = 404 then 'not_found' when status_code = 429 then 'rate_limit' when status_code >= 500 then 'server' when status_code >= 400 then 'client' else 'ok' end as class, "
       "status_code = 429 or status_code >= 500 as retryable from raw_contents")
def http_status_class(spark, d):
    s = F.col("status_code")
    kind = F.when(s == 404, "not_found").when(s == 429, "rate_limit").when(s >= 500, "server").when(s >= 400, "client").otherwise("ok")
    return table(spark, d, "raw_contents").select("id", kind.alias("class"), ((s == 429) | (s >= 500)).alias("retryable"))


@query("lazy_content", "select id from raw_contents where lower(html) like '%text/x-template%' or lower(html) like '%lazyload%'")
def lazy_content(spark, d):
    low = F.lower("html")
    return table(spark, d, "raw_contents").filter(low.contains("text/x-template") | low.contains("lazyload")).select("id")


@query("partial_dom", "select id, strlen(html) >= 512 and (html like '%<body%' or html like '%<BODY%') as usable from raw_contents where html is not null")
def partial_dom(spark, d):
    ok = (F.octet_length("html") >= 512) & (F.col("html").contains("<body") | F.col("html").contains("<BODY"))
    return table(spark, d, "raw_contents").filter("html is not null").select("id", ok.alias("usable"))


@query("empty_body", "select id from contents where length(coalesce(title, '')) < 5 or length(coalesce(body, '')) < 100")
def empty_body(spark, d):
    return table(spark, d, "contents").filter((F.length(F.coalesce("title", F.lit(""))) < 5) | (F.length(F.coalesce("body", F.lit(""))) < 100)).select("id")


@query("target_type_gate", "select json_extract_string(metadata, '$.target_type') as target_type, count(*) as n from raw_contents where json_extract_string(metadata, '$.target_type') in ('article', 'category') group by 1")
def target_type_gate(spark, d):
    t = F.get_json_object("metadata", "$.target_type").alias("target_type")
    return table(spark, d, "raw_contents").select(t).filter(F.col("target_type").isin("article", "category")).groupBy("target_type").agg(F.count("*").alias("n"))


# --- rules -------------------------------------------------------------------------------------------------------

_PAGES = f"pages as (select id as key, {_HOST} as host, case when {_PATH} = '' then '/' else {_PATH} end as path from contents where url is not null)"
_RULES = X.values("r", X.RULE_COLUMNS, X.VALID_RULES)
_BLACK = X.values("b", X.BLACKLIST_COLUMNS, X.VALID_BLACKLIST)
_MATCH = "on host = host_pattern and (path_pattern = '' or regexp_matches(path, path_pattern))"


def _pages(spark, d):
    host, path = U.lookup_host_path(F.col("url"))
    return table(spark, d, "contents").filter("url is not null").select(F.col("id").alias("key"), host.alias("host"), path.alias("path"))


@query("rule_resolve", f"with {_PAGES}, {_RULES} select key, path_pattern, version from (select *, row_number() over (partition by key order by length(path_pattern) desc, version desc) as rn "
       f"from pages join r {_MATCH} where enabled and target_type = 'page') where rn = 1")
def rule_resolve(spark, d):
    r = X.parser_rules(spark).filter("enabled and target_type = 'page'")
    best = R.best_rule(_pages(spark, d), r, F.desc("_len"), F.desc("version"), keep=["path_pattern", "version"])
    return best.filter("version is not null").select("key", "path_pattern", "version")


_BEST_BLACK = f"(select key, mode, row_number() over (partition by key order by length(path_pattern) desc, id desc) as rn from pages join b {_MATCH} where enabled)"


@query("blacklist_classify", f"with {_PAGES}, {_BLACK}, best as (select * from {_BEST_BLACK} where rn = 1) select p.key, coalesce(mode, 'allow') as verdict from pages p left join best using (key)")
def blacklist_classify(spark, d):
    best = R.best_rule(_pages(spark, d), X.blacklist(spark).filter("enabled"), F.desc("_len"), F.desc("id"), keep=["mode"])
    return R.classify(best).select("key", "verdict")


@query("blacklist_filter", f"with {_PAGES}, {_BLACK} select key from pages p where not exists (select 1 from b where enabled and p.host = host_pattern and (path_pattern = '' or regexp_matches(p.path, path_pattern)))")
def blacklist_filter(spark, d):
    return R.unmatched(_pages(spark, d), X.blacklist(spark)).select("key")


@query("blacklist_list", f"with {X.values('b', X.BLACKLIST_COLUMNS, X.BLACKLIST)} select id, host_pattern, mode from b where enabled and mode = 'drop' order by id")
def blacklist_list(spark, d):
    return X.blacklist(spark).filter(S.all_of(F.col("enabled"), S.equals("mode", "drop"), S.equals("host_pattern", ""))).select("id", "host_pattern", "mode").orderBy("id")


@query("precheck_verdict", f"with {_PAGES}, {_BLACK}, best as (select * from {_BEST_BLACK} where rn = 1) select p.key, case when p.path like '%/travel/%' then 'drop' else coalesce(mode, 'allow') end as verdict, "
       "case when p.path like '%/travel/%' then 'guard' when mode is not null then 'blacklist' else '' end as source from pages p left join best using (key)")
def precheck_verdict(spark, d):
    """Ordered sources: the first verdict other than allow wins and names its source."""
    pages = _pages(spark, d)
    black = R.best_rule(pages, X.blacklist(spark).filter("enabled"), F.desc("_len"), F.desc("id"), keep=["mode"])
    guard = F.when(U.first_denied(F.col("path"), ["/travel/"]).isNotNull(), F.lit("drop"))
    verdict = F.coalesce(guard, "mode", F.lit("allow"))
    source = F.when(guard.isNotNull(), "guard").when(F.col("mode").isNotNull(), "blacklist").otherwise("")
    return black.select("key", verdict.alias("verdict"), source.alias("source"))


@query("entry_policy", f"with {_PAGES}, {_BLACK}, best as (select * from {_BEST_BLACK} where rn = 1), v as (select key, coalesce(mode, 'allow') as verdict from pages left join best using (key)) "
       "select k as page_kind, sum(case when k = 'category' then (verdict <> 'drop')::int else (verdict = 'allow')::int end)::bigint as entered from v, (values ('category'), ('article')) t(k) group by k")
def entry_policy(spark, d):
    """List pages are refused on drop only, article pages on any verdict other than allow."""
    v = R.classify(R.best_rule(_pages(spark, d), X.blacklist(spark).filter("enabled"), F.desc("_len"), F.desc("id"), keep=["mode"]))
    v = v.withColumn("page_kind", F.explode(F.array(F.lit("category"), F.lit("article"))))
    ok = F.when(F.col("page_kind") == "category", F.col("verdict") != "drop").otherwise(F.col("verdict") == "allow")
    return v.groupBy("page_kind").agg(F.sum(ok.cast("int")).alias("entered"))


_PRIO = X.values("p", ["host_pattern", "path_pattern", "priority", "pos"], [(*r, i) for i, r in enumerate(X.PRIORITY_RULES)])


@query("priority_resolve", f"with {_PAGES}, {_PRIO}, {X.values('s', ['source_id', 'sp'], X.SOURCE_PRIORITY)}, best as (select * from (select key, priority, row_number() over (partition by key order by length(path_pattern) desc, pos) as rn from pages join p {_MATCH}) where rn = 1) "
       "select c.id as key, coalesce(s.sp, best.priority, 2) as priority from contents c left join s using (source_id) left join best on best.key = c.id where c.url is not null")
def priority_resolve(spark, d):
    """Source map, then host and path rules, then normal."""
    rules = spark.createDataFrame([(*r, i) for i, r in enumerate(X.PRIORITY_RULES)], "host_pattern string, path_pattern string, priority int, pos int")
    best = R.best_rule(_pages(spark, d), rules, F.desc("_len"), F.asc("pos"), keep=["priority"])
    by_source = spark.createDataFrame(X.SOURCE_PRIORITY, "source_id string, sp int")
    c = table(spark, d, "contents").select(F.col("id").alias("key"), "source_id")
    return best.join(c, "key").join(by_source, "source_id", "left").select("key", F.coalesce("sp", "priority", F.lit(2)).alias("priority"))


@query("has_any_rule", f"with {X.values('r', X.RULE_COLUMNS, X.PARSER_RULES)} select host_pattern, count(*) > 0 as any_rule, coalesce(bool_or(enabled), false) as any_enabled from r group by 1")
def has_any_rule(spark, d):
    return R.has_any_rule(X.parser_rules(spark))


@query("regeneration_gate", f"with {X.values('r', X.RULE_COLUMNS, X.PARSER_RULES)}, a as (select host_pattern as host, bool_or(enabled) as e from r group by 1), h as (select distinct {_HOST} as host from contents) "
       "select host, coalesce(e, true) as enqueue from h left join a using (host)")
def regeneration_gate(spark, d):
    """A host is learnt again unless it has rules and all of them are disabled."""
    hosts = _pages(spark, d).select("host").distinct()
    have = R.has_any_rule(X.parser_rules(spark)).withColumnRenamed("host_pattern", "host")
    return hosts.join(have, "host", "left").select("host", F.coalesce("any_enabled", F.lit(True)).alias("enqueue"))


@query("next_version", f"with {X.values('r', X.RULE_COLUMNS, X.PARSER_RULES)} select host_pattern, path_pattern, target_type, coalesce(max(version), 0) + 1 as next_version from r group by all")
def next_version(spark, d):
    return R.next_versions(X.parser_rules(spark))


@query("fetcher_by_host", f"with f as (select distinct lower(regexp_extract(base_url, '//([^/]*)', 1)) as host, requests_per_hour from sources), h as (select id, {_HOST} as host from contents) "
       "select h.id, coalesce(f.requests_per_hour, 0)::int as rph from h left join f using (host)")
def fetcher_by_host(spark, d):
    f = table(spark, d, "sources").select(U.url_hostname(F.col("base_url")).alias("host"), "requests_per_hour").distinct()
    h = table(spark, d, "contents").select("id", U.url_hostname(F.col("url")).alias("host"))
    return h.join(f, "host", "left").select("id", F.coalesce("requests_per_hour", F.lit(0)).alias("rph"))


QUERIES, SQL = query.queries, query.sql
