"""Queries over pages, path inference and enrichment results."""

from __future__ import annotations

from pyspark.sql import functions as F

from harrowmill.functions import datetimes as D
from harrowmill.functions import urls as U
from harrowmill.operators import enrich as E
from harrowmill.operators import html as H
from harrowmill.operators import inference as I
from harrowmill.operators.rules import best_rule
from harrowmill.plans import fixtures as X
from harrowmill.plans.reading import _PATH
from harrowmill.plans.registry import Registry
from harrowmill.sources.tables import table

query = Registry()

#: Layouts of the test sites: fields by CSS selector, and for lists of links container and title.
LAYOUTS = {
    "marked": {"title": "article h1", "main_content": "main article p", "author": ".byline", "category": "nav li:first-child a", "tags": "nav li a", "images": "img"},
    "columns": {"title": "h2.tit", "main_content": "div.ctn div div", "author": ".byline", "tags": "div.inner a", "images": "img"},
    "styled": {"title": "h1.css-h", "main_content": "div.css-z9 p", "author": ".byline", "tags": "span.css-a1 a", "images": "img"},
    "tables": {"title": "td h1", "main_content": "td p", "author": ".byline", "images": "img"},
    "plain": {"title": "h3", "main_content": "body", "images": "img"},
    "bare": {"title": "h1", "main_content": "p"},
}
LISTS = {"marked": ("aside li", "a"), "columns": ("div.rcol div.it", "a"), "styled": ("section a", ""), "tables": ("td", "a"), "plain": ("ol li", "a")}
#: Layout of each source; others are tried with the first one.
LAYOUT_OF = {
    "columns": ["Bexholm Policy", "Kelpgate Herald", "Kupferau Blatt", "Lacourvelle Echo", "Tarnwick Dispatch"],
    "styled": ["Faro de Almedra", "Gallowmere Notes", "Haddlecombe Forum", "Pontargue Info", "Quillhaven Post"],
    "tables": ["Mirabrook Wire", "Onbyeol Daily", "Porchside Board", "Trellis Talk"],
    "plain": ["Dorrimoor Times", "Narumaru Square", "Saetgol Ilgi", "Velada de Sotomar"],
    "bare": ["Yeoul Market"],
}


def _raw(spark, d):
    return table(spark, d, "raw_contents").select("id", "url", "html").filter("html is not null")


def _layouts(spark, d):
    """Hosts of all sources with their layout."""
    known = spark.createDataFrame([(n, k) for k, names in LAYOUT_OF.items() for n in names], "name string, layout string")
    s = table(spark, d, "sources").select("name", U.url_hostname(F.col("base_url")).alias("host_pattern"))
    return s.join(known, "name", "left").select("host_pattern", F.coalesce("layout", F.lit("marked")).alias("layout"))


def _page_rules(spark, d):
    rules = [(k, {f: (css, "src" if f == "images" else None, f == "main_content") for f, css in fields.items()}) for k, fields in LAYOUTS.items()]
    selectors = spark.createDataFrame(rules, f"layout string, selectors {H.SELECTORS}")
    return _layouts(spark, d).join(selectors, "layout").select("host_pattern", F.lit("").alias("path_pattern"), "selectors", F.lit(True).alias("article"))


def _extracted(spark, d):
    """Every page with the fields of the rule that its host and path resolve to."""
    host, path = U.lookup_host_path(F.col("url"))
    pages = _raw(spark, d).select(F.col("id").alias("key"), "url", "html", host.alias("host"), path.alias("path"))
    ruled = best_rule(pages, _page_rules(spark, d), F.desc("_len"), keep=["selectors", "article"])
    return H.extract_pages(ruled.withColumnRenamed("key", "id"))


@query("page_extract")
def page_extract(spark, d):
    p = _extracted(spark, d)
    return p.select("id", "title", F.length("body").alias("n_chars"), "author", "category", F.size("tags").alias("tags"), F.size("images").alias("images"), "published_at", "article", "error")


@query("adhoc_extract")
def adhoc_extract(spark, d):
    """Selectors given with the request instead of by rule."""
    selectors = F.create_map(*[x for f, css in (("title", "h1, h2, h3"), ("main_content", "p, div"), ("author", ".byline")) for x in (F.lit(f), F.struct(F.lit(css).alias("css"), F.lit(None).cast("string").alias("attribute"), F.lit(f == "main_content").alias("multi")))])
    p = H.extract_pages(_raw(spark, d).select("id", "html", selectors.alias("selectors"), F.lit(False).alias("article")))
    return p.select("id", F.md5("title").alias("title_md5"), F.md5("body").alias("body_md5"), "error")


@query("validator_preview")
def validator_preview(spark, d):
    links = H.list_items(_listed(spark, d)).filter("error is null").groupBy("id").agg(F.array_sort(F.collect_list(F.struct("pos", "url"))).alias("l"))
    p = _extracted(spark, d).join(links, "id", "left")
    return H.previews(p.select("id", "title", "body", F.transform("l", lambda x: x["url"]).alias("links"), "error"))


def _listed(spark, d):
    lists = spark.createDataFrame([(k, c, t) for k, (c, t) in LISTS.items()], "layout string, container_css string, title_css string")
    rules = _layouts(spark, d).join(lists, "layout").withColumn("link_css", F.lit("a[href]"))
    return _raw(spark, d).withColumn("host_pattern", U.url_hostname(F.col("url"))).join(rules, "host_pattern", "left").withColumn("snippet_css", F.lit("p"))


@query("list_parse")
def list_parse(spark, d):
    """Links of list pages by container, one error row for pages without any."""
    return H.list_items(_listed(spark, d)).groupBy("id").agg(F.count("url").alias("n"), F.min("error").alias("error"), F.min("url").alias("first_url"))


_HREFS = r"""hrefs as (select id, unnest(regexp_extract_all(regexp_replace(html, '(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->', '', 'g'), '(?i)<a\s+(?:class="[^"]*"\s+)?href\s*=\s*["'']?([^"''\s>]*)', 1)) as href from raw_contents where html is not null)"""


@query("link_extract", f"with {_HREFS.replace(chr(92) * 2, chr(92))} select id, count(*) filter (href <> '') as n, count(*) filter (starts_with(href, '/p/')) as stories, min(href) filter (href <> '') as first_href from hrefs group by 1")
def link_extract(spark, d):
    each = H.page_anchors(_raw(spark, d)).select("id", F.explode("anchors").alias("a")).select("id", "a.href").filter("href <> ''")
    return each.groupBy("id").agg(F.count("*").alias("n"), F.count_if(F.col("href").startswith("/p/")).alias("stories"), F.min("href").alias("first_href"))


@query("link_unique")
def link_unique(spark, d):
    return H.distinct_links(H.page_links(_raw(spark, d)), 200).groupBy("id").agg(F.count("*").alias("n"))


@query("link_discover")
def link_discover(spark, d):
    """Stories of the page's own site by pattern, without excluded parts, in the seeded order; pages without any fail."""
    raw = _raw(spark, d)
    found = H.discovered_links(H.page_links(raw), pattern=r"^https?://[^/]+/[a-z]+", excludes=("/sports/", "login"), prefixes=("/p/", "/politics", "/culture"), most=20)
    n = found.groupBy("id").agg(F.count("*").alias("n"), F.count_if("same_host").alias("own"))
    out = raw.select("id").join(n, "id", "left")
    return out.select("id", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("own", F.lit(0)).alias("own"), F.when(F.col("n").isNull(), "parse_failure").alias("error"))


@query("index_only")
def index_only(spark, d):
    raw = _raw(spark, d)
    c = X.contents(spark, d).select("url", "body", "published_s").dropDuplicates(["url"])
    return H.index_only(raw.select("id", "url").join(c, "url").drop("url"), H.anchor_figures(raw))


@query("selector_confidence")
def selector_confidence(spark, d):
    hits = H.selector_hits(_raw(spark, d), {"title": ("h1", None), "canonical": ("link[rel=canonical]", "href"), "main": ("article p", None), "published_at": ("time, meta[name=date], p", None)})
    return hits.select(F.explode("hits").alias("name", "hit")).groupBy("name").agg(F.round(F.avg("hit"), 6).alias("hit_rate"), F.count("*").alias("pages"))


@query("confidence_filter", "select source_id as name, hit_rate from (select source_id, avg((coalesce(author, '') <> '')::int) as hit_rate from contents where category is not null group by 1) where hit_rate >= 0.5 "
       "union all select source_id, null from sources where source_id not in (select source_id from contents where category is not null and source_id is not null)")
def confidence_filter(spark, d):
    """Hit rate of the author field per source; sources never measured keep their selector."""
    c = table(spark, d, "contents").filter("category is not null").groupBy("source_id").agg(F.avg((F.coalesce("author", F.lit("")) != "").cast("int")).alias("hit_rate"))
    every = table(spark, d, "sources").select("source_id").join(c, "source_id", "left")
    return H.confident(every.select(F.col("source_id").alias("name"), "hit_rate"))


@query("date_parse", "select id, epoch(strptime(published_at, '%Y-%m-%dT%H:%M:%SZ'))::bigint * 1000 as ms from contents where regexp_matches(published_at, '^\\d{4}-\\d{2}-\\d{2}T\\d{2}:\\d{2}:\\d{2}Z$') and published_at not like '0001%' "
       "union all select id, epoch_ms(strptime(published_at, '%Y-%m-%dT%H:%M:%S')) from contents where regexp_matches(published_at, '^\\d{4}-\\d{2}-\\d{2}T\\d{2}:\\d{2}:\\d{2}$')")
def date_parse(spark, d):
    c = table(spark, d, "contents").filter(F.col("published_at").rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}Z?$") & ~F.col("published_at").startswith("0001")).withColumn("p", D.notation_parts(F.col("published_at")))
    return c.select("id", D.local_epoch_ms(F.col("p"), F.lit(False)).alias("ms"))


@query("path_segments", f"select id, len(list_filter(string_split(trim({_PATH}, '/'), '/'), lambda x: x <> ''))::int as n from contents where url is not null")
def path_segments(spark, d):
    return table(spark, d, "contents").filter("url is not null").select("id", F.size(I.segments(U.url_path(F.col("url")))).alias("n"))


@query("path_infer", f"with s as (select source_id as rule_id, string_split(trim({_PATH}, '/'), '/') as seg from contents where url is not null), ok as (select rule_id from s group by 1 having count(*) >= 3 and min(len(seg)) = max(len(seg))), "
       "e as (select rule_id, unnest(range(len(seg))) as pos, unnest(seg) as v from s where rule_id in (select rule_id from ok)), "
       "k as (select rule_id, pos, case when min(v) = max(v) then min(v) when bool_and(regexp_matches(v, '^(19|20)[0-9]{2}$')) then '((19|20)\\d{2})' when bool_and(regexp_matches(v, '^(0[1-9]|1[0-2])$')) then '(0[1-9]|1[0-2])' when bool_and(regexp_matches(v, '^[0-9]+$')) then '(\\d+)' "
       "when bool_and(regexp_matches(v, '^[a-z0-9-]+$') and length(v) >= 4 and contains(v, '-')) then '([a-z0-9-]+)' end as part from e group by all) select rule_id, '^/' || string_agg(part, '/' order by pos) || '$' as pattern from k group by 1 having bool_and(part is not null)")
def path_infer(spark, d):
    return I.infer_patterns(table(spark, d, "contents").filter("url is not null").select(F.col("source_id").alias("rule_id"), U.url_path(F.col("url")).alias("path")))


@query("path_infer_category", f"with s as (select source_id || ':' || category as rule_id, string_split(trim({_PATH}, '/'), '/') as seg from contents where url is not null and category is not null and category = regexp_extract({_PATH}, '^/([a-z]+)/', 1)), ok as (select rule_id from s group by 1 having count(*) >= 3 and min(len(seg)) = max(len(seg))), "
       "e as (select rule_id, unnest(range(len(seg))) as pos, unnest(seg) as v from s where rule_id in (select rule_id from ok)), "
       "k as (select rule_id, pos, case when min(v) = max(v) then min(v) when bool_and(regexp_matches(v, '^[a-z0-9-]+$') and length(v) >= 4 and contains(v, '-')) then '([a-z0-9-]+)' end as part from e group by all) select rule_id, '^/' || string_agg(part, '/' order by pos) || '$' as pattern from k group by 1 having bool_and(part is not null)")
def path_infer_category(spark, d):
    path = U.url_path(F.col("url"))
    c = table(spark, d, "contents").filter(F.col("url").isNotNull() & (F.col("category") == F.regexp_extract(path, "^/([a-z]+)/", 1)))
    return I.infer_patterns(c.select(F.concat_ws(":", "source_id", "category").alias("rule_id"), path.alias("path")))


_RULE_SAMPLES = f"s as (select source_id || ':' || category as rule_id, {_PATH} as path, list_filter(string_split({_PATH}, '/'), lambda x: x <> '') as seg from contents where url is not null and category is not null)"
_CANDIDATES = "cand as (select distinct rule_id, unnest(['^/[a-z]+/[a-z0-9-]+$', '^/' || split_part(rule_id, ':', 2) || '/[a-z0-9-]+$', '^/' || split_part(rule_id, ':', 2) || '/', '^/[a-z]+$']) as pattern from s)"


@query("broadness_check", f"with {_RULE_SAMPLES}, {_CANDIDATES}, k as (select rule_id, count(*) as n, min(path) as path, min(len(seg)) as a, max(len(seg)) as b from s group by 1), "
       "e as (select rule_id, unnest(seg) as v, unnest(range(1, len(seg) + 1)) as pos from s), f as (select e.rule_id, pos from e join k using (rule_id) where n > 1 group by e.rule_id, pos, n having count(distinct v) = 1 and count(*) = n), "
       "base as (select *, list_filter(string_split(path, '/'), lambda x: x <> '') as seg from k where a = b and a > 0), "
       "probes as (select rule_id, '/zzprobe/' || array_to_string(seg, '/') as probe from base union all select rule_id, '/' || array_to_string(seg, '/') || '/zzprobe' from base "
       "union all select rule_id, '/' || array_to_string(seg[2:], '/') from base where a > 1 union all select rule_id, '/' || array_to_string(seg[:-2], '/') from base where a > 1 "
       "union all select rule_id, '/' || array_to_string(list_transform(seg, lambda v, i: case when i = f.pos then w else v end), '/') from base join f using (rule_id), (values ('zzprobe'), ('QQQQQQ'), ('some-other-place')) t(w)) "
       "select rule_id, pattern, coalesce(bool_or(regexp_matches(probe, pattern)), false) as broad from cand left join (select p.* from probes p join k using (rule_id) where probe <> path) using (rule_id) group by all")
def broadness_check(spark, d):
    """Four candidate patterns for the paths of each category of each source."""
    c = table(spark, d, "contents").filter("url is not null and category is not null").select(F.concat_ws(":", "source_id", "category").alias("rule_id"), "category", U.url_path(F.col("url")).alias("path"))
    own = F.concat(F.lit("^/"), F.col("category"))
    tried = F.array(F.lit("^/[a-z]+/[a-z0-9-]+$"), F.concat(own, F.lit("/[a-z0-9-]+$")), F.concat(own, F.lit("/")), F.lit("^/[a-z]+$"))
    patterns = c.select("rule_id", F.explode(tried).alias("pattern")).distinct().withColumn("key", F.concat_ws("|", "rule_id", "pattern"))
    samples = c.join(patterns.select("rule_id", "key"), "rule_id").select(F.col("key").alias("rule_id"), "path")
    broad = I.broad_patterns(patterns.select(F.col("key").alias("rule_id"), "pattern"), samples)
    return broad.select(F.substring_index("rule_id", "|", 1).alias("rule_id"), F.expr("substring(rule_id, instr(rule_id, '|') + 1)").alias("pattern"), "broad")


@query("refiner_cycle")
def refiner_cycle(spark, d):
    """Catch-all rules of each source and category refined from the paths seen."""
    c = table(spark, d, "contents").filter("url is not null and category is not null").select(F.concat_ws(":", "source_id", "category").alias("rule_id"), U.url_hostname(F.col("url")).alias("host_pattern"), U.url_path(F.col("url")).alias("path"))
    rules = c.groupBy("rule_id").agg(F.min("host_pattern").alias("host_pattern")).select(
        "rule_id", "host_pattern", F.lit("").alias("path_pattern"), F.lit("page").alias("target_type"), F.lit(1).alias("version"), F.lit(True).alias("enabled"), F.lit("auto").alias("origin"))
    return I.refine_rules(rules, c.select("rule_id", "path"))[0]


_OUT = "outs as (select claim_id, '```json' || chr(10) || '{{\"trust_score\": ' || (claim_id % 13) / 10.0 || ', \"rationale\": \"' || case when claim_id % 7 = 0 then ' ' else 'ok' end || '\"}}' || chr(10) || '```' as o from claims)"


def _outputs(spark, d):
    c = table(spark, d, "claims").select("claim_id")
    why = F.when(F.col("claim_id") % 7 == 0, " ").otherwise("ok")
    text = F.concat(F.lit('```json\n{"trust_score": '), (F.col("claim_id") % 13 / 10.0).cast("string"), F.lit(', "rationale": "'), why, F.lit('"}\n```'))
    return c.withColumn("o", text)


@query("fence_strip", "select claim_id, '{\"trust_score\": ' || ((claim_id % 13) / 10.0::double)::varchar || ', \"rationale\": \"' || case when claim_id % 7 = 0 then ' ' else 'ok' end || '\"}' as body from claims")
def fence_strip(spark, d):
    return _outputs(spark, d).select("claim_id", E.strip_fences(F.col("o")).alias("body"))


@query("score_parse", "select claim_id, case when claim_id % 7 = 0 then null when claim_id % 13 > 10 then null else (claim_id % 13) / 10.0::double end as trust_score, case when claim_id % 7 = 0 then 'missing rationale' when claim_id % 13 > 10 then 'out of range' end as error from claims")
def score_parse(spark, d):
    return _outputs(spark, d).withColumn("s", E.parse_score(F.col("o"))).select("claim_id", F.col("s.trust_score").alias("trust_score"), F.col("s.error").alias("error"))


_VERDICT = "case claim_id % 4 when 0 then 'supported' when 1 then 'contradicted' else 'unverified' end"


def _verified(spark, d):
    c = table(spark, d, "claims").select("claim_id", "content_id", "claim_idx")
    said = F.when(F.col("claim_id") % 4 == 0, "supported").when(F.col("claim_id") % 4 == 1, "contradicted").when(F.col("claim_id") % 4 == 2, "unverified").otherwise("TRUE!")
    text = F.concat(F.lit('{"verifications": [{"claim_idx": '), F.col("claim_idx").cast("string"), F.lit(', "verdict": "'), said, F.lit('"}]}'))
    return c.select("claim_id", "content_id", "claim_idx", F.explode(E.parse_verdicts(text)).alias("v"))


@query("verdict_normalize", f"select {_VERDICT} as verdict, count(*) as n from claims group by 1")
def verdict_normalize(spark, d):
    return _verified(spark, d).groupBy(F.col("v.verdict").alias("verdict")).agg(F.count("*").alias("n"))


@query("claim_verdict_join", f"select claim_id, claim_idx, {_VERDICT} as verdict from claims")
def claim_verdict_join(spark, d):
    v = _verified(spark, d)
    return v.filter(F.col("v.claim_idx") == F.col("claim_idx")).select("claim_id", "claim_idx", F.col("v.verdict").alias("verdict"))


@query("trust_factors", f"select content_id, round(avg((claim_id % 4 = 0)::int::double), 6) as supported, count(distinct source_id) as domains from claims join contents c on c.id = content_id group by 1")
def trust_factors(spark, d):
    c = table(spark, d, "contents").select(F.col("id").alias("content_id"), F.col("source_id").alias("domain"))
    v = _verified(spark, d).select("content_id", F.col("v.verdict").alias("verdict")).join(c, "content_id")
    return E.trust_factors(v)


@query("extract_defaults", "select claim_id, case when claim_id % 3 = 0 then 'positive' else 'neutral' end as sentiment, 0 as entities, case when claim_id % 2 = 0 then 'a,b' else '' end as topics from claims")
def extract_defaults(spark, d):
    mood = F.when(F.col("claim_id") % 3 == 0, F.lit(', "sentiment": "positive"')).otherwise(F.lit(""))
    topics = F.when(F.col("claim_id") % 2 == 0, F.lit('"topics": ["a", "b"]')).otherwise(F.lit('"topics": null'))
    f = table(spark, d, "claims").select("claim_id", E.parse_facts(F.concat(F.lit("{"), topics, mood, F.lit("}"))).alias("f"))
    return f.select("claim_id", "f.sentiment", "f.entities", F.array_join("f.topics", ",").alias("topics"))


@query("empty_json", "select id, extra is null or trim(extra) in ('', '{}', '[]', 'null') as empty from contents")
def empty_json(spark, d):
    return table(spark, d, "contents").select("id", E.is_empty_json(F.col("extra")).alias("empty"))


@query("entry_metadata", "select id, coalesce(json_extract_string(metadata, '$.target_type'), 'article') as target_type, coalesce(try_cast(json_extract_string(metadata, '$.max_results') as int), 10) as max_results from raw_contents")
def entry_metadata(spark, d):
    m = F.from_json("metadata", "target_type string, max_results int")
    return table(spark, d, "raw_contents").select("id", F.coalesce(m["target_type"], F.lit("article")).alias("target_type"), F.coalesce(m["max_results"], F.lit(10)).alias("max_results"))


@query("header_propagate", "select id, coalesce(map_extract_value(headers, 'server'), '') as server, 'text/plain' as content_type, (1 + len(list_filter(['server', 'last-modified'], lambda k: coalesce(map_extract_value(headers, k), '') <> '')))::int as n from raw_contents where len(map_keys(headers)) > 1")
def header_propagate(spark, d):
    r = table(spark, d, "raw_contents").filter(F.size("headers") > 1)
    out = E.propagate_headers(F.col("headers"), F.map_from_arrays(F.array(F.lit("content-type")), F.array(F.lit("text/plain"))), ["server", "content-type", "last-modified"])
    return r.select("id", F.coalesce(out["server"], F.lit("")).alias("server"), out["content-type"].alias("content_type"), F.size(out).alias("n"))


@query("first_object", "select claim_id, '{\"a\": \"' || replace(replace(coalesce(text, ''), '\\', '\\\\'), '\"', '\\\"') || '} {\", \"b\": {\"c\": 1}}' as body from claims")
def first_object(spark, d):
    """Objects whose strings hold braces and quotes, between prose and a second object."""
    quoted = F.replace(F.replace(F.coalesce("text", F.lit("")), F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    said = F.concat(F.lit('Here it is: {"a": "'), quoted, F.lit('} {", "b": {"c": 1}} and {"not": "this"}'))
    return table(spark, d, "claims").select("claim_id", E.first_object(said).alias("body"))


@query("enriched_parse", "select claim_id, case claim_id % 4 when 0 then 'blacklist' when 1 then 'ok' when 2 then 'legacy' end as kind, case claim_id % 4 when 1 then case when predicate is null then 'other' else 'list' end end as page_type, "
       "case when claim_id % 4 = 0 then case when claim_id % 8 = 0 then 'spam' else '(no reason provided)' end end as reason, case when claim_id % 4 = 0 then case when claim_id % 3 = 0 then 'extract_links_only' else 'drop' end end as mode, case when claim_id % 4 = 3 then 'unknown validity' end as error, "
       "case when claim_id % 4 in (1, 2) then 'h1' end as title_css from claims")
def enriched_parse(spark, d):
    n = F.col("claim_id")
    black = F.concat(F.lit('{"validity": "blacklist", "blacklist_reason": "'), F.when(n % 8 == 0, " spam ").otherwise(" "), F.lit('", "blacklist_mode": "'), F.when(n % 3 == 0, "Extract_Links_Only").otherwise("hide"), F.lit('"}'))
    ok = F.concat(F.lit('{"validity": "ok", "page_type": "'), F.when(F.col("predicate").isNull(), "poem").otherwise(" LIST "), F.lit('", "selectors": {"title": {"css": "h1"}}}'))
    said = F.when(n % 4 == 0, black).when(n % 4 == 1, ok).when(n % 4 == 2, F.lit('{"title": {"css": "h1"}}')).otherwise(F.lit('{"validity": "maybe"}'))
    p = table(spark, d, "claims").select("claim_id", "predicate", E.parse_enriched(F.concat(F.lit("```json\n"), said, F.lit("\n```"))).alias("p"))
    return p.select("claim_id", "p.kind", "p.page_type", "p.reason", "p.mode", "p.error", F.col("p.selectors")["title"]["css"].alias("title_css"))


@query("prompt_render", "select id, 'Title: ' || coalesce(title, '') || ' (' || coalesce(language, '') || ')' as prompt from contents")
def prompt_render(spark, d):
    return table(spark, d, "contents").select("id", E.render("Title: {title} ({language})", {"title": F.col("title"), "language": F.col("language")}).alias("prompt"))


@query("classify_batch", "select source_id, (epoch_us(created_at) // 86400000000)::bigint as day, count(*) as total, string_agg(substr(coalesce(title, ''), 1, 20), '|' order by id) as previews from contents group by 1, 2")
def classify_batch(spark, d):
    """One envelope per source and day of arrival, so that no envelope grows with the archive."""
    day = F.floor(F.unix_seconds("created_at") / 86400).alias("day")
    c = table(spark, d, "contents").groupBy("source_id", day).agg(F.count("*").alias("total"), F.array_sort(F.collect_list(F.struct("id", F.substring(F.coalesce("title", F.lit("")), 1, 20).alias("p")))).alias("l"))
    return c.select("source_id", "day", "total", F.array_join(F.transform("l", lambda x: x["p"]), "|").alias("previews"))


@query("enrich_cascade", "with e as (select content_id, count(*) as n from entities group by 1), c as (select content_id, count(*) as n from claims where claim_idx > 0 group by 1), s as (select content_id, (min(claim_id) % 10) / 10.0::double as v from claims where predicate is not null group by 1) "
       "select id, e.n as entities, c.n as more_claims, s.v as trust_score from contents join s on s.content_id = id left join e on e.content_id = id left join c on c.content_id = id")
def enrich_cascade(spark, d):
    """Stages whose output may be missing; only records that got a score are stored."""
    e = table(spark, d, "entities").groupBy("content_id").agg(F.count("*").alias("value"))
    k = table(spark, d, "claims")
    c = k.filter("claim_idx > 0").groupBy("content_id").agg(F.count("*").alias("value"))
    s = k.filter("predicate is not null").groupBy("content_id").agg((F.min("claim_id") % 10 / 10.0).alias("value"))
    base = table(spark, d, "contents").select(F.col("id").alias("content_id"))
    out = E.to_persist(E.cascade(base, [("entities", e), ("more_claims", c), ("trust_score", s)]))
    return out.select(F.col("content_id").alias("id"), "entities", "more_claims", "trust_score")


QUERIES, SQL = query.queries, query.sql
