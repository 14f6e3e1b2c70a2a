"""Expected values of the behaviour the operators stand in for."""

import pytest
from pyspark.sql import functions as F

from harrowmill.functions import markup as MK
from harrowmill.operators import enrich as E, folds, html as H, inference as I, publish as Pb, queueing as Q, rules as R, store as St, validate as V, windows as Wn
from harrowmill.sources import connectors as C

RECORD = "id string, source_type string, title string, body string, summary string, author string, category string, tags array<string>, url string, word_count int, published_s bigint, article boolean"


def record(spark, **kw):
    base = dict(id="1", source_type="news", title="Breaking News: Major Event Occurs in Capital City", body="This is a test article body sentence. " * 10, summary="s", author="a", category="c", tags=["x", "y"], url="https://e.example/1", word_count=80, published_s=1, article=True)
    base.update(kw)
    return spark.createDataFrame([tuple(base[c.split()[0]] for c in RECORD.split(", "))], RECORD)


def rules_of(df, article=True):
    row = V.validated(df, F.col("article") if article else None).first()
    return [e.rule for e in row.errors], round(row.quality, 2), row.code


@pytest.mark.parametrize("change, rules", [
    ({}, []), ({"title": "Short"}, ["min_length"]), ({"title": "a" * 501}, ["max_length"]), ({"body": "Too short."}, ["min_length"]), ({"body": "word " * 10001}, ["max_length"]), ({"published_s": None}, ["required"]),
    ({"published_s": None, "article": False}, []), ({"title": "BREAKING NEWS IN THE CAPITAL", "body": "THIS IS AN UPPERCASE BODY SENTENCE. " * 10}, ["spam_caps"]),
    ({"source_type": "community", "body": "This is a community post with some discussion. " * 5}, []), ({"source_type": "community", "body": "짧음"}, ["min_length"]),
    ({"source_type": "community", "body": "ㅋ" * 50 + " " + "ㅋ" * 50}, ["spam_flood"]), ({"source_type": "community", "body": "ㅋㅋㅋ content is fine here. " * 5, "published_s": None}, []),
])
def test_validation(spark, change, rules):
    assert rules_of(record(spark, **change))[0] == rules


def test_quality_of_valid_news(spark):
    assert rules_of(record(spark))[1:] == (0.72, None)


def test_null_record(spark):
    found, _, code = rules_of(record(spark, title=None, body=None, tags=None, url=None, word_count=None, source_type=None))
    assert found[0] == "min_length" and code == "VAL_003"


@pytest.mark.parametrize("paths, pattern", [
    (["/article/12345", "/article/67890", "/article/120394"], r"^/article/(\d+)$"), (["/news/breaking-story-2024", "/news/special-coverage-update", "/news/world-economy-report"], "^/news/([a-z0-9-]+)$"),
    (["/news/2024/04/12345", "/news/2023/12/67890", "/news/2025/01/55555"], r"^/news/((19|20)\d{2})/(0[1-9]|1[0-2])/(\d+)$"), (["/category/sports/article/1", "/category/sports/article/200", "/category/sports/article/9999"], r"^/category/sports/article/(\d+)$"),
    (["/a/1", "/a/2"], None), (["/a/1", "/a/2/3", "/a/4"], None), (["/12345", "/abc", "/world"], None),
])
def test_path_inference(spark, paths, pattern):
    got = [r.pattern for r in I.infer_patterns(spark.createDataFrame([(1, p) for p in paths], "rule_id int, path string")).collect()]
    assert got == ([pattern] if pattern else [])


PAGE = """<html><body><h1 class="hl big"> Breaking News Today </h1><div class="byline"><b>Reporter Kim</b></div><article><p>First paragraph of the body.<p>Second paragraph with <b>more detail.
</article><ul class=tags><li><a href="/t/politics">politics</a><li><a href='https://other.example/x#f'>x</a></ul><a href="mailto:a@b">m</a><a href="/the,">t</a><script>var a="</p>";</script></body></html>"""


def test_selectors():
    root = MK.parse(PAGE)
    assert MK.single(root, "h1.hl.big") == "Breaking News Today" and MK.single(root, "div.byline > b") == "Reporter Kim"
    assert MK.single(root, "article p", multi=True).split("\n")[0] == "First paragraph of the body."
    assert len(MK.select(root, "article p, ul.tags li")) == 4 and MK.single(root, "ul.tags li:first-child a", "href") == "/t/politics"
    assert MK.select(root, "p::before(") == [] and MK.parse(None).text() == ""


def test_links_and_index_only(spark):
    pages = spark.createDataFrame([("1", "https://s.example/list", PAGE), ("2", "https://s.example/", None)], "id string, url string, html string").filter("html is not null")
    links = H.page_links(pages)
    assert [r.url for r in links.orderBy("pos").collect()] == ["https://s.example/t/politics", "https://other.example/x", "https://s.example/the,"]
    assert H.capped_links(links, 2).count() == 2 and H.capped_links(links, 0).count() == 3 and H.distinct_links(links, 1).count() == 1
    many = "<body>" + "".join(f'<a href="/n/{i}">정치 뉴스 {i}</a>' for i in range(6)) + "</body>"
    p = spark.createDataFrame([("1", "https://s.example/list", many)], "id string, url string, html string")
    r = spark.createDataFrame([("1", "정치 뉴스", None)], "id string, body string, published_s bigint")
    assert H.index_only(r, H.anchor_figures(p)).first().index_only
    assert not H.index_only(r.withColumn("published_s", F.lit(1)), H.anchor_figures(p)).first().index_only


def sel(**css):
    return {k: (v, "src" if k == "images" else None, k == "main_content") for k, v in css.items()}


def test_extract(spark):
    page = PAGE.replace("</body>", "<ul class=t><li>one</li><li> </li><li>two</li></ul><img src=/a.png><img></body>")
    rules = [("1", sel(title="h1.hl", main_content="article p", author="div.byline", tags=".t li", images="img")), ("2", sel(title="h9", main_content="article p")), ("3", sel(title="h1.hl")), ("4", None)]
    p = spark.createDataFrame([(i, page, r, True, "clash") for i, r in rules], f"id string, html string, selectors {H.SELECTORS}, article boolean, error string")
    got = H.extract_pages(p).orderBy("id").collect()
    assert (got[0].title, got[0].author, got[0].tags, got[0].images, got[0].error) == ("Breaking News Today", "Reporter Kim", ["one", "two"], ["/a.png"], None)
    assert [r.error for r in got[1:]] == ["parse_failure", "empty_selector", "no_rule"] and got[1].tags is None
    assert H.extract_pages(p.limit(0)).count() == 0


def test_list_pages(spark):
    page = "<div class=i><a href='/n/1#x'>One</a><p>first</p></div><div class=i>no link</div><div class=i><a href=https://o.example/2>Two</a></div>"
    schema = "id string, url string, html string, container_css string, link_css string, title_css string, snippet_css string"
    rows = [("1", "https://s.example/l", page, ".i", "a[href]", "a", "p"), ("2", "https://s.example/l", page, ".none", "a[href]", "a", "p"), ("3", "https://s.example/l", page, ".i", "b", "a", "p"), ("4", None, page, None, None, None, None)]
    got = H.list_items(spark.createDataFrame(rows, schema)).orderBy("id", "pos").collect()
    assert [(r.id, r.url, r.title, r.snippet, r.error) for r in got] == [
        ("1", "https://s.example/n/1", "One", "first", None), ("1", "https://o.example/2", "Two", "", None), ("2", None, None, None, "no_container"), ("3", None, None, None, "no_link"), ("4", None, None, None, "no_rule")]


def test_links_and_anchor_figures(spark):
    page = "<body>12345 <a href='/a'>abcde</a> <a href='#x'>skip</a> <a href='//S.example/b'>fg</a> <a href='https://o.example/c'>other</a> <a href='mailto:x@y'>m</a> <a href='/'>root</a></body>"
    p = spark.createDataFrame([("1", "https://s.example/x", page), ("2", None, None)], "id string, url string, html string")
    a, b = H.anchor_figures(p).orderBy("id").collect()
    assert (a.article_links, round(a.link_ratio, 6), b.link_ratio, b.article_links) == (2, round(11 / 32, 6), 0.0, 0)
    found = H.discovered_links(H.page_links(p), pattern="^https://", excludes=("/b",), prefixes=("/a", "/b"))
    assert [r.url for r in found.collect()] == ["https://s.example/a"]


def test_selector_hits_ask_for_dates(spark):
    p = spark.createDataFrame([("1", "<time>2024-01-02T03:04:05Z</time>"), ("2", "<time>soon</time>"), ("3", "")], "id string, html string")
    got = {r.id: r.hits for r in H.selector_hits(p, {"published_at": ("time", None), "title": ("h1", None)}).collect()}
    assert got == {"1": {"published_at": 1.0, "title": 0.0}, "2": {"published_at": 0.0, "title": 0.0}, "3": {"published_at": 0.0, "title": 0.0}}


@pytest.mark.parametrize("pattern, paths, broad", [
    (r"^/[a-zA-Z]+/\d+$", ["/article/1", "/article/22", "/article/3"], True), (r"^/article/\d+$", ["/article/1", "/article/22", "/article/3"], False),
    (r"^/article/\d+(/.+)?$", ["/article/1", "/article/2"], True), (r"^(/lang)?/article/\d+$", ["/lang/article/1"], True), (r"^/a", ["/a", "/b/c"], False), ("([", ["/a"], True), (r"^/\d+$", ["/1"], False),
])
def test_broad_patterns(spark, pattern, paths, broad):
    got = I.broad_patterns(spark.createDataFrame([("r", pattern)], "rule_id string, pattern string"), spark.createDataFrame([("r", p) for p in paths], "rule_id string, path string"))
    assert got.first().broad is broad


def test_refiner_cycle(spark):
    schema = "rule_id int, host_pattern string, path_pattern string, target_type string, version int, enabled boolean, origin string"
    rules = spark.createDataFrame([(1, "h", "", "page", 1, True, "auto"), (2, "h", r"^/news/(\d+)$", "page", 4, True, "manual"), (3, "g", "", "page", 1, True, "manual"), (4, "k", "", "page", 1, True, "auto")], schema)
    samples = spark.createDataFrame([(r, f"/news/{k}") for r in (1, 3) for k in range(5)] + [(4, "/a/1"), (4, None)], "rule_id int, path string")
    insert, purge = I.refine_rules(rules, samples)
    assert [tuple(r) for r in insert.collect()] == [(1, "h", r"^/news/(\d+)$", "page", 5, True)] and [r.rule_id for r in purge.collect()] == [1]


def test_validation_routes(spark):
    rows = [(True, None, {"n": "5"}, 9), (False, "VAL_001", {"n": "1"}, 0), (False, "VAL_003", {"n": "2"}, 0), (False, "VAL_006", {"n": "-1"}, 2), (False, "VAL_006", {}, 3), (False, "VAL_001", {"n": "x"}, 3)]
    df = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "k int, valid boolean, code string, headers map<string,string>, retries int").withColumn("reparses", V.header_count(F.col("headers"), "n"))
    route = V.validation_route(F.col("valid"), F.col("code"), F.col("reparses"), F.col("retries"))
    assert [r[0] for r in df.orderBy("k").select(route).collect()] == ["validated", "reparse", "requeue", "requeue", "dead", "reparse"]
    off = V.validation_route(F.col("valid"), F.col("code"), F.col("reparses"), F.col("retries"), reparse_enabled=False)
    assert df.filter("k = 5").select(off).first()[0] == "dead"
    s = V.with_status(V.validated(record(spark, title="short").unionByName(record(spark, id="2")))).orderBy("id").collect()
    assert [(r.validation_status, r.reject_code, r.reject_detail) for r in s] == [("rejected", "VAL_003", "Title: min_length"), ("passed", None, None)]


def test_a_date_is_required_of_articles_by_default(spark):
    assert rules_of(record(spark, published_s=None), article=False)[0] == ["required"] and rules_of(record(spark, published_s=None, article=None), article=False)[0] == []


def test_host_breaker(spark):
    e = [("h", k, t * 1_000_000, limited) for k, (t, limited) in enumerate([(0, True), (1, True), (2, False), (3, True), (4, True), (5, True), (6, False), (604, True), (605, True), (606, False)])]
    got = folds.host_breaker(spark.createDataFrame(e, "host string, id int, ts_us bigint, limited boolean"), ["host"]).first()
    # Shut at 5 s for ten minutes: the call at 605 s, its very end, is let in.
    assert (got.admitted, got.refused, got.blocked) == (8, 2, 1)


def test_publish_chain(spark):
    rows = [(1, "https://a.example/x/", "article", 0), (2, "http://a.example/x", "article", 86_399), (3, "http://a.example/x", "article", 86_400), (4, "https://a.example/c", "category", 0), (5, "https://a.example/c", "category", 59), (6, "https://a.example/c", "category", 60),
            (7, "https://a.example/login", "article", 0), (8, "", "article", 0), (9, None, "article", 0), (1, "https://a.example/x/", "article", 0)]
    req = spark.createDataFrame([(i, "c", u, t, 1, s * 1_000_000) for i, u, t, s in rows], "id int, crawler string, url string, target_type string, priority int, ts_us bigint")
    jobs = Pb.publish_jobs(req, ["/login"]).orderBy("url", "ts_us").collect()
    assert [(j.url, j.ts_us // 1_000_000) for j in jobs] == [("https://a.example/c", 0), ("https://a.example/c", 60), ("https://a.example/x", 0), ("https://a.example/x", 86_400)]
    assert len({j.job_id for j in jobs}) == 4 and {j.topic for j in jobs} == {"crawl.high"} and Pb.publish_jobs(req.limit(0)).count() == 0
    held = spark.createDataFrame([("a", 1), ("b", 2)], "url string, until_us int")
    assert [r.url for r in Pb.release(held, held.filter("url = 'a'")).collect()] == ["b"]


def test_pending_pushes(spark):
    e = spark.sql("select 'h' as host, id, timestamp'2024-01-01' + make_interval(0,0,0,0,0,id*7) as arrival from range(50)")
    got = Pb.pending_pushes(e, ["host"], 20).orderBy("id").collect()
    assert [r.place for r in got] == list(range(1, 51)) and sum(r.accepted for r in got) == 20


@pytest.mark.parametrize("text, found", [('x {"a": {"b": "}"}} {"c": 1}', '{"a": {"b": "}"}}'), ('{"a": "\\"}{"}', '{"a": "\\"}{"}'), ("{ never closed", None), ("none", None), (None, None), ("", None)])
def test_first_object(spark, text, found):
    assert spark.createDataFrame([(text,)], "t string").select(E.first_object(F.col("t"))).first()[0] == found


def test_due_retries_and_slots(spark):
    schedule = spark.createDataFrame([(1, 5), (2, 3), (3, 9), (4, 4)], "id int, due_ms int")
    now = spark.createDataFrame([(5,)], "now_ms int")
    due, gone = Q.due_retries(schedule, spark.createDataFrame([(1, "x"), (4, "y")], "id int, body string"), now, 10)
    assert sorted(r.id for r in due.collect()) == [1, 4] and [r.id for r in gone.collect()] == [2]
    s = spark.createDataFrame([(1, 9), (9, 0), (8, 3), (8, 30), (8, None)], "w int, c int").select(Q.stage_slots(F.col("w"), F.col("c")))
    assert [r[0] for r in s.collect()] == [1, 4, 3, 4, 4]


def test_rules(spark):
    pages = spark.createDataFrame([("1", "h", "/promotion/123"), ("2", "h", "/about/team"), ("3", "g", "/x")], "key string, host string, path string")
    rules = spark.createDataFrame([(1, "h", "", "extract_links_only", True), (2, "h", "^/promotion/.*$", "drop", True), (3, "g", "([", "drop", True), (4, "g", "(?=x)", "drop", True)], "id int, host_pattern string, path_pattern string, mode string, enabled boolean")
    got = {r.key: r.verdict for r in R.classify(R.best_rule(pages, rules, F.desc("_len"), F.desc("id"), keep=["mode"])).collect()}
    assert got == {"1": "drop", "2": "extract_links_only", "3": "allow"}
    assert [r.key for r in R.unmatched(pages, rules).collect()] == ["3"]


def test_dollar_is_the_end(spark):
    pages = spark.createDataFrame([("1", "h", "/a\n")], "key string, host string, path string")
    rules = spark.createDataFrame([("h", "^/a$", True)], "host_pattern string, path_pattern string, enabled boolean")
    assert R.unmatched(pages, rules).count() == 1


def test_window_boundary_and_folds(spark):
    e = spark.createDataFrame([("h", 1, 0), ("h", 2, 10), ("h", 3, 10), ("h", 4, 19)], "host string, id bigint, ts_us bigint")
    assert [r.cnt for r in Wn.sliding_count(e, ["host"], 10).orderBy("id").collect()] == [1, 2, 2, 3]
    assert [r.accepted for r in folds.ttl_accepts(e, ["host"], 10).orderBy("ts_us", F.desc("accepted")).collect()] == [True, True, False, False]
    b = spark.createDataFrame([("h", i, i * 10, ok) for i, ok in enumerate([False, False, True, False, True])], "host string, id bigint, ts_us bigint, ok boolean")
    r = folds.circuit_breaker(b, ["host"], 2, 15).first()
    # 0 and 10 fail and open it to 25; 20 is refused; the probe at 30 fails and opens it to 45; 40 is refused.
    assert (r.admitted, r.rejected, r.opened) == (3, 2, 2)
    t = folds.token_bucket(e, ["host"], 3600e6, 1).first()
    assert (t.allowed, t.refused) == (3, 1)
    v = spark.createDataFrame([("h", 1, 1, 10.0), ("h", 2, 2, 20.0)], "host string, id bigint, ts_us bigint, value double")
    assert folds.smoothed(v, ["host"], "value").first().ema == pytest.approx(12.0)


def test_queues(spark):
    e = spark.createDataFrame([(1, "2", 5), (1, "1", 9), (2, "9", 1), (3, "3", 0)], "id bigint, priority string, arrival_ms bigint")
    assert [r.id for r in Q.push_capped(e, 2).orderBy("score").collect()] == [1, 2]
    w = spark.createDataFrame([(i,) for i in (1, 2, 3, 9)], "n int").select(Q.backoff_seconds(F.col("n"), 5.0, 2.0, 300.0)).collect()
    assert [x[0] for x in w] == [5.0, 10.0, 20.0, 300.0]


def test_upsert_keeps_first_values(spark):
    s = "url string, id string, title string, body string, content_hash string"
    old, new = spark.createDataFrame([("u", "1", "t", "b", "h"), ("v", "2", "t", "b", "h2")], s), spark.createDataFrame([("u", "9", "T", "B", "h"), ("v", "8", "T", "B", "H"), ("w", "3", "n", "n", "n")], s)
    got = {r.url: (r.id, r.title, r.body, r.content_hash) for r in St.upsert_contents(old, new).collect()}
    assert got == {"u": ("1", "t", "B", "h"), "v": ("2", "T", "B", "H"), "w": ("3", "n", "n", "n")}


@pytest.mark.parametrize("text, want", [("```json\n{\"a\":1}\n```", '{"a":1}'), ('Here is: ```json{"k":1}``` bye', '{"k":1}'), ("  {} ", "{}"), ("", "")])
def test_fences(spark, text, want):
    assert spark.createDataFrame([(text,)], "t string").select(E.strip_fences(F.col("t"))).first()[0] == want


@pytest.mark.parametrize("text, error", [('{"trust_score": 0.5, "rationale": "ok"}', None), ('{"rationale": "ok"}', "missing trust_score"), ('{"trust_score": 2, "rationale": "x"}', "out of range"), ('{"trust_score": 1, "rationale": " "}', "missing rationale"), ("", "empty output")])
def test_scores(spark, text, error):
    assert spark.createDataFrame([(text,)], "t string").select(E.parse_score(F.col("t")).alias("s")).first().s.error == error


def test_headers_and_render(spark):
    d = spark.createDataFrame([({"a": "1", "b": "", "c": "3"}, {"a": "own"}, "{y}")], "i map<string,string>, o map<string,string>, x string")
    r = d.select(E.propagate_headers(F.col("i"), F.col("o"), ["a", "b"]).alias("h"), E.render("{x}-{y}", {"x": F.col("x"), "y": F.lit("Y")}).alias("t")).first()
    assert r.h == {"a": "own"} and r.t == "{y}-Y"


def test_responses_are_decoded(spark):
    rows = [(1, "é".encode("latin-1"), "text/html; charset=ISO-8859-1"), (2, "<meta charset='euc-kr'>가".encode("euc-kr"), "text/html"), (3, "é".encode(), None), (4, b"\xff", "text/html; charset=nonsense"), (5, None, None)]
    got = spark.createDataFrame(rows, "k int, body binary, kind string").select("k", C.page_text(F.col("body"), F.col("kind")).alias("t")).orderBy("k").collect()
    assert [r.t for r in got] == ["é", "<meta charset='euc-kr'>가", "é", "\ufffd", None]
    h = spark.createDataFrame([([("A", "1"), ("content-TYPE", "x"), ("Content-Type", "y")],)], "h array<struct<key:string,value:string>>")
    assert tuple(h.select(C.first_header(F.col("h"), "Content-Type"), C.first_header(F.col("h"), "none")).first()) == ("x", None)
    df, seen = C.observed(spark.range(10), "stage", n=F.count("*"), top=F.max("id"))
    df.collect()
    assert seen.get == {"n": 10, "top": 9}


def test_intake_and_republish(spark):
    m = spark.createDataFrame([("a", "3", 5), ("a", "1", 9), ("", "1", 1), (None, "1", 1), ("b", "2", 1)], "id string, priority string, arrival_ms bigint")
    assert [(r.id, r.score) for r in Q.intake(m, 5).collect()] == [("a", Q.PRIORITY_STEP + 9), ("b", 2 * Q.PRIORITY_STEP + 1)]
    due = spark.createDataFrame([(1, 5, 0), (2, 6, 1)], "id int, due_ms bigint, attempts int")
    sent, later = Q.republished(due, due.filter("id = 2"), F.lit(100), 10)
    assert sent.count() == 2 and [tuple(r) for r in later.collect()] == [(2, 120, 2)]
