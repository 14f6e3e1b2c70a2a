"""Problems 1, 5 and 6 on small tables."""

from collections import defaultdict

import pytest

from harrowmill.llm import boilerplate as B, residue as R, sitelines as S
from harrowmill.llm.pages import page_blocks

DOC = "id string, source_id string, body string, title string, url string, digest string, n_in string"


def docs(spark, rows):
    return spark.createDataFrame([(*r, "t", "u", "clash", "clash") for r in rows], DOC)


def brute(rows, least=5):
    key = lambda x: "".join(c for c in x.lower() if c.isalpha())
    seen = defaultdict(set)
    for i, s, b in rows:
        if i and s and b is not None:
            for line in b.split("\n"):
                if key(line):
                    seen[s, key(line)].add(i)
    return sorted({(i, k) for i, s, b in rows if i and s and b is not None for k, line in enumerate(b.split("\n")) if key(line) and len(seen[s, key(line)]) >= least})


ROWS = [(f"a{i}", "A", f"By Staff {i}\nunique text {chr(97 + i)}{i}\nSHARE this!\n\n123\nshare  THIS") for i in range(6)]
ROWS += [(f"b{i}", "B", "share this\nother") for i in range(4)] + [("n1", None, "share this"), (None, "A", "share this"), ("n2", "A", None), ("n3", "A", ""), ("long", "A", "x y\n" * 5000)]


@pytest.mark.parametrize("extra", [[], [ROWS[0]] * 3 + [("b0", "B", "share this\nother")] * 9])
def test_repeated_lines_equal_brute_force(spark, extra):
    rows = ROWS + extra
    got = sorted((r.doc_id, r.line_no) for r in S.repeated_occurrences(docs(spark, rows)).collect())
    assert got == brute(rows)


def test_lines_of_empty_table_and_cleaning(spark):
    assert S.repeated_occurrences(docs(spark, [])).count() == 0
    kept = {r.doc_id: r.body for r in S.without_repeated_lines(docs(spark, ROWS)).collect()}
    assert kept["a0"] == "unique text a0\n\n123" and kept["n1"] == "share this" and kept["n2"] is None and kept["n3"] == ""


def test_excess_is_told_from_common(spark):
    rows = [(f"{s}{i}", s, f"everywhere\nonly {s}\nx{s}{'q' * i}") for s in "ABCD" for i in range(8)]
    verdict = {r.verdict for r in S.repeated_lines(S.line_digests(docs(spark, rows))).collect()}
    assert verdict == {"excess", "common"}


def test_the_test_runs_only_where_it_decides(spark, monkeypatch):
    """Lines repeated, however frequent elsewhere, come by count alone; asked for excess, the test decides rows and bodies."""
    rows = [(f"{s}{i}", s, f"everywhere\nonly {s}\nx{s}{'q' * i}") for s in "ABCD" for i in range(8)]
    of = lambda **o: sorted((r.doc_id, r.line_no) for r in S.repeated_occurrences(docs(spark, rows), **o).collect())
    assert of(excess=True) == sorted((i, 1) for i, *_ in rows) and of(excess=True, rate=0.0) == []
    assert {r.body.split("\n")[0] for r in S.without_repeated_lines(docs(spark, rows), excess=True).collect()} == {"everywhere"}
    monkeypatch.setattr(S, "excess_threshold", lambda *_: pytest.fail("tested for nothing"))
    assert of() == brute(rows) == sorted((i, k) for i, *_ in rows for k in (0, 1))


@pytest.mark.parametrize("text, slot", [
    ("The {{ name }} said", True), ("by ${author}", True), ("{% block x", True), ("[[title]]", True), ("__lead__", True), ("%city%", True), ("<headline>", True), ("[city goes here]", True), ("[INSERT quote HERE]", True), ("@@x@@", True), ("{byline}", True),
    ("it is [sic] 100% full and 50% off", False), ("a_b and c__d", False), ("5 < 6 > 4", False), ("[관련] x", False), ("", False),
])
def test_slots(text, slot):
    assert R.has_slot(text) is slot


def test_filler():
    assert R.has_filler("Lorem ipsum dolor sit amet consectetur adipiscing elit sed do.")
    assert not R.has_filler("The printed leaflet for the old hall still showed lorem ipsum late on Friday.")


def test_messages_slots_and_real_articles(spark):
    prose = "The council opened the old bridge on Monday after a long debate about its cost and its use. " * 6
    c = [("1", "Old mill burns down in the valley", "Please enable JavaScript to view Old mill burns down in the valley."), ("2", "New tram line opens near harbour", prose + "\nStudents learn JavaScript at the new school."),
         ("3", "x", prose + " {{ lead }} more"), ("4", None, None), ("5", "t", ""), ("1", "Old mill burns down in the valley", "Please enable JavaScript to view Old mill burns down in the valley.")]
    contents = spark.createDataFrame([(i, b, t, None, "z") for i, t, b in c], "id string, body string, title string, url string, reason string")
    page = "<html><head><title>{t} - Site</title></head><body><noscript>Please enable JavaScript to view Site.</noscript><script>x='{{{{a}}}}'</script>{b}</body></html>"
    raw = spark.createDataFrame([("r1", page.format(t="Big fair returns to old town", b=f"<article><h1>Big fair returns to old town</h1><p>{prose}</p></article>"), "u"), ("r2", "<h1>404 Not Found: Big fair returns to old town</h1>", "https://x.example/a/big-fair-returns-to-old-town-12"), ("r3", None, None), ("r4", "", None)], "id string, html string, url string")
    got = sorted(map(tuple, R.residue(contents, raw).collect()))
    assert got == [("contents", "1", "message"), ("contents", "3", "slot"), ("raw_contents", "r2", "message")]
    assert R.residue(contents.limit(0), raw.limit(0)).count() == 0


PLAIN = [
    "Please enable JavaScript to view this page.", "Please turn on JavaScript and reload.", "You need to enable JavaScript to run this site.", "404 Not Found", "404 - Page not found", "403 Forbidden", "403 Forbidden\nAccess denied",
    "Access denied", "500 Internal Server Error", "502 Bad Gateway", "503 Service Temporarily Unavailable", "504 Gateway Timeout", "The page you requested was not found.", "This page does not exist.",
    "Sorry, the page could not be found.\n404 not found", "Something went wrong. Please try again later.", "This page is under construction. Sample text.", "Too many requests", "Checking your browser", "Sample text",
    "Lorem ipsum", "Seite nicht gefunden", "Page introuvable", "Acceso denegado", "요청하신 페이지를 찾을 수 없습니다",
]
DECOYS = [
    "The clerk said the page was not found in the archive of the parish.", "Developers say JavaScript remains the language most schools teach.", "Access denied to the old quarry, walkers complain to the council.",
    "The forbidden garden opens again in spring for the first visitors.", "The gallery shows sample text from the first printers of the valley.", "The town server error cost the council a week of work, officials said.",
]


def test_messages_without_title(spark):
    rows = [(f"m{k:02}", t, None, None) for k, t in enumerate(PLAIN)] + [(f"d{k:02}", t, "x", None) for k, t in enumerate(DECOYS)]
    got = {r.record_id for r in R.residue(spark.createDataFrame(rows, "id string, body string, title string, url string")).collect()}
    assert got == {f"m{k:02}" for k in range(len(PLAIN))}


def test_unknown_wording_counts_by_status(spark):
    """Wording that no list knows stands alone on five failed pages; the same under a good status, or once, is no case."""
    page = "<body><p>{}</p></body>"
    raw = [(f"a{k}", page.format("Our hamster left the wheel for a moment."), f"u{k}", 500) for k in range(5)] + [("a9", page.format("Our hamster left the wheel for a moment."), "u", None)]
    raw += [(f"b{k}", page.format("Our choir sings in the hall tonight."), f"v{k}", 200) for k in range(9)] + [("c", page.format("Our tram is late."), "w", 500)]
    contents = spark.createDataFrame([], "id string, body string, title string, url string")
    got = {r.record_id for r in R.residue(contents, spark.createDataFrame(raw, "id string, html string, url string, status_code int")).collect()}
    assert got == {*(f"a{k}" for k in range(5)), "a9"}


@pytest.mark.parametrize("most", [0, 1, 2, 20_000])
def test_every_template_meets_lines_of_other_titles(spark, most):
    """However few templates may be sent to the tasks, each finds the lines that show another record's title."""
    words = ["amber mill", "brass tower", "copper lane"]
    frames = ["Kindly summon the curtain before {} appears again", "Our hamster dropped {} behind the big wheel", "Fetch a ladder to reach {}"]
    rows = [(f"t{f}{k}", frame.format(title := f"{'north south east west upper lower'.split()[k]} {words[f]} closes early"), title) for f, frame in enumerate(frames) for k in range(6)]
    rows += [(f"o{f}", frame.format("the quiet harbour gate"), "Nothing of the kind") for f, frame in enumerate(frames)] + [("d", "Our hamster dropped the ladder behind the sofa", "Nothing of the kind")]
    got = {r.record_id for r in R.residue(spark.createDataFrame([(*r, None) for r in rows], "id string, body string, title string, url string"), most_templates=most).collect()}
    assert got == {i for i, *_ in rows} - {"d"}


def test_joined_templates_equal_the_bank(spark):
    """Brute force: lines and templates of few words, wildcards between fixed ends, one template with two verdicts."""
    import hashlib
    import random

    rng = random.Random(5)
    some = lambda n: [rng.choice("abc") for _ in range(n)]
    titled = {}
    for _ in range(300):
        pre, post = some(rng.randint(0, 6)), some(rng.randint(0, 6))
        for side, inner in ((pre, range(1, len(pre))), (post, range(len(post) - 1))):
            for i in inner:
                side[i] = "<*>" if rng.random() < 0.4 else side[i]
        if pre or post:
            titled[" ".join([*pre, "<t>", *post]), rng.choice(["message", "filler"])] = rng.randint(2, 9)
    texts = sorted({" ".join(some(rng.randint(1, 12))) for _ in range(600)})
    bank = R.TemplateBank(sorted(titled, key=lambda x: (-titled[x], x[1])))
    got = R.fitted_texts(spark.createDataFrame([(x,) for x in texts], "text string"), spark.createDataFrame([(*k, n) for k, n in titled.items()], "template string, mined string, records bigint"))
    want = {hashlib.md5(x.encode()).digest(): kind for x in texts if (kind := bank.kind(x.split()))}
    assert set(want.values()) == {"message", "filler"} and {bytes(r.shown): r.fit for r in got.collect()} == want


def test_detectors_take_all_they_describe():
    assert R.has_filler("Excepteur sint occaecat cupidatat non proident sunt in culpa qui officia deserunt mollit anim id est laborum.")
    assert R.has_filler("Duis aute irure dolor in reprehenderit in voluptate velit esse cillum dolore eu fugiat nulla pariatur.")
    assert R.has_slot("[city goes   here]") and R.has_slot("[city goes\there]")


def test_smallest_hashes_whatever_the_size(spark, monkeypatch):
    """A sample is as large among a thousand millions of rows as among a thousand; rare rows are found by a wider pool."""
    ids = spark.range(20_000).selectExpr("cast(id as string) as id")
    by_hash = [r.id for r in ids.orderBy(B.F.xxhash64("id")).limit(400).collect()]
    assert [r.id for r in B.smallest(ids, "id", 400)] == by_hash
    assert len(B.smallest(ids, "id", 100, lambda pool: pool.filter("id % 1000 = 7"))) == 20
    monkeypatch.setattr(type(ids), "count", lambda self: 10**9)
    assert [r.id for r in B.smallest(ids, "id", 400)] == by_hash
    assert B.smallest(ids.limit(0), "id", 5) == []


def test_line_features_do_not_depend_on_batches(spark):
    """Features of records taken together equal those of records taken apart."""
    import numpy as np
    import pyarrow as pa

    rng = np.random.default_rng(3)
    n = [3, 1, 5]
    shapes = [rng.integers(0, 9, (k, len(B.SHAPE))).astype(np.float32).tobytes() for k in n]
    hit = pa.struct([("pos", pa.int32()), *[(c, pa.float64()) for c in ("n", "chrome", "main", "linked", "words")]])
    hits = [[{"pos": 1, "n": 4.0, "chrome": 5.0, "main": 0.0, "linked": 3.0, "words": 3.0}, {"pos": 4, "n": 7.0, "chrome": 0.0, "main": 0.0, "linked": 0.0, "words": 0.0}], None, [{"pos": 2, "n": 2.0, "chrome": 1.0, "main": 9.0, "linked": 0.0, "words": 80.0}]]
    of = lambda ks: B.feature_table(pa.array([list(range(n[k])) for k in ks], pa.list_(pa.int32())), [shapes[k] for k in ks], pa.array([hits[k] for k in ks], pa.list_(hit)))[1]
    assert np.array_equal(of([0, 1, 2]), np.concatenate([of([0]), of([1]), of([2])]))


def test_blocks_of_broken_pages():
    b = page_blocks("<body><div>a <a href=x>b c</a><p>one<p>two<br><br>three<script>var x='</p>'</script><!-- <p>no --></div><td>&lt;x&gt;")
    assert [x.text for x in b] == ["a b c", "one", "two", "three", "<x>"] and b[0].linked == 2
    assert page_blocks(None) == [] and page_blocks("") == [] and page_blocks("<script>never closed") == []
    assert len(page_blocks("<p>" * 20000 + "x")) == 1


def site(n, layout):
    text = [f"Sentence number {n} about the {w} of the town, which took a while to be told in full here." for w in ("bridge", "harbour", "market")]
    if layout == "marked":
        return f"<body><nav><ul><li><a href=/a>Home</a><li><a href=/b>News</a><li><a href=/c>Sport</a></ul></nav><main><article><h1>Story {n}</h1>" + "".join(f"<p>{t} {t}</p>" for t in text) + "<p>Share this story</p></article></main><aside><h3>Most read</h3><ul><li><a href=/1>Other story goes on here</a></ul></aside><footer><p>About us | Contact</p></footer></body>"
    return "<body><div><a href=/a>Home</a> <a href=/b>News</a></div><div class=c>" + "".join(f"<div>{t} {t}</div>" for t in text) + "<div>Share this story</div></div><div><div>Most read</div><div><a href=/1>Other story goes on here</a></div></div><div>About us | Contact</div></body>"


def test_main_text(spark):
    rows = [(f"r{n}", f"https://s.example/{n}", site(n, "marked" if n % 2 else "plain"), ("Site",)) for n in range(60)] + [("e", "u", "", ("Site",)), ("z", None, None, ("Site",))]
    raw = spark.createDataFrame(rows, "id string, url string, html string, source struct<name:string>")
    got = {r.raw_id: r.body.split("\n") for r in B.main_text(raw).collect()}
    assert len(got) == 60 and all(len(v) == 4 and v[-1] == "Share this story" for v in got.values())


def test_body_lines(spark):
    raw, contents = [], []
    for n in range(120):
        raw.append((f"r{n}", f"https://s.example/{n}", site(n, "marked"), ("Site",)))
        t = [f"Sentence number {n} about the {w} of the town, which took a while to be told in full here." for w in ("bridge", "harbour", "market")]
        lines = ["Home"] * (n % 3 == 0) + [f"{x} {x}" for x in t] + ["", "Share this story"] + (["Most read", f"1. Quiet mill number {'abcdefghij'[n % 10] * 3} closes again soon"] if n % 2 else []) + ["About us | Contact"] * (n % 4 == 0)
        contents.append((f"c{n}", "s", "\n".join(lines), None, f"https://s.example/{n}", "Story", None))
    schema = "id string, source_id string, body string, author string, url string, title string, chrome string"
    c, r = spark.createDataFrame(contents, schema), spark.createDataFrame(raw, "id string, url string, html string, source struct<name:string>")
    src = spark.createDataFrame([("s", "Site")], "source_id string, name string")
    got = {(x.id, x.line_no) for x in B.boilerplate_lines(c, r, src).collect()}
    want = {(i, k) for i, _, b, *_ in contents for k, x in enumerate(b.split("\n")) if x in ("Home", "Most read", "About us | Contact") or x.startswith("1. ")}
    assert got == want
    assert B.boilerplate_lines(c.limit(0), r.limit(0), src).count() == 0


@pytest.mark.parametrize("most", [0, 20_000])
def test_no_lines_of_messages_under_another_title(spark, monkeypatch, most):
    """A record whose message shows another record's title is a case of problem 1, whatever number of templates is sent to the tasks."""
    from functools import partial

    monkeypatch.setattr(R, "residue_of", partial(R.residue_of, most_templates=most))
    raw = spark.createDataFrame([(f"r{n}", f"https://s.example/{n}", site(n, "marked"), ("Site",)) for n in range(60)], "id string, url string, html string, source struct<name:string>")
    text = "\n".join(f"Sentence number {{0}} about the {w} of the town, which took a while to be told in full here. " * 2 for w in ("bridge", "harbour", "market"))
    rows = [(f"c{n}", "\n".join([*["Home"] * (n % 3 == 0), text.format(n), *["About us | Contact"] * (n % 4 == 0)]), f"https://s.example/{n}", "Story") for n in range(60)]
    titles = [f"{w} amber mill closes early" for w in "north south east west upper lower".split()]
    rows += [(f"t{k}", f"Our hamster dropped {t} behind the big wheel\nAbout us | Contact", f"https://s.example/t{k}", t) for k, t in enumerate(titles)]
    rows += [("o", "Our hamster dropped the quiet harbour gate behind the big wheel\nAbout us | Contact", "https://s.example/o", "Nothing of the kind")]
    contents = spark.createDataFrame([(i, "s", b, None, u, t) for i, b, u, t in rows], "id string, source_id string, body string, author string, url string, title string")
    got = {x.id for x in B.boilerplate_lines(contents, raw, spark.createDataFrame([("s", "Site")], "source_id string, name string")).collect()}
    assert got == {f"c{n}" for n in range(60) if n % 3 == 0 or n % 4 == 0}


@pytest.mark.parametrize("most", [0, 20_000])
def test_no_lines_of_messages_that_one_record_titles(spark, monkeypatch, most):
    """One record that shows a message under its own title is enough for those that show it under another; unknown wording shown once tells nothing."""
    from functools import partial

    monkeypatch.setattr(R, "residue_of", partial(R.residue_of, most_templates=most))
    raw = spark.createDataFrame([(f"r{n}", f"https://s.example/{n}", site(n, "marked"), ("Site",)) for n in range(60)], "id string, url string, html string, source struct<name:string>")
    text = "\n".join(f"Sentence number {{0}} about the {w} of the town, which took a while to be told in full here. " * 2 for w in ("bridge", "harbour", "market"))
    rows = [(f"c{n}", "\n".join([*["Home"] * (n % 3 == 0), text.format(n), *["About us | Contact"] * (n % 4 == 0)]), f"https://s.example/{n}", "Story") for n in range(60)]
    title, frames = "North amber mill closes early", {"a": "Access to {} was denied by the server (403)", "u": "Our hamster dropped {} behind the big wheel"}
    rows += [(f"{k}{n}", f"{frame.format(shown)}\nAbout us | Contact", f"https://s.example/{k}{n}", title) for k, frame in frames.items() for n, shown in enumerate([title, "the quiet harbour gate"])]
    contents = spark.createDataFrame([(i, "s", b, None, u, t) for i, b, u, t in rows], "id string, source_id string, body string, author string, url string, title string")
    got = {x.id for x in B.boilerplate_lines(contents, raw, spark.createDataFrame([("s", "Site")], "source_id string, name string")).collect()}
    assert got == {"u0", "u1", *(f"c{n}" for n in range(60) if n % 3 == 0 or n % 4 == 0)}
