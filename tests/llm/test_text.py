"""Problems 2, 4, 8, 9 and 10 on small tables."""

import random
from collections import Counter
from itertools import combinations
from pathlib import Path

import pytest
from hypothesis import given, settings, strategies as st

from harrowmill.llm import encoding as E, leakage as L, mixing as X, names as N, reading as G
from harrowmill.llm.queries import TOKENIZER
from harrowmill.llm.text import words

# --- names -------------------------------------------------------------------------------------------------------


def test_near_words_equal_brute_force(spark):
    rng = random.Random(3)
    pool = {"".join(rng.choice("abc") for _ in range(rng.randint(3, 7))) for _ in range(160)}
    df = spark.createDataFrame([("x", w) for w in sorted(pool)] + [("x", "abcabc"), ("x", "abcabc"), ("y", "abcabd")], "block string, word string")
    got = {(r.word, r.other) for r in N.near_words(df).collect() if r.block == "x"}
    pool.add("abcabc")
    want = {(a, b) for a in pool for b in pool if a != b and min(len(a), len(b)) >= 4 and N.osa_within_one(a, b)}
    assert got == want


@given(st.text("abcd", min_size=4, max_size=9), st.data())
@settings(max_examples=400, deadline=None)
def test_every_edit_shares_a_key(word, data):
    k = data.draw(st.integers(0, len(word) - 1))
    kind = data.draw(st.sampled_from(["sub", "del", "ins", "swap"]))
    other = {"sub": word[:k] + "z" + word[k + 1 :], "del": word[:k] + word[k + 1 :], "ins": word[:k] + "z" + word[k:], "swap": word[:k] + word[k : k + 2][::-1] + word[k + 2 :]}[kind]
    assert N.osa_within_one(word, other)
    if len(other) >= 4:
        assert N.probe_keys(word) & N.index_keys(other)


GROUPS = [
    ["Benjamin Nafed", "Ben. Nafed", "NAFED, Benjamin C.", "Nafed Benjamin", "Dr. Benjamin Nafed", "B. Nafed", "Ben Nafed", "Benjamin “Ben” Nafed", "Bejnamin Nafed", "Benjamin Naafed"],
    ["Richard Nuhexor", "R. Nuhexor", "Dick Nuhexor"], ["Vincent Nuhexor", "Nuhexor, Vince"],
    ["University of Clandesk", "Univ. of Clandesk", "Clandesk Uni", "U of Clandesk", "The University of Clandesk", "Univeristy of Clandesk"],
    ["Krarkud Academy of River Navigation", "Krarkud ARN", "Krarkud Academy", "Academy of River Navigation, Krarkud", "Krarkud Acad. of River."], ["Krarkud Optics Corporation", "Krarkud Optic", "KrarkudOptics", "Krarkud (Optics)", "Krarkud-Optics Corp."],
    ["Krarkud Port Commission", "Krarkud P.C.", "the Krarkud Port Commission"],
]


def test_variants(spark):
    rows = [("org" if g[0][0] in "UK" else "person", n) for g in GROUPS for n in g] * 2 + [("location", "Benjamin Nafedville"), ("person", None), ("person", ""), ("product", "Krarkud X1"), ("person", "x" * 5000)]
    e = spark.createDataFrame([(t, n, "clash", "clash") for t, n in rows], "type string, name string, head string, entity string")
    c = spark.createDataFrame([("the quiet council",), ("B. Nafed",), (None,), ("",)], "subject string")
    got = {tuple(r) for r in N.variant_pairs(e, c).collect()}
    assert got == {tuple(sorted(p)) for g in GROUPS for p in combinations(g, 2)}


def linked(spark, rows, subjects=()):
    e = spark.createDataFrame(rows, "type string, name string")
    return {tuple(r) for r in N.variant_pairs(e, spark.createDataFrame([(x,) for x in subjects], "subject string")).collect()}


def test_organisations_of_unlisted_kinds(spark):
    groups = [["Halden Robotics", "Halden Robotics Ltd", "HALDEN ROBOTICS", "Haldan Robotics", "Robotics Halden", "Halden Robotcs Ltd."], ["Aster Pharma", "Aster Pharma Inc", "aster  pharma"], ["Halden Foods"], ["Quorl"], ["Robotics Union Quorl"]]
    rows = [("org", n) for g in groups for n in g] + [("org", "Halden Robotics")] * 5 + [("person", "Quorl"), ("org", "!!!"), ("org", "x" * 3000)]
    want = {tuple(sorted(p)) for g in groups for p in combinations([*g, *(["Halden Robotics LTD"] if "Robotics" in g[0] and "Halden" in g[0] else [])], 2)}
    assert linked(spark, rows, ["Halden Robotics LTD", "Nobody Knows This"]) == want


def test_given_names_no_list_knows(spark):
    groups = [["Kwabena Mensah", "Kwabenna Mensah", "K. Mensah", "Mensah, Kwabena"], ["Priyanka Rao", "Prianka Rao"], ["Oluchi Mensah"], ["Peter Rao"], ["Petra Rao"]]
    rows = [("person", n) for g in groups for n in g] + [("person", g[0]) for g in groups] * 3
    assert linked(spark, rows) == {tuple(sorted(p)) for g in groups for p in combinations(g, 2)}


def test_chains_are_followed_to_their_end(spark):
    words = spark.createDataFrame([("b", "abcdef", 9, 1), ("b", "abcdeg", 2, 1), ("b", "abcdhg", 1, 1), ("b", "abkdhg", 1, 0), ("c", "abcdeg", 1, 1)], "block string, word string, strings int, mentions int")
    assert {tuple(r) for r in N.canonical_words(words).collect()} == {("b", w, "abcdef") for w in ("abcdeg", "abcdhg", "abkdhg")}


def held_out_names(seed=4, people=60, firms=40):
    """Invented names, none of them from a list, with typed variants: typos, order, initials, titles, case, legal forms."""
    rng = random.Random(seed)
    word = lambda n: "".join(rng.choice("bdfgklmnprstvz") + rng.choice("aeiou") for _ in range(n)).capitalize()

    def typo(w):
        k = rng.randrange(1, len(w) - 1)
        return rng.choice([w[:k] + w[k + 1 :], w[:k] + rng.choice("aeiou") + w[k:], w[:k] + w[k + 1] + w[k] + w[k + 2 :], w[:k] + rng.choice("xyzq") + w[k + 1 :]])

    groups = []
    for _ in range(people):
        g, s = word(3), word(4)
        groups.append(("person", [f"{g} {s}", f"{s}, {g}", f"{g[0]}. {s}", f"{g} {s}".upper(), f"Dr. {g} {s}", f"{typo(g)} {s}", f"{g} {typo(s)}"]))
    kinds = ["Robotics", "Pharma", "Logistics", "Dynamics", "Biotech", "Software", "Partners", "Minerals"]
    for _ in range(firms):
        w, k = word(4), rng.choice(kinds)
        groups.append(("org", [f"{w} {k}", f"{w} {k} Ltd", f"{w} {k}".upper(), f"{typo(w)} {k}", f"{w} {typo(k)}", f"{w} {k} Inc."]))
    return groups


def test_held_out_names(spark):
    groups = held_out_names()
    rows = [(t, n) for t, g in groups for n in g] + [(t, g[0]) for t, g in groups] * 3
    got = linked(spark, rows)
    want = {tuple(sorted(p)) for _, g in groups for p in combinations(sorted(set(g)), 2)}
    recall, precision = len(got & want) / len(want), len(got & want) / len(got)
    print("held-out names: recall", round(recall, 3), "precision", round(precision, 3))
    assert recall >= 0.9 and precision >= 0.97


def test_kinds_are_learnt_from_their_companions(spark):
    """A word beside forty proper words is a kind, with which names can be misspelt and turned; a proper word beside two is not."""
    heads = [w for t, g in held_out_names(8, 0, 40) for w in [g[0].split()[0]]]
    names = [(f"{h} Robotics", "org") for h in heads] + [(f"{heads[0]} Pharma", "org"), (f"{heads[0]} Foods", "org")]
    kinds = N.learned_kinds(spark.createDataFrame(names, "name string, type string"))
    assert kinds.words == {"robotics"} and kinds.word("robtics") == "robotics"
    assert N.parse_organisation(f"Robotics {heads[0]}", kinds) == N.parse_organisation(f"{heads[0]} Robtics Ltd", kinds) != None  # noqa: E711


def test_no_names(spark):
    assert N.variant_pairs(spark.createDataFrame([], "type string, name string"), spark.createDataFrame([], "subject string")).count() == 0


# --- encodings ---------------------------------------------------------------------------------------------------

RIGHT = ["L’école a rénové le théâtre « ÎLE & ÂME » à Paris", "Das Schulamt begrüßte die Größe", "“Quoted — text” said the café", "장마직전 감사팀이 전시회를 조사했다고 밝혔으며 주민들은 반응을 보였다", "La comisión aprobó el año"]


def misread(text, codec, times=1):
    for _ in range(times):
        text = "".join(bytes([b]).decode(codec, "ignore") or chr(b) for b in text.encode("utf-8"))
    return text


@pytest.mark.parametrize("codec, times", [("cp1252", 1), ("cp1252", 2), ("latin-1", 1), ("mac_roman", 1), ("cp1251", 1)])
@pytest.mark.parametrize("text", RIGHT)
def test_round_trip(text, codec, times):
    bad = misread(text, codec, times)
    assert E.is_damaged(bad)
    if codec != "mac_roman" or not any("가" <= c <= "힣" for c in text):
        assert E.repair(bad)[0] == text


@pytest.mark.parametrize("text", RIGHT + ["SÃO VELMO — CORAÇÃO © Â-Line £792", "Tickets were §498 ± 5¢, ¿or was it more?", "ÞALDVÍK or Ðalvara", "", "plain", "Привет мир", "日本語の文章", "x" * 100_000 + "é"])
def test_right_text_is_left_alone(text):
    assert not E.is_damaged(text) and E.repair(text)[0] == text


def test_korean_pages():
    text = RIGHT[3]
    assert E.repair(text.encode("cp949").decode("latin-1"))[0] == text
    assert E.is_damaged(text.encode("utf-8").decode("cp949", "replace"))


def test_lost_bytes_are_filled_from_the_corpus(spark):
    damaged = "Le th�âtre".replace("â", "�") + " du caf� rest� vide, q�q"
    rows = [("contents", f"g{i}", "body", "le théâtre du café resté vide") for i in range(3)] + [("contents", "bad", "body", "le caf� rest� q�q vide �"), ("contents", "n", "body", "")]
    f = spark.createDataFrame(rows, "record_table string, record_id string, field string, value string")
    d = E.damaged_fields(f)
    assert [r.record_id for r in d.collect()] == ["bad"] and E.is_damaged(damaged)
    r = E.restore_lost(d, f).first()
    assert r.text == "le café resté q�q vide �" and (r.restored, r.open) == (2, 2)


def test_lost_bytes_beside_tags(spark):
    page = "<h1>{}Joint caf{} of Wynemark{}</h1><p title='caf{}'>The caf{}<br>rest{}</p>"
    rows = [("raw_contents", f"g{i}", "html", page.format("“", "é", "”", "é", "é", "é")) for i in range(3)] + [("raw_contents", "bad", "html", page.format(*"\ufffd" * 6))]
    f = spark.createDataFrame(rows, "record_table string, record_id string, field string, value string")
    r = E.restore_lost(E.damaged_fields(f), f).first()
    assert r.text == rows[0][3] and (r.restored, r.open) == (6, 0)


def test_neighbours_choose_between_words_of_one_shape(spark):
    rows = [("contents", f"a{i}", "body", "il a marché vite") for i in range(9)] + [("contents", f"b{i}", "body", "le grand marchè noir") for i in range(2)]
    rows += [("contents", "bad", "body", "le grand march\ufffd noir"), ("contents", "bad2", "body", "il a march\ufffd vite")]
    f = spark.createDataFrame(rows, "record_table string, record_id string, field string, value string")
    got = {r.record_id: r.text for r in E.restore_lost(E.damaged_fields(f), f).collect()}
    assert got == {"bad": "le grand marchè noir", "bad2": "il a marché vite"}


def test_viterbi_and_lattice():
    assert E.viterbi([[("a", 1.0), ("b", 0.9)], [("c", 1.0)], [], [("d", 0.0)]], {("b", "c"): 1.0}) == ["b", "c", None, "d"]
    assert E.lattice("café", "cp1252", "utf-8") == ["c", "a", "f", None] and ("caf\ufffd", "cp1252>utf-8") in E.through_channels("café")
    assert E.through_channels("cafe") == []


def test_lost_bytes_of_other_channels(spark):
    """Cyrillic in UTF-8 read as cp1251, Polish in cp1250 read as UTF-8; layers without end."""
    right = ["Иван и Мария из России", "Иван и Мария из России", "Łódź jest dużym miastem"]
    bad = [right[0].encode().decode("cp1251", "replace"), right[2].encode("cp1250").decode("utf-8", "replace")]
    rows = [("contents", f"g{k}", "body", t) for k, t in enumerate(right)] + [("contents", f"b{k}", "body", t) for k, t in enumerate(bad)]
    f = spark.createDataFrame(rows, "record_table string, record_id string, field string, value string")
    got = {r.record_id: r.text for r in E.restore_lost(E.damaged_fields(f), f).collect()}
    assert got == {"b0": right[0], "b1": right[2]}
    deep = "naïve café"
    for _ in range(6):
        deep = deep.encode().decode("cp1252", "replace") if "\ufffd" not in deep.encode().decode("cp1252", "replace") else deep.encode().decode("latin-1")
    assert E.repair(deep)[0] == "naïve café"


@pytest.mark.skipif(not Path("/root/testdata/sf0.01/contents.parquet").exists(), reason="the test tables are not here")
def test_share_of_damaged_words_restored(spark):
    """Sound bodies sent through three channels that lose bytes come back for the most part, and hardly ever wrong."""
    c = spark.read.parquet("/root/testdata/sf0.01/contents.parquet").selectExpr("'contents' record_table", "id record_id", "'body' field", "body value").filter("value rlike '[^\\\\x00-\\\\x7f]'")
    sound = c.join(E.damaged_fields(c).select("record_id"), "record_id", "left_anti").select(*c.columns)
    channels, bad = [("cp1252", "utf-8"), ("utf-8", "cp949"), ("utf-8", "cp1252")], {}
    for k, r in enumerate(sound.filter("abs(xxhash64(record_id)) % 12 = 0").orderBy("record_id").collect()):
        try:
            seen = r.value.encode(channels[k % 3][0]).decode(channels[k % 3][1], "replace")
        except UnicodeEncodeError:
            continue
        if "\ufffd" in seen:
            bad[r.record_id] = (r.value, seen)
    f = sound.filter(~sound.record_id.isin(list(bad))).unionByName(spark.createDataFrame([("contents", i, "body", x) for i, (_, x) in bad.items()], c.schema))
    right = wrong = words_ = 0
    for r in E.restore_lost(E.damaged_fields(f), f).collect():
        a, b = bad[r.record_id][0].split(), r.text.split()
        if len(a) == len(b):
            pairs = [(x, y) for x, y in zip(a, b) if not x.isascii()]
            words_, right, wrong = words_ + len(pairs), right + sum(x == y for x, y in pairs), wrong + sum(x != y and "\ufffd" not in y for x, y in pairs)
    print("restored", right, "wrong", wrong, "of", words_)
    assert words_ > 100 and right >= 0.7 * words_ and wrong <= 0.08 * words_


# --- leakage -----------------------------------------------------------------------------------------------------


def test_leaks_equal_brute_force(spark):
    rng = random.Random(5)
    vocab = [f"w{i}" for i in range(400)]
    items = [(i, " ".join(rng.choice(vocab) for _ in range(40))) for i in range(30)] + [(98, None), (99, "too short")]
    docs = []
    for d in range(120):
        t = [rng.choice(vocab) for _ in range(90)]
        if d % 3 == 0:
            w = items[d % 30][1].split()
            n = rng.choice([11, 12, 13, 30])
            s = rng.randrange(0, 40 - n + 1)
            p = rng.randrange(0, 80)
            t[p:p] = [x.upper() + "," for x in w[s : s + n]]
        docs.append((d, "  ".join(t)))
    docs += [(1000, None), (1001, ""), (3, docs[3][1]), (None, docs[3][1])]
    df = spark.createDataFrame([(i, t, 1.0) for i, t in docs], "doc_id bigint, text string, score double")
    it = spark.createDataFrame(items, "item_id bigint, text string")
    got = {tuple(r) for r in L.leaked_documents(df, it).collect()}
    grams = {}
    for i, t in items:
        w = words(t)
        for k in range(len(w) - 11):
            grams.setdefault(tuple(w[k : k + 12]), set()).add(i)
    want = {(d, i) for d, t in docs if d is not None and t for w in [words(t)] for k in range(len(w) - 11) for i in grams.get(tuple(w[k : k + 12]), ())}
    assert got == want and len(want) >= 20
    assert L.leaked_documents(df.limit(0), it).count() == 0 and L.leaked_documents(df, it.limit(0)).count() == 0


def test_tasks_without_passages(spark):
    """Documents without any item word, in more tasks than documents that hold some; more items than a block takes."""
    items = spark.createDataFrame([(i, " ".join(f"k{i}x{j}" for j in range(20))) for i in range(5)], "item_id bigint, text string")
    rows = [(d, " ".join(f"z{d}y{j}" for j in range(40))) for d in range(50)] + [(50 + i, "so " + " ".join(f"k{i}x{j}" for j in range(3, 17)) + " it was") for i in (0, 4)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(13)
    for most in (2000, 2):
        assert {tuple(r) for r in L.leaked_documents(docs, items, max_items=most).collect()} == {(50, 0), (54, 4)}
    assert L.leaked_documents(docs.filter("doc_id < 50"), items).count() == 0
    assert {tuple(r) for r in L.leaked_documents(docs, items, fit_passages=1).collect()} == {(50, 0), (54, 4)}


def test_recall_of_planted_paraphrases(spark):
    """Windows of items with words left out, put in or replaced, inside other text: nine in ten are found; short items too."""
    rng = random.Random(21)
    vocab = [f"w{i}" for i in range(600)]
    items = [(i, " ".join(rng.sample(vocab, 30))) for i in range(40)] + [(90, " ".join(rng.sample(vocab, 8)))]
    docs, planted = [], set()
    for d in range(200):
        t = [rng.choice(vocab) if rng.random() < 0.15 else f"z{rng.randrange(2000)}" for _ in range(70)]
        i, text = items[d % 41]
        w = text.split()
        w = w[6:18] if len(w) > 12 else w
        for k in rng.sample(range(1, len(w) - 1), 2):
            w[k] = f"z{rng.randrange(2000)}"
        p = rng.randrange(0, 60)
        docs.append((d, " ".join([*t[:p], *w, *t[p:]])))
        planted.add((d, i))
    got = {(r.doc_id, r.item_id) for r in L.paraphrased_documents(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string"), keys=0.0).collect()}
    print("planted paraphrases: recall", round(len(got & planted) / len(planted), 3), "others", len(got - planted))
    assert len(got & planted) >= 0.9 * len(planted)


def test_paraphrases_inside_other_text(spark):
    rng = random.Random(9)
    vocab = [f"w{i}" for i in range(400)]
    items = [(i, " ".join(rng.choice(vocab) for _ in range(30))) for i in range(20)]
    docs = []
    for d in range(60):
        t = [f"z{rng.randrange(900)}" for _ in range(80)]
        w = items[d % 20][1].split()[6:18]
        for k in rng.sample(range(12), d % 3):
            w[k] = f"z{k}"
        t[36:36] = w if d % 4 else w[::-1]
        docs.append((d, " ".join(t)))
    df, it = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    got = {(r.doc_id, r.item_id) for r in L.paraphrased_documents(df, it, keys=0.0).collect()}
    assert got == {(d, d % 20) for d in range(60) if d % 4 and d % 3}


def test_words_ignore_case_accents_and_punctuation():
    assert words("Éa-B  c_d’e 가나1") == ["ea", "b", "c", "d", "e", "가나1"] and words(None) == []


@given(st.lists(st.integers(0, 4), max_size=12), st.lists(st.integers(0, 4), max_size=12))
@settings(max_examples=200, deadline=None)
def test_lcs(a, b):
    t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
    assert L._lcs(a, b) == t[-1][-1]


# --- mixing ------------------------------------------------------------------------------------------------------


@given(st.lists(st.tuples(st.floats(0, 1), st.integers(1, 50)), min_size=0, max_size=60), st.integers(0, 99))
@settings(max_examples=200, deadline=None)
def test_flight_keeps_the_balance(units, seed):
    pi, size = [p for p, _ in units], [float(s) for _, s in units]
    out = X.cube_flight(pi, size, random.Random(seed))
    assert sum(1e-9 < x < 1 - 1e-9 for x in out) <= 2 and all(-1e-9 <= x <= 1 + 1e-9 for x in out)
    assert sum(out) == pytest.approx(sum(pi), abs=1e-4) and sum(a * b for a, b in zip(out, size)) == pytest.approx(sum(a * b for a, b in zip(pi, size)), abs=1e-2)


@pytest.mark.skipif(not Path(TOKENIZER).exists(), reason="the tokenizer is not here")
def test_mixture(spark, monkeypatch):
    monkeypatch.setattr(X, "BLOCK", 40)
    monkeypatch.setattr(X, "FAN_IN", 2)
    rng = random.Random(1)
    rows = [(i, rng.choice("aaaabc"), "word " * rng.randint(1, 60)) for i in range(900)] + [(1000, None, "x"), (1001, "a", None), (1002, "z", "x"), (0, "a", ""), (0, "a", "word " * 10)]
    docs = spark.createDataFrame([(*r, 5) for r in rows], "doc_id bigint, source string, text string, copies int")
    targets = spark.createDataFrame([("a", 0.5, 1), ("b", 0.3, 3), ("c", 0.1, 2), ("none", 0.1, 4), (None, 0.1, 1)], "source string, target_share double, max_repeats int")
    s = {r.source: r for r in X.mixture_shares(docs, targets, tokenizer=TOKENIZER).collect()}
    for k, share in (("a", 0.5 / 0.9), ("b", 0.3 / 0.9), ("c", 0.1 / 0.9)):
        assert s[k].actual_share == pytest.approx(share, abs=0.004) and s[k].most_copies <= s[k].max_repeats
    assert s["none"].actual_share == 0 and set(s) == {"a", "b", "c", "none"}
    assert X.mixture(docs.limit(0), targets, tokenizer=TOKENIZER).count() == 0 and X.mixture(docs, targets.limit(0), tokenizer=TOKENIZER).count() == 0


# --- reading level -----------------------------------------------------------------------------------------------


def test_reading_levels(spark):
    easy, hard = "The cat sat. The dog ran. The cat ran.", "Notwithstanding institutional interdependence the jurisprudence ostensibly substantiates longitudinal accountability number{} whereas conceptualisation legitimises disproportionate stratification."
    rows = [(i, easy, "en" if i % 2 else "EN-us") for i in range(60)] + [(100 + i, hard.format("x" * i), "en") for i in range(1)] + [(200, None, "en"), (201, "", "en"), (202, "123 !", "en"), (203, easy, None), (204, "한 사람이 갔다. 또 왔다.", None), (203, easy, None), (None, easy, "en"), (205, easy + " " + "long " * 20000, "en")]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id bigint, text string, lang string, level int")
    labels = spark.createDataFrame([(1, 1, "r"), (2, 1, None), (100, 5, "r"), (100, 5, "q"), (999, 3, "r"), (None, 2, "r")], "doc_id bigint, level int, rater string")
    f = {r.doc_id: r for r in G.reading_figures(docs).collect()}
    assert f[1].unfamiliar == 0 and f[1].sentence_words == 3 and f[100].unfamiliar > 0.5 and f[203].lang == "en" and f[204].lang == "ko" and not {200, 201, 202} & set(f)
    got = {r.doc_id: r.level for r in G.reading_levels(docs, labels).collect()}
    assert got[1] < got[100] and Counter(got.values())[got[1]] >= 60
    assert G.reading_levels(docs.limit(0), labels.limit(0)).count() == 0


def test_held_out_judgements(spark):
    sf = Path("/root/testdata/sf0.01")
    if not sf.exists():
        pytest.skip("test tables are not here")
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/reading_labels.parquet")
    mean = labels.groupBy("doc_id").agg({"level": "avg"}).withColumnRenamed("avg(level)", "y")
    train = labels.filter("doc_id % 2 = 0")
    held = mean.filter("doc_id % 2 = 1").join(G.reading_levels(docs, train), "doc_id").collect()
    assert sum(abs(r.y - r.level) <= 1 for r in held) >= 0.8 * len(held) and len(held) > 10
