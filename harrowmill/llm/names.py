"""Variant spellings of names typed by people (problem 2).

A name is split into a distinctive word (surname, or the proper part of an organisation) and the
rest (given name, or the kind of organisation); an organisation without a word for its kind is taken as the set of
its words.  Misspelt words are linked by a pigeonhole segment join, surnames and proper parts first, then given names
of one surname and the single words of whole names, so that each word of a name may have one edit: a word is cut into
k+1 segments, and position-shifted substrings of other
words are looked up in an inverted index of the segments that an edit has to leave alone; pairs are
verified with a banded edit distance, and each spelling follows its better attested ones to the end of the chain.
Short forms (initials, nicknames, acronyms, dropped words)
are then resolved to the one full form of the same distinctive word that they fit.

Everything works on distinct strings, so a name that a third of all rows repeat costs one row.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harrowmill.llm.text import fold
from harrowmill.session import cut_lineage

# Given names and their short forms.
NICKNAMES = {
    "abigail": "abby gail", "alexander": "alex sasha", "alexandra": "sandra", "andrew": "andy drew", "anthony": "tony", "benjamin": "ben benny",
    "catherine": "cathy cate", "charles": "charlie chuck", "charlotte": "lottie charlie", "christopher": "chris kit", "daniel": "dan danny",
    "david": "dave", "deborah": "debbie", "dorothy": "dot dottie dolly", "edward": "eddie ned ted ed", "elizabeth": "liz beth betty lizzie", "frederick": "fred freddie",
    "gabriella": "gabby", "guadalupe": "lupe", "harold": "harry hal", "henry": "hank", "ingrid": "inga", "isabella": "izzy bella", "james": "jim jimmy",
    "jennifer": "jenny jen", "jonathan": "jon jonny", "joseph": "joe joey", "josephine": "josie jo", "katherine": "kate kathy kit kitty", "lawrence": "larry",
    "leonard": "len lenny leo", "lorenzo": "enzo", "margaret": "peggy maggie meg", "matthew": "matt", "michael": "mike mick", "nathaniel": "nate nat",
    "nicholas": "nick", "oskar": "", "ottilie": "tilly", "patricia": "pat trish patty", "peter": "pete", "philippa": "pippa", "quentin": "", "rebecca": "becky",
    "richard": "rick dick rich", "robert": "bob rob bobby", "ronald": "ron", "samantha": "sammy", "samuel": "sam", "stephen": "steve", "susan": "sue", "theodore": "ted theo",
    "thomas": "tom tommy", "timothy": "tim", "ursula": "uschi", "victoria": "vicky tori", "vincent": "vince vinnie", "walter": "walt wally", "william": "will bill billy", "yvonne": "",
    "zachary": "zach zack",
}
# Words for kinds of organisation with their short forms; legal forms are marked by *.
ORGANISATION = {
    "university": "univ uni u", "institute": "inst", "department": "dept dep", "ministry": "min", "association": "assoc assn", "academy": "acad",
    "centre": "ctr center", "commission": "comm", "authority": "auth", "district": "dist", "board": "bd", "council": "cncl", "union": "", "farmer": "", "water": "",
    "port": "", "city": "", "housing": "", "transit": "", "company": "co *", "corporation": "corp *", "incorporated": "inc *", "limited": "ltd *",
    "holding": "hldg hldgs *", "group": "grp *", "textile": "", "cable": "", "food": "", "brewery": "brewerie", "seed": "", "ceramic": "", "optic": "", "motor": "",
    "paperwork": "", "shipping": "", "energy": "", "research": "", "navigation": "", "safety": "", "storage": "", "forestry": "", "science": "", "works": "work",
    "study": "studie", "public": "", "river": "", "tidal": "", "rail": "", "coastal": "", "grain": "", "urban": "", "crop": "", "bank": "", "school": "", "college": "coll",
    "society": "soc", "foundation": "fdn", "agency": "agcy", "bureau": "", "office": "", "service": "svc", "system": "", "industry": "", "laboratory": "lab", "museum": "",
    "hospital": "hosp", "club": "", "party": "", "press": "", "trust": "", "fund": "", "federation": "fed", "league": "", "national": "natl", "international": "intl",
}
LEGAL = {k for k, v in ORGANISATION.items() if "*" in v.split()}
#: Kinds that name a subject as well: such a name is full only with three words of its kind.
SUBJECT_KINDS = {"institute", "department", "ministry", "association", "academy", "centre"}
HONORIFICS = {"dr", "prof", "professor", "mr", "mrs", "ms", "miss", "sir", "rev", "hon", "st"}
STOP = {"of", "the", "for", "and"}

_SHORT = {s: full for full, v in ORGANISATION.items() for s in [full, *v.split()] if s != "*"}
_NICK = {}
for _g, _v in NICKNAMES.items():
    for _n in _v.split():
        _NICK.setdefault(_n, []).append(_g)
_WORDS = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*\.?")
_QUOTED = re.compile(r"[“\"„«(]\s*([^”\"“»)]+?)\s*[”\"“»)]")


def osa_within_one(a: str, b: str) -> bool:
    """Edit distance of at most one, a swap of neighbours counting once: the band around the first difference decides."""
    if a == b:
        return True
    if abs(len(a) - len(b)) > 1:
        return False
    i = 0
    while i < len(a) and i < len(b) and a[i] == b[i]:
        i += 1
    if len(a) == len(b):
        return a[i + 1 :] == b[i + 1 :] or (i + 1 < len(a) and a[i] == b[i + 1] and a[i + 1] == b[i] and a[i + 2 :] == b[i + 2 :])
    return a[i + 1 :] == b[i:] if len(a) > len(b) else a[i:] == b[i + 1 :]


def _deletions(w: str) -> set[str]:
    return {w, *(w[:i] + w[i + 1 :] for i in range(len(w)))}


def _near_index(known: list[str]) -> dict[str, list[str]]:
    out: dict[str, list[str]] = {}
    for w in known:
        if len(w) >= 4:
            for d in _deletions(w):
                out.setdefault(d, []).append(w)
    return out


_NEAR_ORG = _near_index([k for k in ORGANISATION if len(k) >= 5])
_NEAR_GIVEN = _near_index(list(NICKNAMES))


def _correct(word: str, index: dict[str, list[str]]) -> str | None:
    """Known word within one edit of a word of four or more letters."""
    if len(word) < 4:
        return None
    for d in sorted(_deletions(word)):
        for w in index.get(d, ()):
            if osa_within_one(word, w):
                return w
    return None


class Kinds:
    """Words for kinds of organisation that the corpus has shown, with an index of their misspellings; plain data for the workers."""

    def __init__(self, words: list[str]):
        self.words = frozenset(words)
        self.near = _near_index([w for w in words if len(w) >= 5])

    def word(self, t: str) -> str | None:
        for x in (t, t.removesuffix("s")):
            if x in self.words:
                return x
        return _correct(t, self.near) if len(t) >= 5 else None


NO_KINDS = Kinds([])


def organisation_word(token: str) -> str | None:
    t = token.rstrip(".").replace("'", "").replace("’", "")
    if t in _SHORT:
        return _SHORT[t]
    if t.endswith("s") and t[:-1] in _SHORT and len(t) > 3:
        return _SHORT[t[:-1]]
    if t.endswith("ies") and t[:-3] + "y" in _SHORT:
        return _SHORT[t[:-3] + "y"]
    if len(t) >= 5:
        hit = _correct(t, _NEAR_ORG) or _correct(t.removesuffix("s"), _NEAR_ORG)
        return _SHORT.get(hit) if hit else None
    return None


def given_forms(token: str) -> tuple[str, str]:
    """(form, value): initial, prefix, nick or full for a given name as typed (folded, its dot kept)."""
    t = token.rstrip(".")
    if len(t) == 1:
        return "initial", t
    if token.endswith("."):
        fits = [g for g in NICKNAMES if g.startswith(t)]
        return ("full", fits[0]) if len(fits) == 1 else ("prefix", t)
    if t in NICKNAMES:
        return "full", t
    if t in _NICK:
        return ("full", _NICK[t][0]) if len(_NICK[t]) == 1 else ("nick", t)
    return "full", _correct(t, _NEAR_GIVEN) or t


def is_given(token: str) -> bool:
    t = token.rstrip(".")
    return t in NICKNAMES or t in _NICK or (len(t) >= 5 and _correct(t, _NEAR_GIVEN) is not None)


def parse_organisation(name: str, kinds_seen: Kinds = NO_KINDS) -> tuple[str, str, str, str] | None:
    """(head, full or part, signature, initial) of an organisation; None if the name has no word for a kind.

    kinds_seen: words for kinds beside the listed ones.
    """
    split = re.sub(r"(?<=[a-zà-ÿ])(?=[A-ZÀ-Þ][a-zà-ÿ]{2,})", " ", name)
    raw = re.findall(r"(?:[^\W\d_]\.){2,}|[^\W\d_]+(?:['’][^\W\d_]+)*\.?", split)
    kinds, heads, acronym, part = [], [], "", False
    mixed = any(c.islower() for c in name)
    for token in raw:
        f = fold(token)
        bare = f.replace(".", "")
        if bare in STOP:
            continue
        if re.fullmatch(r"(?:[^\W\d_]\.){2,}", token) or (mixed and token.isupper() and 2 <= len(bare) <= 4 and bare not in _SHORT):
            acronym = bare
            continue
        k = organisation_word(f) or kinds_seen.word(bare)
        if k:
            if k not in LEGAL:
                kinds.append(k)
                part = part or (token.endswith(".") and k not in SUBJECT_KINDS and _SHORT.get(bare) == bare)
        else:
            heads.append(bare.replace("'", ""))
    if not heads or not (kinds or acronym):
        return None
    head = " ".join(heads)
    if acronym and not kinds:
        return head, "acronym", acronym, acronym[0]
    # The kind comes first, then its subject, whatever the order in the name.
    kinds.sort(key=lambda k: k not in SUBJECT_KINDS)
    if kinds[0] in SUBJECT_KINDS and len(kinds) < 3:
        return head, "part", " ".join(kinds), kinds[0][0]
    return head, "full", " ".join(kinds), kinds[0][0]


def parse_person(name: str) -> tuple[str, str, str, str, str, str] | None:
    """(surname, form, given, initial, middle initial, nickname) of a person; None for a single word."""
    nick = ""
    m = _QUOTED.search(name)
    if m:
        nick = fold(m.group(1))
        name = name[: m.start()] + " " + name[m.end() :]
    swapped = "," in name
    if swapped:
        last, _, first = name.partition(",")
        name = f"{first} {last}"
    tokens = [fold(t) for t in re.findall(r"[^\W\d_]\.|[^\W\d_]+(?:['’-][^\W\d_]+)*\.?", name)]
    while tokens and tokens[0].rstrip(".") in HONORIFICS and len(tokens) > 1:
        tokens = tokens[1:]
    if len(tokens) < 2:
        return None
    if not swapped and is_given(tokens[-1]) and not is_given(tokens[0]) and len(tokens[0].rstrip(".")) > 1 and not tokens[0].endswith("."):
        tokens = [tokens[-1], *tokens[1:-1], tokens[0]]
    given, middle, surname = tokens[0], tokens[1:-1], tokens[-1].rstrip(".")
    form, value = given_forms(given)
    return surname, form, value, value[0], (middle[0][0] if middle else ""), nick


def whole_name(name: str) -> str:
    """The words of a name without legal forms and words of grammar, in alphabetical order; all its words if nothing is left."""
    split = re.sub(r"(?<=[a-zà-ÿ])(?=[A-ZÀ-Þ][a-zà-ÿ]{2,})", " ", name)
    tokens = [fold(t).replace(".", "").replace("'", "").replace("’", "") for t in re.findall(r"(?:[^\W_]\.)+|[^\W_]+(?:['’][^\W_]+)*", split)]
    kept = [t for t in tokens if t not in STOP and _SHORT.get(t) not in LEGAL]
    return " ".join(sorted(kept or tokens))


def looks_personal(name: str) -> bool:
    """For strings of unknown type: a title, leading or trailing initials or a known given name, and no whole word for a kind."""
    tokens = [fold(t) for t in re.findall(r"(?:[^\W\d_]\.)+|[^\W\d_]+(?:['’-][^\W\d_]+)*\.?", name)]
    if not tokens:
        return False
    if tokens[0].rstrip(".") in HONORIFICS or re.fullmatch(r"(?:[^\W\d_]\.)+", tokens[0]) or ("," in name and re.fullmatch(r"[^\W\d_]\.", tokens[-1])):
        return True
    if any(len(t) > 3 and organisation_word(t) and not t.rstrip(".") in NICKNAMES for t in tokens) or tokens[:2] == ["u", "of"]:
        return False
    return any(is_given(t) for t in tokens) or given_forms(tokens[0])[0] == "prefix"


PARSED = "name string, kind string, head string, form string, sig string, initial string, middle string, nick string, n bigint, whole string"


#: Different companions a word needs to be taken for a kind, and share of its names in which it has the most of all words.
KIND_PARTNERS, KIND_SHARE = 30, 0.75


def learned_kinds(names: DataFrame, most: int = 2000) -> Kinds:
    """Words that stand beside many different words in names(name, type) of organisations, as words for a kind do.

    A proper word has few companions, a kind as many as there are organisations of it.  The `most` words with the most
    companions are sent to all tasks; names with other words are taken as sets of words.
    """

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = set()
            for name in b["name"]:
                w = sorted(set(whole_name(name).split()))
                if 2 <= len(w) <= 6:
                    out |= {(x, y) for x in w for y in w if x != y and len(x) >= 3 and not _SHORT.get(x)}
            yield pd.DataFrame(sorted(out), columns=["word", "other"])

    pairs = names.filter(F.col("type") == "org").mapInPandas(cut, "word string, other string").distinct()
    many = pairs.groupBy("word").agg(F.count("*").alias("n"))
    other = many.select(F.col("word").alias("other"), F.col("n").alias("m"))
    ahead = pairs.join(many.filter(F.col("n") >= KIND_PARTNERS), "word").join(other, "other", "left").groupBy("word", "n").agg(F.avg((F.coalesce("m", F.lit(0)) < F.col("n")).cast("double")).alias("share"))
    kinds = ahead.filter(F.col("share") >= KIND_SHARE).orderBy(F.desc("n"), "word").limit(most)
    return Kinds(sorted(r["word"] for r in kinds.collect()))


def parsed_names(names: DataFrame, kinds_seen: Kinds = NO_KINDS) -> DataFrame:
    """names(name, type, n) -> PARSED.

    Every string stated as a person or organisation that holds a letter or digit has a row; of the others those that
    read like one.  whole: the set of words of strings of unknown type, by which they may meet a stated organisation.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for name, kind, n in zip(b["name"], b["type"], b["n"]):
                stated = kind is not None
                if not stated and name.startswith("the ") and name.islower():
                    continue  # a common noun phrase
                if not stated and looks_personal(name):
                    kind = "person"
                whole = None if stated else whole_name(name)
                if kind != "person":
                    o = parse_organisation(name, kinds_seen)
                    if o:
                        out.append((name, "O", *o, "", "", n, None))
                        continue
                if kind == "org":
                    if head := whole_name(name):
                        out.append((name, "O", head, "full", "", "", "", "", n, None))
                    continue
                p = parse_person(name)
                if p:
                    surname, form, given, initial, middle, nick = p
                    out.append((name, "P", surname, form, given, initial, middle, nick, n, whole))
                elif stated and (head := whole_name(name)):
                    out.append((name, "P", head, "full", "", "", "", "", n, None))
                elif whole:
                    out.append((name, "?", whole, "full", "", "", "", "", n, whole))
            yield pd.DataFrame(out, columns=[c.split()[0] for c in PARSED.split(", ")])

    found = names.mapInPandas(run, PARSED)
    # A string of unknown type with the words of a stated organisation is that organisation.
    stated = found.filter((F.col("kind") == "O") & (F.col("sig") == "")).select(F.col("head").alias("whole"), F.lit(True).alias("org")).distinct()
    met = found.join(stated, "whole", "left").filter((F.col("kind") != "?") | F.col("org"))
    org = F.coalesce("org", F.lit(False))
    now = {"kind": F.lit("O"), "head": F.col("whole"), "form": F.lit("full"), **{c: F.lit("") for c in ("sig", "initial", "middle", "nick")}}
    return met.select(*[F.when(org, now[c]).otherwise(F.col(c)).alias(c) if c in now else F.col(c) for c in (x.split()[0] for x in PARSED.split(", ")[:-1])])


def collected_names(entities: DataFrame, claims: DataFrame) -> DataFrame:
    """(name, type, n): distinct strings of people, organisations and claim subjects; type null if only claims have it."""
    e = entities.select("name", "type").filter(F.col("name").isNotNull() & (F.col("name") != ""))
    counted = e.groupBy("name").agg(
        F.sum(F.when(F.col("type") == "person", 1).otherwise(0)).alias("p"), F.sum(F.when(F.col("type") == "org", 1).otherwise(0)).alias("o"), F.count("*").alias("n")
    )
    s = claims.select(F.col("subject").alias("name")).filter(F.col("name").isNotNull() & (F.col("name") != "")).groupBy("name").agg(F.count("*").alias("m"))
    both = counted.join(s, "name", "full")
    kind = F.when(F.col("n").isNull(), F.lit(None)).when((F.col("p") == 0) & (F.col("o") == 0), F.lit("other")).when(F.col("p") >= F.col("o"), F.lit("person")).otherwise(F.lit("org"))
    return both.select("name", kind.alias("type"), (F.coalesce("n", F.lit(0)) + F.coalesce("m", F.lit(0))).alias("n")).filter(F.coalesce(F.col("type") != "other", F.lit(True)))


# --- pigeonhole segment join ------------------------------------------------------------------------------------

SEGMENTS = 3


def _cuts(length: int) -> list[tuple[int, int]]:
    """Start and length of the k+1 segments of a word; the last ones are longer."""
    base, extra = divmod(length, SEGMENTS)
    out, at = [], 0
    for i in range(SEGMENTS):
        n = base + (i >= SEGMENTS - extra)
        out.append((at, n))
        at += n
    return out


def index_keys(word: str) -> set[str]:
    """Entries of the inverted index: the two segments one edit leaves alone, or one segment and the letters of a swap across a cut."""
    length = len(word)
    cut = _cuts(length)
    seg = [word[a : a + n] for a, n in cut]
    out = {f"{length}|{i}{j}|{seg[i]}|{seg[j]}" for i in range(SEGMENTS) for j in range(i + 1, SEGMENTS)}
    out |= {f"{length}|x{i}|{seg[i]}|{''.join(sorted(word[:cut[i][0]] + word[cut[i][0] + cut[i][1]:]))}" for i in range(SEGMENTS)}
    return out


def probe_keys(word: str) -> set[str]:
    """Substrings at the positions where the segments of a word within one edit can stand."""
    out = set()
    for length in (len(word) - 1, len(word), len(word) + 1):
        if length < 4:
            continue
        shift = len(word) - length
        cut = _cuts(length)

        def at(i: int, s: int) -> str:
            a, n = cut[i]
            return word[a + s : a + s + n]

        for i in range(SEGMENTS):
            for j in range(i + 1, SEGMENTS):
                edited = ({0, 1, 2} - {i, j}).pop()
                out.add(f"{length}|{i}{j}|{at(i, shift if edited < i else 0)}|{at(j, shift if edited < j else 0)}")
        if not shift:
            for i in range(SEGMENTS):
                a, n = cut[i]
                out.add(f"{length}|x{i}|{word[a:a + n]}|{''.join(sorted(word[:a] + word[a + n:]))}")
    return out


def near_words(words: DataFrame) -> DataFrame:
    """words(block, word) -> (block, word, other): pairs of different words of a block within one edit, both ways.

    Words of fewer than four letters have no near words.
    """
    def keyed(make):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                out = [(block, w, k) for block, w in zip(b["block"], b["word"]) if len(w) >= 4 for k in sorted(make(w))]
                yield pd.DataFrame(out, columns=["block", "word", "key"])

        return run

    distinct = words.select("block", "word").distinct()
    index = distinct.mapInPandas(keyed(index_keys), "block string, word string, key string").withColumnRenamed("word", "other")
    probe = distinct.mapInPandas(keyed(probe_keys), "block string, word string, key string")
    pairs = probe.join(index, ["block", "key"]).filter(F.col("word") != F.col("other")).select("block", "word", "other").distinct()

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b[[osa_within_one(x, y) for x, y in zip(b["word"], b["other"])]]

    return pairs.mapInPandas(verify, "block string, word string, other string")


def canonical_words(words: DataFrame, apart: DataFrame | None = None) -> DataFrame:
    """words(block, word, strings, mentions) -> (block, word, canon): misspelt words with the word they stand for.

    Within a block, a word goes to its near word that more different strings use (more mentions, then the alphabet,
    decide ties), from there to the next, and so on: pointers always lead to a greater word, so doubling them reaches
    the end of every chain.  apart(word): words that are known to be right and stay themselves.
    """
    words = cut_lineage(words)
    near = near_words(words.select("block", "word"))
    w = words.select("block", "word", F.struct("strings", "mentions", "word").alias("w"))
    other = w.select("block", F.col("word").alias("other"), F.col("w").alias("ow"))
    best = near.join(w, ["block", "word"]).join(other, ["block", "other"]).filter(F.col("ow") > F.col("w"))
    # A spelling that many strings use is a word of its own.
    best = best.filter((F.col("w.strings") <= 2) | (F.col("w.strings") * 3 <= F.col("ow.strings")))
    if apart is not None:
        best = best.join(apart, "word", "left_anti")
    best = cut_lineage(best.groupBy("block", "word").agg(F.max("ow").alias("ow")).select("block", "word", F.col("ow.word").alias("canon")))
    while True:
        step = best.select("block", F.col("word").alias("canon"), F.col("canon").alias("far"))
        further = best.join(step, ["block", "canon"], "left")
        if further.filter(F.col("far").isNotNull()).isEmpty():
            return best
        best = cut_lineage(further.select("block", "word", F.coalesce("far", "canon").alias("canon")))


def canonical_heads(parsed: DataFrame) -> DataFrame:
    """(kind, initial, head, canon): misspelt distinctive words with the word they stand for, within names of one kind and initial."""
    heads = parsed.filter(F.col("sig") != "").groupBy("kind", "initial", "head").agg(F.count("*").alias("strings"), F.sum("n").alias("mentions"))
    words = heads.select(F.concat_ws("|", "kind", "initial").alias("block"), F.col("head").alias("word"), "strings", "mentions")
    found = canonical_words(words)
    part = F.split("block", "\\|")
    return found.select(part[0].alias("kind"), part[1].alias("initial"), F.col("word").alias("head"), "canon")


def canonical_wholes(parsed: DataFrame) -> DataFrame:
    """(kind, head, canon): whole names of which single words are misspelt, each word put right by itself."""
    wholes = parsed.filter(F.col("sig") == "").groupBy("kind", "head").agg(F.count("*").alias("strings"), F.sum("n").alias("mentions"))
    tokens = wholes.select("kind", "head", "strings", "mentions", F.posexplode(F.split("head", " ")).alias("at", "word"))
    words = tokens.groupBy(F.col("kind").alias("block"), "word").agg(F.sum("strings").alias("strings"), F.sum("mentions").alias("mentions"))
    found = canonical_words(words).select(F.col("block").alias("kind"), "word", "canon")
    right = tokens.join(found, ["kind", "word"], "left").groupBy("kind", "head").agg(F.sort_array(F.collect_list(F.coalesce("canon", "word"))).alias("w"))
    return right.select("kind", "head", F.array_join("w", " ").alias("canon")).filter(F.col("canon") != F.col("head"))


def canonical_givens(people: DataFrame, known: DataFrame) -> DataFrame:
    """people(head, sig, n) -> (head, sig, given): misspelt given names, and unknown names written surname first.

    known(word): listed given names and nicknames, which are right as they are.
    """
    pairs = people.groupBy("head", "sig").agg(F.count("*").alias("strings"), F.sum("n").alias("mentions"))
    words = pairs.select(F.col("head").alias("block"), F.col("sig").alias("word"), "strings", "mentions")
    return canonical_words(words, known).select(F.col("block").alias("head"), F.col("word").alias("sig"), F.col("canon").alias("given"))


def turned_names(people: DataFrame, known: DataFrame) -> DataFrame:
    """people(head, sig, n) -> (head, sig): pairs of words also found the other way round and better attested so.

    Only where neither word is a listed given name; those have told their place already.
    """
    pairs = people.groupBy("head", "sig").agg(F.count("*").alias("strings"), F.sum("n").alias("mentions"))
    other = pairs.select(F.col("sig").alias("head"), F.col("head").alias("sig"), F.struct("strings", "mentions", F.col("head")).alias("there"))
    both = pairs.join(other, ["head", "sig"]).filter(F.col("there") > F.struct("strings", "mentions", F.col("sig")))
    for c in ("head", "sig"):
        both = both.join(known.select(F.col("word").alias(c)), c, "left_anti")
    return both.select("head", "sig")


def short_keys(kind: str, form: str, sig: str, nick: str) -> list[str]:
    """Short forms that a full name can be given by."""
    if kind == "P":
        if not sig:
            return []
        out = {f"i:{sig[0]}", *(f"x:{sig[:k]}" for k in range(2, max(5, len(sig)))), *(f"n:{x}" for x in NICKNAMES.get(sig, "").split())}
        if nick:
            out.add(f"n:{nick}")
        return sorted(out)
    w = sig.split()
    if not w:
        return []
    return sorted({f"a:{''.join(x[0] for x in w)}", f"p:{w[0]}", f"p:{' '.join(w[:2])}"})


def entity_names(entities: DataFrame, claims: DataFrame) -> DataFrame:
    """(name, entity): every string of a person or organisation with the key of the one it means.

    Null and empty names, places, products, events and common noun phrases have no row.  Strings that differ in case,
    spaces or accents only share a key.  A short form that fits several full names goes to the one with the same middle
    initial, else to the most mentioned one (ties by the alphabet); one that fits none is an entity of its own.
    """
    strings = cut_lineage(collected_names(entities, claims))
    parsed = cut_lineage(parsed_names(strings, learned_kinds(strings)))
    listed = parsed.sparkSession.createDataFrame([(w,) for w in sorted({*NICKNAMES, *_NICK})], "word string")
    fixed = canonical_heads(parsed)
    rows = parsed.join(fixed, ["kind", "initial", "head"], "left").join(canonical_wholes(parsed).withColumnRenamed("canon", "put_right"), ["kind", "head"], "left")
    # Nicknames of several names stand under either initial: their words are corrected through any initial.
    anyway = fixed.groupBy("kind", "head").agg(F.min("canon").alias("any"))
    rows = rows.join(anyway, ["kind", "head"], "left")
    full_heads = parsed.filter(F.col("form") == "full").select("kind", "head").distinct().withColumn("known", F.lit(True))
    rows = rows.join(full_heads, ["kind", "head"], "left")
    head = F.when(F.col("sig") == "", F.coalesce("put_right", "head")).otherwise(
        F.coalesce("canon", F.when((F.col("form") == "nick") & F.col("known").isNull(), F.col("any")), "head")
    )
    rows = cut_lineage(rows.select("name", "kind", head.alias("head"), "form", "sig", "initial", "middle", "nick", "n"))
    # People: given names that no list knows.
    person = (F.col("kind") == "P") & (F.col("form") == "full") & (F.col("sig") != "")
    turned = cut_lineage(turned_names(rows.filter(person), listed)).withColumn("turn", F.lit(True))
    rows = rows.join(turned, ["head", "sig"], "left")
    turn = person & F.col("turn").isNotNull()
    rows = rows.select("name", "kind", F.when(turn, F.col("sig")).otherwise(F.col("head")).alias("head"), "form", F.when(turn, F.col("head")).otherwise(F.col("sig")).alias("sig"), "initial", "middle", "nick", "n")
    given = canonical_givens(rows.filter(person), listed)
    rows = rows.join(given, ["head", "sig"], "left")
    sig = F.when(person, F.coalesce("given", "sig")).otherwise(F.col("sig"))
    initial = F.when(person, F.substring(sig, 1, 1)).otherwise(F.col("initial"))
    rows = cut_lineage(rows.select("name", "kind", "head", "form", sig.alias("sig"), initial.alias("initial"), "middle", "nick", "n"))

    full = rows.filter(F.col("form") == "full")
    keys = full.groupBy("kind", "head", "sig").agg(F.sum("n").alias("mentions"), F.collect_set(F.when(F.col("middle") != "", F.col("middle"))).alias("middles"), F.collect_set(F.when(F.col("nick") != "", F.col("nick"))).alias("nicks"))

    def expand(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for kind, h, sig, n, mids, nicks in zip(b["kind"], b["head"], b["sig"], b["mentions"], b["middles"], b["nicks"]):
                for k in sorted({k for nick in [*nicks, ""] for k in short_keys(kind, "full", sig, nick)}):
                    out.append((kind, h, k, sig, n, list(mids)))
            yield pd.DataFrame(out, columns=["kind", "head", "short", "full", "mentions", "middles"])

    shorts = keys.mapInPandas(expand, "kind string, head string, short string, full string, mentions bigint, middles array<string>")
    prefix = F.create_map(*[F.lit(x) for kv in (("initial", "i:"), ("prefix", "x:"), ("nick", "n:"), ("acronym", "a:"), ("part", "p:")) for x in kv])
    part = rows.filter(F.col("form") != "full").withColumn("short", F.concat(prefix[F.col("form")], "sig"))
    fits = part.join(shorts, ["kind", "head", "short"], "left")
    rank = F.struct(F.array_contains("middles", F.col("middle")), "mentions", "full")
    chosen = fits.groupBy("name", "kind", "head", "short", "initial").agg(F.max(F.when(F.col("full").isNotNull(), rank)).alias("best"))
    own = F.concat(F.lit("~"), "initial")
    a = full.select("name", F.concat_ws("|", "kind", "head", "sig").alias("entity"))
    b = chosen.select("name", F.concat_ws("|", "kind", "head", F.coalesce(F.col("best.full"), own)).alias("entity"))
    return a.unionByName(b)


def variant_pairs(entities: DataFrame, claims: DataFrame) -> DataFrame:
    """(name_a, name_b): all pairs of different strings that mean one person or organisation, name_a < name_b.

    The pairs of one entity are spread over SALTS tasks by their first name.
    """
    known = cut_lineage(entity_names(entities, claims))
    a = known.select("entity", F.col("name").alias("name_a"), F.pmod(F.xxhash64("name"), F.lit(SALTS)).cast("int").alias("salt"))
    b = known.select("entity", F.col("name").alias("name_b"), F.explode(F.array(*[F.lit(i) for i in range(SALTS)])).alias("salt"))
    return a.join(b, ["entity", "salt"]).filter(F.col("name_a") < F.col("name_b")).select("name_a", "name_b").distinct()


#: Tasks that share the pairs of one entity.
SALTS = 8
