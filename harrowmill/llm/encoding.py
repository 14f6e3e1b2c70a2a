"""Text read in the wrong character encoding (problem 4).

The channel: text was written as bytes of one encoding and read in another, once or more often.
Each pair of encodings gives characters that stand for lead and following bytes; stretches of such
characters are turned back into bytes and read rightly if that gives letters or signs in use.  Where no byte is
lost the byte lattice of a stretch is one path and needs no search.

Bytes that the wrong reading could not show are lost (U+FFFD), wildcards of the lattice.  The words of the whole
corpus are sent through every channel that loses bytes; the lattice they leave, written as text, is the key by which
they meet the damaged words that may have been them.
A Viterbi search takes the path of greatest frequency of words and word pairs through the stretch.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from harrowmill.session import cut_lineage, spread

LOST = "�"
#: Single-byte encodings in which UTF-8 is commonly misread, in the order they are tried.
SINGLE = ("cp1252", "latin-1", "mac_roman", "cp1251", "cp1250", "cp437", "cp850", "koi8_r")
#: Multi-byte encodings in which UTF-8 is commonly misread.
DOUBLE = ("cp949", "gbk", "cp932", "big5")
#: How many mentions of a word alone one mention beside the same neighbour is worth.
PAIR_WEIGHT = 50.0


def _image(codec: str) -> dict[int, str]:
    """Character shown for each byte from 0x80; bytes a code page leaves open are shown as control characters."""
    out = {}
    for b in range(0x80, 0x100):
        try:
            out[b] = bytes([b]).decode(codec)
        except UnicodeDecodeError:
            out[b] = chr(b)
    return out


class Family:
    """UTF-8 read as one single-byte encoding."""

    def __init__(self, codec: str):
        self.codec = codec
        image = _image(codec)
        self.byte = {c: b for b, c in image.items()}
        if codec == "cp1252":
            self.byte.update({chr(b): b for b in range(0x80, 0xA0)})
        of = lambda lo, hi: "[" + re.escape("".join(sorted({c for c, b in self.byte.items() if lo <= b <= hi}))) + "]"
        cont = of(0x80, 0xBF)
        self.lead = {c for c, b in self.byte.items() if 0xC2 <= b <= 0xF4}
        self.follow = {c for c, b in self.byte.items() if 0x80 <= b <= 0xBF}
        self.any = re.compile(f"(?:{of(0xC2, 0xDF)}{cont}|{of(0xE0, 0xEF)}{cont}{{2}}|{of(0xF0, 0xF4)}{cont}{{3}})+")
        # The no-break space after a lead byte is often turned into a space, or lost at the end of a word.
        lead = image[0xC3]
        self.space = re.compile(rf"(?<!\S){re.escape(lead)}(?= )") if codec in ("cp1252", "cp1251") else None

    def decode(self, run: str) -> str | None:
        try:
            return bytes(self.byte[c] for c in run).decode("utf-8")
        except (KeyError, UnicodeDecodeError):
            return None


def _plausible(text: str, least: int = 1) -> bool:
    """Letters and signs that a misread stretch gives when it is put right; single rare characters are chance.

    least: how many characters the stretches around have given already.
    """
    n = len(text) + least - 1
    for c in text:
        o = ord(c)
        if (o < 0xA0 and n < 2) or 0xE000 <= o <= 0xF8FF:
            return False
        # Latin letters and whatever a Western code page can show, as one layer of several may read.
        common = o <= 0x17F or 0x2010 <= o <= 0x2040 or o in (0x20AC, 0x2122, 0x192, 0x2C6, 0x2DC) or 0x300 <= o <= 0x301
        if not common and n < 2:
            return False
        if not common and not (
            0x370 <= o <= 0x5FF or 0x600 <= o <= 0x6FF or 0x900 <= o <= 0x97F or 0xE00 <= o <= 0xE7F or 0x1E00 <= o <= 0x1EFF or 0x2040 <= o <= 0x27BF
            or 0x3000 <= o <= 0x30FF or 0x3130 <= o <= 0x318F or 0x4E00 <= o <= 0x9FFF or 0xAC00 <= o <= 0xD7A3 or 0xFF00 <= o <= 0xFFEF or 0x1F300 <= o <= 0x1FAFF
        ):
            return False
    return True


_FAMILIES = [Family(c) for c in SINGLE if c != "latin-1"]
_LATIN = re.compile("[\x80-\xff]{4,}")
_LATIN_PAIRS = re.compile("(?<![A-Za-z])(?:[°-È][¡-þ])+(?![A-Za-z])")
_MIXED = re.compile("(?<=[A-Za-z])[ᄀ-ᇿ぀-ヿ㄰-㆏一-鿿가-힣｡-ﾟ]{1,2}|[ᄀ-ᇿ぀-ヿ㄰-㆏一-鿿가-힣｡-ﾟ]{1,2}(?=[a-z])")
_HAN_HANGUL = re.compile("[一-鿿豈-﫿][가-힣]|[가-힣][一-鿿豈-﫿]")
_LATIN_LETTERS = re.compile("[A-Za-z]")
_CYRILLIC = re.compile("[Ѐ-ӿ]")


def _hangul_pairs(run: str) -> str | None:
    """Korean EUC bytes shown as Latin letters, put right; None if they are not Hangul for the most part."""
    if len(run) % 2:
        return None
    try:
        out = run.encode("latin-1").decode("cp949")
    except (UnicodeDecodeError, UnicodeEncodeError):
        return None
    hangul = sum(0xAC00 <= ord(c) <= 0xD7A3 for c in out)
    return out if hangul >= 2 and hangul >= 0.6 * len(out) else None


def repair_once(text: str) -> tuple[str, int]:
    """(text with readable misread stretches put right, number of stretches): one layer of wrong reading."""
    hits = 0

    def replace(family: Family, least: int = 1):
        def sub(m: re.Match) -> str:
            nonlocal hits
            out = family.decode(m.group(0))
            if out is None or not _plausible(out, least):
                return m.group(0)
            hits += 1
            return out

        return sub

    def pairs(m: re.Match) -> str:
        nonlocal hits
        try:
            m.group(0).encode("latin-1").decode("utf-8")
            return m.group(0)  # left to the UTF-8 families
        except UnicodeDecodeError:
            out = _hangul_pairs(m.group(0))
        if out is None:
            return m.group(0)
        hits += 1
        return out

    if _LATIN.search(text):
        western = _FAMILIES[0].any
        if sum(len(m.group(0)) for m in western.finditer(text)) < 0.5 * sum("\x80" <= c <= "\xff" for c in text):
            text = _LATIN.sub(pairs, text)
    if hits:  # short words of the same stretch
        return _LATIN_PAIRS.sub(lambda m: m.group(0).encode("latin-1").decode("cp949", "replace"), text), hits

    foreign = {c for c in set(text) if c > "\x7f"}

    def explained(family: Family) -> int:
        """Stretches of the text that are sensibly read through the family, by their length."""
        total = 0
        if foreign.isdisjoint(family.lead) or foreign.isdisjoint(family.follow):
            return 0
        for m in family.any.finditer(text):
            out = family.decode(m.group(0))
            if out is not None and _plausible(out):
                total += len(m.group(0))
        if total and family.codec in ("cp1251", "koi8_r"):
            # Right Cyrillic text is full of such letters that explain nothing.
            own = sum(len(_CYRILLIC.findall(m.group(0))) for m in family.any.finditer(text))
            return total if own >= 0.8 * len(_CYRILLIC.findall(text)) else 0
        return total

    for rank in (_FAMILIES[:3], _FAMILIES[3:]):
        scores = [explained(f) for f in rank]
        if not max(scores):
            continue
        best = rank[scores.index(max(scores))]
        # Where much is explained, single characters of the same reading are taken as well.
        text = best.any.sub(replace(best, 2 if max(scores) >= 4 else 1), text)
        if best.space and hits and best.space.search(text):
            text = best.space.sub("à", text)
        if hits:
            return text, hits

    def mixed(m: re.Match) -> str:
        nonlocal hits
        for codec in DOUBLE:
            try:
                out = m.group(0).encode(codec).decode("utf-8")
            except (UnicodeDecodeError, UnicodeEncodeError):
                continue
            if all(0xC0 <= ord(c) <= 0x17F or 0x2018 <= ord(c) <= 0x201D for c in out):
                hits += 1
                return out
        return m.group(0)

    text = _MIXED.sub(mixed, text)
    return text, hits


def misread_double(text: str) -> bool:
    """Hangul in UTF-8 read as a Korean code page: Chinese and Korean characters mixed, most bytes again valid UTF-8."""
    runs = _HAN_HANGUL.findall(text)
    if len(runs) < 3:
        return False
    data = text.encode("cp949", "ignore")
    good = len(re.findall(rb"[\xea-\xed][\x80-\xbf]{2}", data))
    return good * 3 >= 0.3 * sum(b > 0x7F for b in data)


def repair(text: str) -> tuple[str, int]:
    """Text with every readable layer put right, and how many layers there were."""
    layers = 0
    while True:
        fixed, hits = repair_once(text)
        if not hits or fixed == text:
            return text, layers
        text = fixed
        layers += 1


def is_damaged(text: str | None) -> bool:
    """True if a stretch of the text was read in a wrong encoding or holds lost characters."""
    if not text or text.isascii():
        return False
    return LOST in text or repair_once(text)[1] > 0 or misread_double(text)


def fields_of(contents: DataFrame, raw: DataFrame) -> DataFrame:
    """(record_table, record_id, field, value) of html, title and body, null values left out."""
    c = contents.select(F.lit("contents").alias("record_table"), F.col("id").alias("record_id"), F.explode(F.create_map(F.lit("title"), F.col("title"), F.lit("body"), F.col("body"))).alias("field", "value"))
    r = raw.select(F.lit("raw_contents").alias("record_table"), F.col("id").alias("record_id"), F.lit("html").alias("field"), F.col("html").alias("value"))
    return c.unionByName(r).filter(F.col("record_id").isNotNull() & F.col("value").isNotNull())


def damaged_fields(fields: DataFrame) -> DataFrame:
    """(record_table, record_id, field, layers, lost, text) of misread fields; text has the readable stretches put right.

    lost: characters are missing that only the corpus can tell (restore_lost).  Fields in plain ASCII are passed over
    before Python sees them; null and empty fields and right unusual letters are no cases.
    """

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for table, rid, field, value in zip(b["record_table"], b["record_id"], b["field"], b["value"]):
                fixed, layers = repair(value)
                lost = LOST in value or misread_double(fixed)
                if layers or lost:
                    out.append((table, rid, field, layers, lost, fixed))
            yield pd.DataFrame(out, columns=["record_table", "record_id", "field", "layers", "lost", "text"])

    foreign = fields.filter(F.col("value").rlike(r"[^\x00-\x7f]"))
    return spread(foreign, "record_id").mapInPandas(find, "record_table string, record_id string, field string, layers int, lost boolean, text string")


# --- lost bytes -------------------------------------------------------------------------------------------------


def lattice(word: str, written: str, read: str) -> list[str | None]:
    """What the bytes of a right word show when they are read in another encoding; None stands for bytes that show nothing.

    UnicodeEncodeError where the word cannot be written so.
    """
    return [None if c == LOST else c for c in word.encode(written).decode(read, "replace")]


def lattice_key(cells: list[str | None], read: str) -> str:
    """A lattice as text: wildcards as U+FFFD, and what a single-byte reading left readable put right, as repair does."""
    seen = "".join(LOST if c is None else c for c in cells)
    family = _BY_CODEC.get(read)
    return family.any.sub(lambda m: family.decode(m.group(0)) or m.group(0), seen) if family else seen


_BY_CODEC = {f.codec: f for f in _FAMILIES}
#: Channels that lose bytes: single-byte text read as UTF-8, and UTF-8 read in encodings that leave bytes open.
LOSSY = (*((c, "utf-8") for c in SINGLE), *(("utf-8", c) for c in ("cp949", "cp1251", "cp1252", "cp1250")))


def through_channels(word: str) -> list[tuple[str, str]]:
    """(lattice key, channel) of a right word after each channel that loses bytes of it; equal keys are given once."""
    out: dict[str, str] = {}
    for written, read in LOSSY:
        try:
            cells = lattice(word, written, read)
        except UnicodeEncodeError:
            continue
        key = lattice_key(cells, read)
        if (None in cells or read == "cp949") and key != word:
            out.setdefault(key, f"{written}>{read}")
    return list(out.items())


def viterbi(cells: list[list[tuple[str, float]]], pairs: dict[tuple[str, str], float] | None = None) -> list[str | None]:
    """Most likely word for each cell of a stretch; cells without words break it and stay None."""
    best: list[str | None] = [None] * len(cells)
    k = 0
    while k < len(cells):
        if not cells[k]:
            k += 1
            continue
        stop = k
        while stop < len(cells) and cells[stop]:
            stop += 1
        score = [np.array([s for _, s in cells[k]])]
        back: list[np.ndarray] = []
        for i in range(k + 1, stop):
            step = np.array([[(pairs or {}).get((a, b), 0.0) for a, _ in cells[i - 1]] for b, _ in cells[i]])
            total = step + score[-1][None, :]
            back.append(total.argmax(axis=1))
            score.append(total.max(axis=1) + np.array([s for _, s in cells[i]]))
        at = int(score[-1].argmax())
        for i in range(stop - 1, k - 1, -1):
            best[i] = cells[i][at][0]
            if i > k:
                at = int(back[i - k - 1][at])
        k = stop
    return best


_EDGE = re.compile(r"^([\x00-\x2f:-@\[-`{-\x7f]*)(.*?)([\x00-\x2f:-@\[-`{-\x7f]*)$", re.S)


#: What stands between words; in html also tags, with the words in their attributes left to be read.
CUT = r"\s+"
HTML_CUT = r"""\s+|<[^\s<>]*|>|[A-Za-z][A-Za-z0-9:_-]*=["']"""
_CUTS_OF = {True: re.compile(f"({HTML_CUT})"), False: re.compile(f"({CUT})")}


def _core(token: str) -> str:
    return _EDGE.match(token).group(2)


def _parts(text: str, field: str) -> list[str]:
    """Words at even places, what stands between them at odd ones; together the text."""
    return _CUTS_OF[field == "html"].split(text)


def _is_spot(token: str) -> bool:
    return not token.isascii() and (LOST in token or _HAN_HANGUL.search(token) is not None)


def restore_lost(damaged: DataFrame, fields: DataFrame, *, candidates: int = 8) -> DataFrame:
    """damaged_fields with lost characters filled in: (record_table, record_id, field, text, restored, open).

    Word frequencies are counted over all fields that are not damaged, with no limit on the vocabulary; words meet
    damaged words by a join on their shape after the channel.  restored and open count damaged words of the field.
    Where several words have the shape, their pairs with the words that stand beside the damaged one are counted over
    the same fields.  The `candidates` most frequent words of a shape and those seen beside its neighbours enter the search.
    """
    keys = ["record_table", "record_id", "field"]
    lost = cut_lineage(damaged.filter("lost").select(*keys, "text").dropDuplicates(keys))
    right = fields.filter(F.col("value").rlike(r"[^\x00-\x7f]")).join(damaged.select(*keys), keys, "left_anti")
    text = F.when(F.col("field") == "html", F.regexp_replace("value", r"<[^>]*>", " ")).otherwise(F.col("value"))
    tokens = right.select(F.explode(F.split(text, r"\s+")).alias("token")).filter(F.col("token").rlike(r"[^\x00-\x7f]"))
    counts = tokens.groupBy("token").agg(F.count("*").alias("n"))

    def shapes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = [(s, _core(t), int(n)) for t, n in zip(b["token"], b["n"]) for s, _ in through_channels(_core(t))]
            yield pd.DataFrame(out, columns=["shape", "word", "n"])

    vocabulary = counts.mapInPandas(shapes, "shape string, word string, n bigint").groupBy("shape", "word").agg(F.sum("n").alias("n"))

    def cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = sorted({_core(t) for x, f in zip(b["text"], b["field"]) for t in _parts(x, f)[::2] if _is_spot(t)})
            yield pd.DataFrame({"shape": out})

    # Cells without any known character fit every word of their length and are left open.
    wanted = lost.mapInPandas(cells, "shape string").distinct().filter(F.translate("shape", LOST, "") != "")
    options = cut_lineage(vocabulary.join(wanted, "shape"))
    several = options.groupBy("shape").agg(F.count("*").alias("k")).filter("k > 1").select("shape")
    unsure = options.join(several, "shape").select("shape", "word", "n")

    def beside(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for x, f in zip(b["value"], b["field"]):
                t = [_core(w) for w in _parts(x, f)[::2] if w]
                for i, w in enumerate(t):
                    if not w.isascii():
                        out += [(w, t[j], j > i) for j in (i - 1, i + 1) if 0 <= j < len(t)]
            yield pd.DataFrame(out, columns=["word", "other", "after"])

    def asked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = set()
            for x, f in zip(b["text"], b["field"]):
                raw = [w for w in _parts(x, f)[::2] if w]
                for i, w in enumerate(raw):
                    if _is_spot(w):
                        out |= {(_core(w), _core(raw[j]), j > i, _is_spot(raw[j])) for j in (i - 1, i + 1) if 0 <= j < len(raw)}
            yield pd.DataFrame(sorted(out), columns=["shape", "other", "after", "spot"])

    # A damaged neighbour stands for each of its own words.
    near = lost.mapInPandas(asked, "shape string, other string, after boolean, spot boolean").distinct().join(several, "shape")
    theirs = options.select(F.col("shape").alias("other"), F.col("word").alias("meant"))
    near = near.filter("not spot").select("shape", "other", "after").unionByName(
        near.filter("spot").join(theirs, "other").select("shape", F.col("meant").alias("other"), "after")
    ).distinct()
    pairs = right.select("value", "field").mapInPandas(beside, "word string, other string, after boolean")
    pairs = pairs.join(unsure.select("word").distinct(), "word", "left_semi").groupBy("word", "other", "after").agg(F.count("*").alias("m"))
    met = unsure.join(near, "shape").join(pairs, ["word", "other", "after"])
    met = met.groupBy("shape", "word").agg(F.collect_list(F.struct("other", "after", "m")).alias("beside"))
    # The most frequent words of a shape are cut within each task before they meet; then those seen beside its neighbours.
    first = options.withColumn("rank", F.row_number().over(Window.partitionBy("shape").orderBy(F.desc("n"), F.desc("word")))).filter(F.col("rank") <= candidates).drop("rank")
    first = first.join(met, ["shape", "word"], "left")
    ranked = first.unionByName(met.join(options, ["shape", "word"]).join(first.select("shape", "word"), ["shape", "word"], "left_anti"))
    ranked = ranked.groupBy("shape").agg(F.sort_array(F.collect_list(F.struct("n", "word", "beside")), asc=False).alias("words"))
    # Candidates are brought to the fields that need them: one row per field and shape, gathered per field.
    pieces = F.when(F.col("field") == "html", F.split("text", HTML_CUT)).otherwise(F.split("text", CUT))
    need = lost.select(*keys, F.explode(F.array_distinct(pieces)).alias("token")).filter(F.col("token").rlike(r"[^\x00-\x7f]"))
    need = need.withColumn("shape", F.regexp_replace("token", r"^[\x00-\x2f:-@\[-`{-\x7f]+|[\x00-\x2f:-@\[-`{-\x7f]+$", ""))
    found = need.select(*keys, "shape").distinct().join(ranked, "shape").groupBy(*keys).agg(F.collect_list(F.struct("shape", "words")).alias("found"))

    def fill(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for table, rid, field, text, known in zip(b["record_table"], b["record_id"], b["field"], b["text"], b["found"]):
                words = {k["shape"]: [(w["word"], float(np.log(w["n"]))) for w in k["words"]] for k in (known if known is not None else [])}
                parts = _parts(text, field)
                spots = [i for i in range(0, len(parts), 2) if _is_spot(parts[i])]
                # A word that is lost as a whole says nothing about itself.
                at = {i: words.get(k, []) if (k := _core(parts[i])).strip(LOST) else [] for i in spots}
                bonus: dict[tuple[str, str], float] = {}
                for k in known if known is not None else []:
                    for w in k["words"]:
                        for p in w["beside"] if w["beside"] is not None else []:
                            pair = (w["word"], p["other"]) if p["after"] else (p["other"], w["word"])
                            bonus[pair] = max(bonus.get(pair, 0.0), float(np.log1p(PAIR_WEIGHT * p["m"] / w["n"])))
                # Damaged words with the sound ones beside them; an empty cell parts what is not adjacent.
                told = [i for i in range(0, len(parts), 2) if parts[i]]
                beside_spot = {told[j] for n, i in enumerate(told) if i in at for j in (n - 1, n, n + 1) if 0 <= j < len(told)}
                order, cells = [], []
                for i in told:
                    order.append(i)
                    cells.append(at[i] if i in at else [(_core(parts[i]), 0.0)] if i in beside_spot else [])
                best = dict(zip(order, viterbi(cells, bonus)))
                chosen = [best[i] for i in spots]
                for i, w in zip(spots, chosen):
                    if w is not None:
                        left, _, after = _EDGE.match(parts[i]).groups()
                        parts[i] = left + w + after
                done = sum(w is not None for w in chosen)
                out.append((table, rid, field, "".join(parts), done, len(spots) - done))
            yield pd.DataFrame(out, columns=[*keys, "text", "restored", "open"])

    return lost.join(found, keys, "left").mapInPandas(fill, "record_table string, record_id string, field string, text string, restored int, open int")
