"""Page boilerplate apart from main content (problem 6).

Pages are cut into flat text blocks.  Word count and link density of a block and of its neighbours
go to a decision tree, which is grown on a small table labelled by pages that mark their article
and navigation elements.  Lines of stored bodies have no markup left: they get the roles, word counts and link
densities of the page blocks with the same letters, and with those of their neighbours and their own shape go to
a second tree of the same kind, whose labels come from lines of bodies beside the main blocks of their own pages.

Both labelled tables are bounded samples (PAGES pages, RECORDS records, those with the smallest hash of the id,
whatever the number of rows); block roles, line frequencies and all decisions cover every page and record.
"""

from __future__ import annotations

import hashlib
import re
import warnings
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harrowmill.functions.urls import normalize_or_keep
from harrowmill.llm import residue
from harrowmill.llm.pages import HEADINGS, Block, page_blocks
from harrowmill.llm.trees import grow, predict
from harrowmill.session import cut_lineage, spread

#: Most pages and records in the labelled tables.
PAGES, RECORDS = 400, 1500
#: How many times as many rows as wanted the pool of a sample holds at first.
POOL = 16
#: Salted copies of the line figures in the join with lines.
SALTS = 8
#: Blocks that must show a text before its role counts, and lines of a source with one pointer word.
LEAST_SEEN = 3
#: Keys a task counts before it hands them on.
HELD_KEYS = 200_000
MARKED_MAIN, MARKED_REST = {"article", "main"}, {"nav", "aside", "footer", "header", "menu", "dialog"}
MARKED = r"(?i)<(?:article|main)[\s>]", r"(?i)<(?:nav|aside|footer)[\s>]"


def block_features(blocks: list[Block]) -> np.ndarray:
    """Words and link density of each block, its neighbour before and its neighbour after."""
    w = np.array([b.words for b in blocks], dtype=float)
    d = np.array([b.linked / b.words if b.words else 0.0 for b in blocks])
    before = lambda v: np.concatenate([[0.0], v[:-1]])
    after = lambda v: np.concatenate([v[1:], [0.0]])
    return np.column_stack([w, d, before(w), before(d), after(w), after(d)])


def main_flags(blocks: list[Block], tree: tuple) -> list[bool]:
    """The element that holds most words of blocks judged as content is the article; all its blocks are main.

    A page without such a block has no main content.  Headings belong to the article but are not body text.
    """
    if not blocks:
        return []
    content = predict(tree, block_features(blocks)) >= 0.5
    weight: dict[int, int] = {}
    for b, c in zip(blocks, content):
        if c:
            for e in {b.element, b.parent}:
                weight[e] = weight.get(e, 0) + b.words
    if not weight:
        return [False] * len(blocks)
    # Of elements with equal weight the innermost one is taken.
    best = max(weight, key=lambda e: (weight[e], e))
    # Where the article's text stands in the element itself, its child elements must be content on their own.
    direct = sum(b.words for b, c in zip(blocks, content) if c and b.element == best) * 2 > weight[best]
    inside = [(b.element == best or b.parent == best and (c or not direct)) and "small" not in b.path for b, c in zip(blocks, content)]
    # Beyond a rule the article goes on only if there is content again.
    sections = {b.section for b, c, i in zip(blocks, content, inside) if c and i}
    return [i and b.section in sections and not (b.path and b.path[-1] in HEADINGS) and b.linked <= b.words / 2 for b, i in zip(blocks, inside)]


def smallest(df: DataFrame, column: str, most: int, picked: Callable[[DataFrame], DataFrame] = lambda pool: pool) -> list:
    """At most `most` rows of picked(df), those with the smallest hash of a column: the same ones at every run.

    picked sees the POOL * most rows of df with the smallest hashes, give or take chance, so neither it nor the driver
    is given more at any size; where fewer than a quarter of `most` come out of them the pool is widened, at last to
    all of df.
    """
    share = POOL * most / max(1, df.count())
    while True:
        pool = df if share >= 1 else df.filter(F.xxhash64(column) <= int(-(2**63) + share * 2**64))
        rows = picked(pool).orderBy(F.xxhash64(column), column).limit(most).collect()
        if share >= 1 or 4 * len(rows) >= most:
            return rows
        share *= POOL


def page_tree(raw: DataFrame) -> tuple:
    """Tree for page blocks, grown on at most PAGES pages that mark article and navigation.

    Where no page marks them there is nothing to learn from: a warning is given and long text with few links is content.
    """
    marked = lambda pool: pool.filter(F.col("html").rlike(MARKED[0]) & F.col("html").rlike(MARKED[1]))
    xs, ys = [], []
    for page in smallest(raw.select("id", "html").filter(F.col("id").isNotNull()), "id", PAGES, marked):
        blocks = page_blocks(page["html"])
        if not blocks:
            continue
        x = block_features(blocks)
        for row, b in zip(x, blocks):
            path = set(b.path)
            if (path & MARKED_REST) or not path & MARKED_MAIN:
                xs.append(row), ys.append(0.0)
            elif b.path[-1] not in HEADINGS:
                xs.append(row), ys.append(1.0)
    if len(set(ys)) < 2:
        warnings.warn("no page marks its article and navigation: blocks are told by length and links alone", stacklevel=2)
        return (0, 12.0, (0.0,), (1, 0.34, (1.0,), (0.0,)))
    return grow(np.array(xs), np.array(ys), depth=5, least=25)


def main_text(raw: DataFrame, tree: tuple | None = None) -> DataFrame:
    """(raw_id, body): main blocks of each page, one per line; pages without main content have no row.

    Each row of raw is a page of its own, also where an id is repeated; nothing is shuffled.
    """
    tree = tree or page_tree(raw)

    def keep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for i, page in zip(batch["raw_id"], batch["html"]):
                blocks = page_blocks(page)
                body = "\n".join(b.text for b, m in zip(blocks, main_flags(blocks, tree)) if m)
                if body:
                    out.append((i, body))
            yield pd.DataFrame(out, columns=["raw_id", "body"])

    pages = raw.select(F.col("id").alias("raw_id"), "html").filter(F.col("html").isNotNull())
    return spread(pages, "raw_id").mapInPandas(keep, "raw_id string, body string")


# --- lines of stored bodies -------------------------------------------------------------------------------------

_LETTERS = re.compile(r"[\W\d_]+")
_POINTER = re.compile(r"^\W*([^\W\d_][^:>»\]]{0,28}?)\s*(?::|>|»|\])\s+\S")
_SENTENCE_END = re.compile(r"[.!?…。][\"”’')\]»\s]*(?:lol)?\W*$")
_INNER = re.compile(r"[.!?…。][\"”’')]*\s+\S")
_NUMBERED = re.compile(r"^\s*\d{1,2}[.)]\s+\S")
_SEPARATED = re.compile(r"\s[|·/•\-–>]\s")

SHAPE = ["words", "ends_sentence", "inner_sentence", "numbered", "separators", "crumb", "pointer", "pointer_rest_words", "has_author"]
LINE_FEATURES = [
    "chrome_share", "seen", *SHAPE[:6], "pointer_n", "pointer_rest_words", "line_df", "before_chrome", "after_chrome", "has_author", "headline",
    "run_after_chrome", "run_before_chrome", "link_density", "before_density", "after_density", "before_words", "after_words",
]


def slotted_key(line: str, name: str | None) -> str:
    """Letters of a line in lower case, the name of its site taken out."""
    low = line.lower()
    if name and name in (low := " ".join(low.split())):
        low = low.replace(name, " ")
    return _LETTERS.sub("", low)


def digest(key: str) -> bytes:
    return hashlib.md5(key.encode()).digest()


def line_shape(t: str, author: str | None) -> tuple:
    """SHAPE of a stripped line, and its pointer word; author in lower case."""
    p = _POINTER.match(t)
    rest = t[p.end() - 1 :] if p else ""
    bare = t.rstrip(" >:!*[]").strip() or t
    ends = bool(_SENTENCE_END.search(t, max(0, len(t) - 40))) and not t.endswith((" !", " .", ":"))
    return (
        (len(t.split()), ends, _INNER.search(t) is not None, _NUMBERED.match(t) is not None, len(_SEPARATED.findall(bare)), " > " in bare, p is not None,
         len(rest.split()), bool(author) and author in " ".join(t.lower().split())),
        p.group(1) if p else None,
    )


def _role_keys(blocks: list[Block], main: list[bool], name: str | None) -> Iterator[tuple[str, bool, int, int]]:
    """(letters, main, linked words, words) of each block of a page, of its lines, and of each run of short links."""
    run: list[str] = []
    for b, m in zip(blocks, main):
        whole = slotted_key(b.text, name)
        pieces = {whole}
        if len(b.pieces) > 1 or " · " in b.text:
            pieces.update(slotted_key(x, name) for p in b.pieces for x in p.split(" · "))
        if len(b.text) <= 24 and not m:
            run.append(whole)
        else:
            if len(run) > 2:
                yield "".join(run), False, 1, 1
            run = []
        for k in pieces:
            if k:
                yield k, bool(m), b.linked, b.words
    if len(run) > 2:
        yield "".join(run), False, 1, 1


PAGE_ROW = f"digest binary, chrome bigint, main bigint, linked bigint, words bigint, segment {residue.SEGMENT}"


def page_figures(raw: DataFrame, tree: tuple) -> DataFrame:
    """PAGE_ROW: what lines need of the pages, in one pass over them.

    Rows with a digest count the blocks that show these letters, by role, combined within a task; the others are the
    segments of problem 1.  Pages without html have none.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[bytes, list[int]] = {}
        columns = ["digest", "chrome", "main", "linked", "words", "segment"]

        def counted() -> pd.DataFrame:
            rows = [(k, *v, None) for k, v in held.items()]
            held.clear()
            return pd.DataFrame(rows, columns=columns)

        for batch in batches:
            out = []
            for i, url, name, status, page in zip(batch["id"], batch["url"], batch["source"], batch["status_code"], batch["html"]):
                blocks = page_blocks(page)
                low = " ".join(name.lower().split()) if name else None
                for key, main, linked, words in _role_keys(blocks, main_flags(blocks, tree), low):
                    k = digest(key)
                    v = held.get(k)
                    if v is None:
                        v = held[k] = [0, 0, 0, 0]
                    v[main] += 1
                    v[2] += linked
                    v[3] += words
                found = residue.page_segment(i, page, url, name, status, blocks) if i is not None else None
                if found:
                    out.append((None, 0, 0, 0, 0, found))
            yield pd.DataFrame(out, columns=columns)
            if len(held) >= HELD_KEYS:
                yield counted()
        yield counted()

    pages = raw.select("id", "url", F.col("source.name").alias("source"), residue.given(raw, "status_code", "int"), "html").filter(F.col("html").isNotNull())
    return spread(pages, "id").mapInPandas(count, PAGE_ROW)


RECORD = f"row binary, id string, source_id string, line_no array<int>, shape binary, digests array<binary>, segment {residue.SEGMENT}"


def record_lines(contents: DataFrame, sources: DataFrame) -> DataFrame:
    """RECORD: per record its non-blank lines as digests and packed shapes, and its segment for problem 1, in one pass.

    digests holds one of each line, then one of each line's pointer word or null.  row tells different bodies under
    one id apart.  Records without id or body have no row.
    """
    names = sources.select(F.col("source_id").alias("_sid"), F.col("name").alias("_name")).filter(F.col("_sid").isNotNull()).dropDuplicates(["_sid"])
    base = contents.select("id", "source_id", "body", "author", "title", "url").filter(F.col("id").isNotNull() & F.col("body").isNotNull())
    base = base.join(names, base.source_id == names._sid, "left").select("id", "source_id", "body", "author", "title", "url", "_name")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for i, sid, body, author, title, url, name in zip(batch["id"], batch["source_id"], batch["body"], batch["author"], batch["title"], batch["url"], batch["_name"]):
                low, writer = " ".join(name.lower().split()) if name else None, author.lower() if author else None
                number, shapes, lines, pointers = [], [], [], []
                for k, line in enumerate(body.split("\n")):
                    t = line.strip()
                    if not t:
                        continue
                    shape, pointer = line_shape(t, writer)
                    number.append(k)
                    shapes += shape
                    lines.append(digest(slotted_key(line, low)))
                    pointers.append(digest("\x01" + slotted_key(pointer, None)) if pointer is not None else None)
                if number:
                    row = hashlib.md5(f"{i}\x00{body}".encode("utf-8", "replace")).digest()
                    out.append((row, i, sid, number, np.array(shapes, dtype=np.float32).tobytes(), lines + pointers, residue.body_segment(i, body, title, url, sid)))
            yield pd.DataFrame(out, columns=["row", "id", "source_id", "line_no", "shape", "digests", "segment"])

    return spread(base, "id").mapInPandas(cut, RECORD)


def _keyed(records: DataFrame) -> DataFrame:
    return records.select("row", F.coalesce("source_id", F.lit("")).alias("source_id"), F.posexplode("digests").alias("pos", "digest")).filter(F.col("digest").isNotNull())


def line_figures(records: DataFrame, pages: DataFrame) -> DataFrame:
    """(source_id, digest, n, chrome, main, linked, words): repeated lines and pointers of a source, and lines whose letters pages show."""
    known = pages.filter(F.col("digest").isNotNull()).groupBy("digest").agg(*[F.sum(c).alias(c) for c in ("chrome", "main", "linked", "words")])
    known = known.filter(F.col("chrome") + F.col("main") >= LEAST_SEEN)
    counted = _keyed(records).groupBy("source_id", "digest").agg(F.count("*").alias("n"))
    out = counted.join(known, "digest", "left").filter((F.col("n") >= 2) | F.col("chrome").isNotNull())
    return out.select("source_id", "digest", "n", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("chrome", "main", "linked", "words")])


def with_figures(records: DataFrame, figures: DataFrame) -> DataFrame:
    """records(row, ...) with hits, the figures of those of its lines and pointers that have any.

    Only digests are shuffled with the figures, salted as one line may stand in a third of all records.
    """
    salted = figures.withColumn("salt", F.explode(F.array(*[F.lit(i) for i in range(SALTS)])))
    keyed = _keyed(records).withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int"))
    met = keyed.join(salted, ["source_id", "digest", "salt"])
    hit = F.struct("pos", F.col("n").cast("double").alias("n"), *[F.col(c).cast("double").alias(c) for c in ("chrome", "main", "linked", "words")])
    per = met.groupBy("row").agg(F.collect_set(hit).alias("hits"))
    return records.select("row", "id", "line_no", "shape", "digests").join(per, "row", "left")


def feature_table(line_no: pa.Array, shape: list[bytes], hits: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(lines per record, LINE_FEATURES of all lines of a batch of records, one after the other).

    A headline is an unpunctuated line of middle length that no page shows as fixed text; a run of headlines is
    judged by the fixed line that stands before or after it.
    """
    n = np.diff(np.asarray(line_no.offsets)).astype(np.int64)
    base = np.concatenate([[0], np.cumsum(n)])
    total = int(base[-1])
    first = base[:-1]
    s = np.frombuffer(b"".join(shape), dtype=np.float32).reshape(total, len(SHAPE)).astype(float)
    chrome, main, linked, words, pointer_n = (np.zeros(total) for _ in range(5))
    df = np.ones(total)
    if len(hits.flatten()):
        k = np.repeat(np.arange(len(n)), hits.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
        flat = hits.flatten()
        field = lambda name: flat.field(name).to_numpy(zero_copy_only=False)
        pos, count = field("pos").astype(np.int64), field("n")
        of_line = pos < n[k]
        at = first[k] + pos % n[k]
        line, pointer = at[of_line], at[~of_line]
        chrome[line], main[line], linked[line], words[line] = (field(c)[of_line] for c in ("chrome", "main", "linked", "words"))
        df[line] = np.maximum(count[of_line], 1)
        pointer_n[pointer] = np.where(count[~of_line] >= LEAST_SEEN, count[~of_line], 0)
    seen = chrome + main
    share = np.where(seen > 0, chrome / np.maximum(seen, 1), 0.5)
    density = np.where(words > 0, linked / np.maximum(words, 1), -1.0)
    opens, closes = np.zeros(total, bool), np.zeros(total, bool)
    opens[first], closes[base[1:] - 1] = True, True

    def before(v: np.ndarray, edge: float) -> np.ndarray:
        return np.where(opens, edge, np.concatenate([[edge], v[:-1]]))

    def after(v: np.ndarray, edge: float) -> np.ndarray:
        return np.where(closes, edge, np.concatenate([v[1:], [edge]]))

    headline = (seen == 0) & (s[:, 1] == 0) & (s[:, 2] == 0) & (s[:, 0] >= 3) & (s[:, 0] <= 24) & (df < 4) & (s[:, 8] == 0)

    def run_edge(fixed: np.ndarray, start: np.ndarray) -> np.ndarray:
        """For headlines whether the last line that is none, within the record, is fixed text."""
        last = np.maximum.accumulate(np.where(headline, -1, np.arange(total)))
        return np.where(headline & (last >= start), fixed[np.maximum(last, 0)], 0.0)

    fixed = share > 0.8
    start = np.repeat(first, n)
    forward = run_edge((fixed | (s[:, 5] > 0)).astype(float), start)
    # The same from the end: arrays turned round.
    turn = lambda v: v[::-1]
    last = np.maximum.accumulate(np.where(turn(headline), -1, np.arange(total)))
    begin = total - 1 - turn(np.repeat(base[1:] - 1, n))
    backward = turn(np.where(turn(headline) & (last >= begin), turn(fixed.astype(float))[np.maximum(last, 0)], 0.0))
    x = np.column_stack([
        share, np.minimum(np.log1p(seen), 8.0), s[:, 0], s[:, 1], s[:, 2], s[:, 3], s[:, 4], s[:, 5],
        np.where(s[:, 6] > 0, np.log1p(pointer_n), 0.0), np.where(s[:, 6] > 0, s[:, 7], 0.0), np.log1p(df),
        before(share, 0.5), after(share, 0.5), s[:, 8], headline.astype(float), forward, backward,
        density, before(density, -1.0), after(density, -1.0), before(s[:, 0], 0.0), after(s[:, 0], 0.0),
    ])
    return n, x


def line_tree(contents: DataFrame, raw: DataFrame, blocks: tuple, records: DataFrame, figures: DataFrame, spoilt: DataFrame) -> tuple:
    """Tree for lines of bodies.  A line is labelled content if its letters stand in a main block of the record's own page.

    At most RECORDS records with a page take part.  Without any, a warning is given: links and fixed page lines cannot
    be told then, only pointers, paths and numbered headlines.
    """
    spark = contents.sparkSession
    pages = raw.filter(F.col("html").isNotNull()).select(normalize_or_keep(F.col("url")).alias("_u"))

    def paired(pool: DataFrame) -> DataFrame:
        urls = pool.select("id", normalize_or_keep(F.col("url")).alias("_u")).filter(F.col("_u").isNotNull())
        return urls.join(pages.join(urls.select("_u").distinct(), "_u", "left_semi").distinct(), "_u", "left_semi").join(spoilt, "id", "left_anti")

    picked = smallest(contents.select("id", "url").filter(F.col("id").isNotNull()), "id", RECORDS, paired)
    if picked:
        chosen = F.broadcast(spark.createDataFrame([(r["id"], r["_u"]) for r in picked], "id string, _u string").distinct())

        def keys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                out = []
                for url, name, page in zip(batch["_u"], batch["source"], batch["html"]):
                    found = page_blocks(page)
                    low = " ".join(name.lower().split()) if name else None
                    out.append((url, [digest(slotted_key(x, low)) for b, m in zip(found, main_flags(found, blocks)) if m for x in {b.text, *b.pieces}]))
                yield pd.DataFrame(out, columns=["_u", "keys"])

        shown = raw.select(normalize_or_keep(F.col("url")).alias("_u"), F.col("source.name").alias("source"), "html").filter(F.col("html").isNotNull())
        shown = shown.join(F.broadcast(chosen.select("_u").distinct()), "_u", "left_semi").mapInPandas(keys, "_u string, keys array<binary>")
        content: dict[str, set[bytes]] = {}
        for r in shown.toLocalIterator():
            content.setdefault(r["_u"], set()).update(map(bytes, r["keys"]))
        url_of = {r["id"]: r["_u"] for r in picked}
        some = with_figures(cut_lineage(records.join(F.broadcast(chosen.select("id")), "id", "left_semi")), figures).orderBy("row").toArrow()
        n, x = _features_of(some)
        y, use, at = np.ones(len(x)), np.zeros(len(x), bool), 0
        for i, digests, k in zip(some["id"].to_pylist(), some["digests"].to_pylist(), n):
            mine = content.get(url_of[i], set())
            y[at : at + k] = [d not in mine for d in digests[:k]]
            use[at : at + k] = bool(mine) and y[at : at + k].sum() <= 0.8 * k  # else another version of the page
            at += k
        if use.any():
            return grow(x[use], y[use], depth=8, least=25)
    warnings.warn("no record stands beside its own page: lines are told by their shape alone", stacklevel=2)
    numbered, ends, crumb, pointer = (LINE_FEATURES.index(f) for f in ("numbered", "ends_sentence", "crumb", "pointer_n"))
    return (numbered, 0.5, (crumb, 0.5, (pointer, 1.0, (0.0,), (ends, 0.5, (1.0,), (0.0,))), (1.0,)), (1.0,))


def _features_of(t) -> tuple[np.ndarray, np.ndarray]:
    one = lambda c: c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c
    hits = one(t["hits"])
    if isinstance(hits, pa.ChunkedArray):
        hits = pa.concat_arrays(hits.chunks)
    return feature_table(one(t["line_no"]), t["shape"].to_pylist(), hits)


def boilerplate_lines(contents: DataFrame, raw: DataFrame, sources: DataFrame) -> DataFrame:
    """(id, line_no, score) of lines of contents.body that are of the page around the article.

    Blank lines, records without body and cases of problem 1 have none.  Rows repeated under one id are judged each by
    its own body; a line found in several of them is given once, with its greatest score.
    """
    blocks = page_tree(raw)
    pages = cut_lineage(page_figures(raw, blocks))
    records = cut_lineage(record_lines(contents, sources))
    parts = records.select("segment.*").unionByName(pages.select("segment.*")).filter(F.col("record_table").isNotNull())
    spoilt = cut_lineage(residue.residue_of(parts).filter(F.col("record_table") == "contents").select(F.col("record_id").alias("id")))
    figures = cut_lineage(line_figures(records, pages))
    tree = line_tree(contents, raw, blocks, records, figures, spoilt)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            n, x = _features_of({c: batch.column(c) for c in ("line_no", "shape", "hits")})
            p = predict(tree, x)
            hit = p >= 0.5
            ids = batch.column("id").take(pa.array(np.repeat(np.arange(len(n)), n)[hit]))
            yield pa.RecordBatch.from_arrays([ids, batch.column("line_no").flatten().filter(pa.array(hit)), pa.array(p[hit])], ["id", "line_no", "score"])

    sound = records.join(spoilt, "id", "left_anti")
    hits = with_figures(sound, figures).select("id", "line_no", "shape", "hits").mapInArrow(judge, "id string, line_no int, score double")
    return hits.groupBy("id", "line_no").agg(F.max("score").alias("score"))
