"""Extraction from pages by rules: one Arrow UDF reads the markup, everything else stays in columns."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harrowmill.functions import markup as M
from harrowmill.functions.datetimes import epoch_number_ms, local_epoch_ms, notation_parts
from harrowmill.functions.urls import first_denied, has_path_prefix, url_origin

#: Fields of a page with one value, and those with several.
SINGLE, SEVERAL = ("title", "main_content", "summary", "author", "category", "published_at"), ("tags", "images")
SELECTORS = "map<string,struct<css:string,attribute:string,multi:boolean>>"
PAGE = "id string, title string, body string, summary string, author string, category string, published_at string, tags array<string>, images array<string>, article boolean, error string"


def extract_pages(pages: DataFrame) -> DataFrame:
    """pages(id, html, selectors SELECTORS, article) -> PAGE, one row per page.

    error: no_rule where selectors is null, empty_selector where title or main_content has none, parse_failure where
    either gives nothing; the fields are null then.  Fields of several values hold the non-empty ones in page order, a
    single field with multi joins them by line breaks.  published_at is given as written (see functions.datetimes).
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in PAGE.split(", ")]
        for b in batches:
            out = []
            for i, page, selectors, article in zip(b["id"], b["html"], b["selectors"], b["article"]):
                failed = lambda why: (i, *[None] * (len(names) - 3), article, why)  # noqa: B023, E731
                if selectors is None:
                    out.append(failed("no_rule"))
                    continue
                rule = {k: v for k, v in (selectors.items() if isinstance(selectors, dict) else selectors) if v is not None and (v["css"] or "").strip()}
                if not {"title", "main_content"} <= rule.keys():
                    out.append(failed("empty_selector"))
                    continue
                root = M.parse(page)
                one = {f: M.single(root, rule[f]["css"], rule[f]["attribute"], bool(rule[f]["multi"])) if f in rule else "" for f in SINGLE}
                many = {f: [v for v in (M.value(n, rule[f]["attribute"]) for n in M.select(root, rule[f]["css"])) if v] if f in rule else [] for f in SEVERAL}
                out.append((i, *one.values(), *many.values(), article, None) if one["title"] and one["main_content"] else failed("parse_failure"))
            yield pd.DataFrame(out, columns=names)

    return pages.select("id", "html", "selectors", "article").mapInPandas(run, PAGE)


def list_items(pages: DataFrame) -> DataFrame:
    """pages(id, url, html, container_css, link_css, title_css, snippet_css) -> (id, pos, url, title, snippet, error).

    Each container gives its first link, title and snippet; those without a link are passed over.  A page without rule,
    without containers or whose containers hold no link has one row with an error.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for i, base, page, container, link, title, snippet in zip(b["id"], b["url"], b["html"], b["container_css"], b["link_css"], b["title_css"], b["snippet_css"]):
                if not container or not link:
                    out.append((i, None, None, None, None, "no_rule" if container is None else "empty_selector"))
                    continue
                boxes = M.select(M.parse(page), container)
                found = [(href, M.single(x, title), M.single(x, snippet)) for x in boxes for href in [M.single(x, link, "href")] if href]
                if not found:
                    out.append((i, None, None, None, None, "no_link" if boxes else "no_container"))
                out += [(i, k, M.absolute(href, base or "") or href, t, s, None) for k, (href, t, s) in enumerate(found)]
            yield pd.DataFrame(out, columns=["id", "pos", "url", "title", "snippet", "error"])

    columns = ["id", "url", "html", "container_css", "link_css", "title_css", "snippet_css"]
    return pages.select(*columns).mapInPandas(run, "id string, pos int, url string, title string, snippet string, error string")


ANCHORS = "id string, page_url string, chars int, anchors array<struct<pos:int,href:string,url:string,text:string>>"


def page_anchors(pages: DataFrame, css: str = "a[href]") -> DataFrame:
    """pages(id, url, html) -> ANCHORS: one row per page with its links in page order and the length of its text.

    url is absolute and without fragment, null where the link leads to no page.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for i, base, page in zip(b["id"], b["url"], b["html"]):
                root = M.parse(page)
                links = [{"pos": k, "href": h.strip(), "url": M.absolute(h, base or ""), "text": M.collapse(n.text())} for k, n in enumerate(M.select(root, css)) for h in [n.attrs.get("href", "")]]
                out.append((i, base, len(M.collapse(next(iter(M.select(root, "body")), root).text())), links))
            yield pd.DataFrame(out, columns=["id", "page_url", "chars", "anchors"])

    return pages.select("id", "url", "html").mapInPandas(run, ANCHORS)


def page_links(pages: DataFrame, css: str = "a[href]") -> DataFrame:
    """pages(id, url, html) -> (id, page_url, pos, url, text): http(s) links in page order, absolute, without fragment."""
    each = page_anchors(pages, css).select("id", "page_url", F.explode("anchors").alias("a"))
    return each.select("id", "page_url", "a.pos", "a.url", "a.text").filter(F.col("url").isNotNull())


def discovered_links(
    links: DataFrame, *, pattern: str = "", same_origin: bool = True, excludes: tuple[str, ...] = (), prefixes: tuple[str, ...] = (), most: int = 0, seed: int = 0
) -> DataFrame:
    """page_links -> the links of each page that lead to articles: own origin, path pattern, no excluded part, path prefix.

    Of each url the first link counts; `most` is applied as in capped_links.
    """
    u = F.col("url")
    kept = links.filter(F.lit(not same_origin) | (url_origin(u) == url_origin(F.col("page_url"))))
    kept = kept.filter(F.lit(pattern == "") | F.rlike(u, F.lit(pattern))).filter(first_denied(u, excludes).isNull() & has_path_prefix(u, prefixes))
    return capped_links(distinct_links(kept), most, seed)


def distinct_links(links: DataFrame, most: int | None = None) -> DataFrame:
    """First occurrence of each url of a page, at most `most` of them in page order."""
    from pyspark.sql import Window as W

    first = links.groupBy("id", "page_url", "url").agg(F.min("pos").alias("pos"))
    ranked = first.withColumn("rank", F.row_number().over(W.partitionBy("id").orderBy("pos")))
    return ranked if most is None else ranked.filter(F.col("rank") <= most)


def capped_links(links: DataFrame, most: int, seed: int = 0) -> DataFrame:
    """Links of the page's own host are all kept; others fill up to `most` in a seeded random order."""
    from pyspark.sql import Window as W

    from harrowmill.functions.urls import url_hostname

    own = url_hostname(F.col("url")) == url_hostname(F.col("page_url"))
    marked = links.withColumn("same_host", own)
    order = [F.desc("same_host"), F.xxhash64(F.lit(seed), "id", "url")]
    ranked = marked.withColumn("rank", F.row_number().over(W.partitionBy("id").orderBy(*order)))
    return ranked.filter(F.col("same_host") | (F.col("rank") <= most) | F.lit(most <= 0))


def anchor_figures(pages: DataFrame) -> DataFrame:
    """pages(id, url, html) -> (id, link_ratio, article_links): share of the text that stands in links to the page's own host, and how many of these lead to a path."""
    authority = lambda u: F.lower(F.regexp_extract(u, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)", 1))
    path = lambda u: F.regexp_extract(u, r"^(?:(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//[^/?#]*)?([^?#]*)", 1)
    leads = lambda a: (a["href"] != "") & ~F.rlike(a["href"], F.lit("^(?:#|javascript:|mailto:)")) & authority(a["href"]).isin(F.lit(""), authority(F.col("page_url")))
    known = page_anchors(pages).select("id", "chars", F.filter("anchors", leads).alias("own"))
    linked = F.aggregate("own", F.lit(0), lambda n, a: n + F.length(a["text"]))
    paths = F.array_distinct(F.transform(F.filter("own", lambda a: F.trim(path(a["href"]), F.lit("/ ")) != ""), lambda a: a["href"]))
    some = F.col("chars") > 0
    return known.select("id", F.when(some, F.least(linked / F.col("chars"), F.lit(1.0))).otherwise(0.0).alias("link_ratio"), F.when(some, F.size(paths)).otherwise(0).alias("article_links"))


def index_only(records: DataFrame, figures: DataFrame, body_runes: int = 200, ratio: float = 0.8, links: int = 5) -> DataFrame:
    """records(id, body, published_s): short body, no date, and mostly links or many article links."""
    j = records.join(figures, "id")
    short = F.length(F.coalesce("body", F.lit(""))) < body_runes
    verdict = short & F.col("published_s").isNull() & ((F.col("link_ratio") >= ratio) | (F.col("article_links") >= links))
    return j.select("id", "link_ratio", "article_links", verdict.alias("index_only"))


def selector_hits(pages: DataFrame, selectors: dict[str, tuple[str, str | None]]) -> DataFrame:
    """(id, hits): per selector 1.0 if its first match gives a value, else 0.0; the value of published_at must also be a date."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for i, page in zip(b["id"], b["html"]):
                root = M.parse(page)
                out.append((i, {name: M.single(root, css, attr) for name, (css, attr) in selectors.items()}))
            yield pd.DataFrame(out, columns=["id", "found"])

    def hit(name, value):
        p = notation_parts(value)
        dated = F.coalesce(local_epoch_ms(p, F.lit(False)), epoch_number_ms(p)).isNotNull()
        return ((value != "") & ((name != "published_at") | dated)).cast("double")

    found = pages.select("id", "html").mapInPandas(run, "id string, found map<string,string>")
    return found.select("id", F.transform_values("found", hit).alias("hits"))


def confident(selectors: DataFrame, least: float = 0.5) -> DataFrame:
    """selectors(name, css, hit_rate): those below the rate are dropped, unmeasured ones stay."""
    return selectors.filter(F.col("hit_rate").isNull() | (F.col("hit_rate") >= least))


def cut_text(text: Column, most: int) -> Column:
    return F.when(F.length(text) > most, F.concat(F.substring(text, 1, most), F.lit("…"))).otherwise(text)


def previews(pages: DataFrame) -> DataFrame:
    """PAGE with links(array of urls) -> what a reviewer sees: title, 500 characters of body, first three links."""
    return pages.select("id", "title", cut_text(F.col("body"), 500).alias("preview"), F.slice("links", 1, 3).alias("links"), "error")
