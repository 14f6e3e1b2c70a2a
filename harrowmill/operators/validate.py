"""Validation and quality scores of news and community records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NEWS_TITLE, NEWS_BODY, COMMUNITY_BODY_MIN = (10, 500), (100, 50_000), 50
NEWS_WORDS_MIN, NEWS_QUALITY, COMMUNITY_QUALITY = 50, 0.5, 0.4
CAPS_RATIO, PUNCT_RATIO, REPEAT_RATIO = 0.20, 0.10, 0.30
#: Error code of the first broken rule.
CODES = {"min_length": "VAL_003", "max_length": "VAL_004", "required": "VAL_001", "spam_caps": "VAL_006", "spam_punct": "VAL_006", "spam_flood": "VAL_006", "quality_low": "VAL_005"}


def text(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def error(field: str, rule: str) -> Column:
    return F.struct(F.lit(field).alias("field"), F.lit(rule).alias("rule"))


def kept(*errors: Column) -> Column:
    return F.filter(F.array(*errors), lambda e: e.isNotNull())


def length_error(name: str, field: str, low: int, high: int | None) -> Column:
    n = F.length(text(name))
    out = F.when(n < low, error(field, "min_length"))
    return out if high is None else out.when(n > high, error(field, "max_length"))


def repeat_share(body: Column) -> Column:
    """Share of characters in runs of four or more equal ones."""
    total = F.length(body)
    rest = F.length(F.regexp_replace(body, r"(?s)(.)\1{3,}", ""))
    return F.when(total > 0, (total - rest) / total).otherwise(F.lit(0.0))


def word_score(count: Column, least: int = NEWS_WORDS_MIN) -> Column:
    c = F.coalesce(count, F.lit(0)).cast("double")
    m = float(least)
    return F.when(c <= 0, 0.5).when(c >= 4 * m, 1.0).when(c < m, c / m * 0.5).otherwise(0.5 + (c - m) / (3 * m) * 0.5)


def part(condition: Column, weight: float) -> Column:
    return F.when(F.coalesce(condition, F.lit(False)), weight).otherwise(0.0)


def news_quality() -> Column:
    meta = part(text("author") != "", 0.4) + part(text("category") != "", 0.3) + part(F.size(F.coalesce("tags", F.array().cast("array<string>"))) > 0, 0.3)
    structure = part(text("url") != "", 0.3) + part(text("summary") != "", 0.3) + part(text("body").contains("\n"), 0.4)
    return (word_score(F.col("word_count")) * 0.4 + meta * 0.3 + structure * 0.3).cast("float")


def community_quality() -> Column:
    n = F.length(text("body"))
    body = F.when(n < COMMUNITY_BODY_MIN, 0.0).when(n >= 200, 1.0).otherwise(n / 200.0)
    meta = part(text("title") != "", 0.4) + part(F.col("published_s").isNotNull(), 0.3) + part(F.trim(text("url")) != "", 0.3)
    return (body * 0.6 + meta * 0.4).cast("float")


def validated(contents: DataFrame, article: Column | None = None) -> DataFrame:
    """Adds quality (float), errors (array of field, rule), valid and code; null texts count as empty.

    Community records have rules of their own, every other type those for news.  `article` says whether a record must
    have a date; by default its column of that name does, and tables without one require none.  quality_low is reported only when
    nothing else is wrong.
    """
    if article is None:
        article = F.coalesce(F.col("article"), F.lit(False)) if "article" in contents.columns else F.lit(False)
    whole = F.concat(text("title"), F.lit(" "), text("body"))
    total = F.length(whole).cast("double")
    caps, punct = F.regexp_count(whole, F.lit(r"\p{Lu}")) / total, F.regexp_count(whole, F.lit(r"[\p{P}\p{S}]")) / total
    dated = F.when(article & F.col("published_s").isNull(), error("PublishedAt", "required"))
    news = kept(
        length_error("title", "Title", *NEWS_TITLE), length_error("body", "Body", *NEWS_BODY), dated,
        F.when(caps > CAPS_RATIO, error("Body", "spam_caps")), F.when(punct > PUNCT_RATIO, error("Body", "spam_punct")),
    )
    community = kept(length_error("body", "Body", COMMUNITY_BODY_MIN, None), F.when(repeat_share(text("body")) > REPEAT_RATIO, error("Body", "spam_flood")))
    forum = F.coalesce(F.col("source_type") == "community", F.lit(False))
    quality = F.when(forum, community_quality()).otherwise(news_quality())
    least = F.when(forum, F.lit(COMMUNITY_QUALITY).cast("float")).otherwise(F.lit(NEWS_QUALITY).cast("float"))
    found = F.when(forum, community).otherwise(news)
    low = F.when((F.size("_found") == 0) & (F.col("quality") < F.col("_least")), F.array(error("Quality", "quality_low"))).otherwise(F.col("_found"))
    out = contents.withColumns({"quality": quality, "_least": least, "_found": found})
    out = out.withColumn("errors", low).drop("_found", "_least")
    codes = F.create_map(*[F.lit(x) for kv in CODES.items() for x in kv])
    return out.withColumn("valid", F.size("errors") == 0).withColumn("code", F.when(~F.col("valid"), F.coalesce(codes[F.col("errors")[0]["rule"]], F.lit("VAL_002"))))


#: Codes that a better extraction rule can mend; how often a record goes back to extraction, and to the queue.
REPARSE_CODES, MOST_REPARSES, MOST_RETRIES = ("VAL_001", "VAL_003"), 2, 3


def header_count(headers: Column, name: str) -> Column:
    """A counter kept in a header; absent, unreadable and negative ones are 0."""
    n = headers[name].try_cast("int")
    return F.when(n > 0, n).otherwise(F.lit(0))


def may_reparse(code: Column, reparses: Column) -> Column:
    return F.coalesce(code.isin(*REPARSE_CODES) & (reparses < MOST_REPARSES), F.lit(False))


def validation_route(valid: Column, code: Column, reparses: Column, retries: Column, reparse_enabled: bool = True) -> Column:
    """validated, reparse (back to extraction), requeue or dead (dead letters, record deleted)."""
    again = may_reparse(code, reparses) & F.lit(reparse_enabled)
    return F.when(valid, "validated").when(again, "reparse").when(retries < MOST_RETRIES, "requeue").otherwise("dead")


def with_status(validated: DataFrame) -> DataFrame:
    """Adds validation_status, reject_code and reject_detail; a record that passed loses what an earlier round stored."""
    first = F.col("errors")[0]
    detail = F.concat(first["field"], F.lit(": "), first["rule"])
    return validated.withColumns({
        "validation_status": F.when(F.col("valid"), "passed").otherwise("rejected"),
        "reject_code": F.when(~F.col("valid"), F.col("code")), "reject_detail": F.when(~F.col("valid"), detail),
    })
