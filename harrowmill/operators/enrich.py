"""Post-processing of model output: fences, JSON defaults, range checks, verdicts."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VERDICTS = ["supported", "contradicted", "unverified"]
SCORE = "trust_score double, rationale string"
VERIFY = "verifications array<struct<claim_idx:int,verdict:string,note:string>>"
EXTRACT = "entities array<struct<type:string,name:string>>, claims array<struct<text:string>>, topics array<string>, sentiment string"
_SIGNS = re.compile(r'\\.|["{}]', re.S)
_BLANK = r"(?U)^\s+|\s+$"


def trimmed(text: Column) -> Column:
    return F.regexp_replace(text, _BLANK, "")


def strip_fences(text: Column) -> Column:
    """Text between the first and the last code fence, the language tag dropped; unfenced text is trimmed only."""
    t = trimmed(text)
    after = F.regexp_replace(t, r"(?s)^.*?```", "")
    line = F.instr(after, "\n")
    start = F.when(line > 0, F.substr(after, line + 1)).otherwise(F.regexp_replace(after, r"(?s)^[^{\[]*(?=[{\[])", ""))
    body = F.regexp_replace(start, r"(?s)```(?!.*```).*$", "")
    return F.when(F.instr(t, "```") == 0, t).otherwise(trimmed(body))


def is_empty_json(text: Column) -> Column:
    return F.coalesce(trimmed(text).isin("", "{}", "[]", "null"), F.lit(True))


def parse_score(text: Column) -> Column:
    """struct(trust_score, rationale, error): a score must be present and in [0, 1], the rationale not blank."""
    body = strip_fences(text)
    j = F.from_json(body, SCORE)
    s, r = j["trust_score"], j["rationale"]
    error = (
        F.when(body.isNull() | (body == ""), "empty output").when(s.isNull(), "missing trust_score").when(F.coalesce(trimmed(r), F.lit("")) == "", "missing rationale").when((s < 0) | (s > 1), "out of range")
    )
    return F.struct(F.when(error.isNull(), s).alias("trust_score"), F.when(error.isNull(), r).alias("rationale"), error.alias("error"))


def parse_verdicts(text: Column) -> Column:
    """Verifications with unknown verdicts read as unverified; a missing list is empty."""
    v = F.coalesce(F.from_json(strip_fences(text), VERIFY)["verifications"], F.array().cast("array<struct<claim_idx:int,verdict:string,note:string>>"))
    fixed = lambda x: F.when(x["verdict"].isin(VERDICTS), x["verdict"]).otherwise(F.lit("unverified"))
    return F.transform(v, lambda x: F.struct(x["claim_idx"].alias("claim_idx"), F.coalesce(fixed(x), F.lit("unverified")).alias("verdict"), x["note"].alias("note")))


def parse_facts(text: Column) -> Column:
    """Extraction result with missing lists empty and the sentiment neutral."""
    j = F.from_json(strip_fences(text), EXTRACT)
    return F.struct(
        F.coalesce(F.size(j["entities"]), F.lit(0)).alias("entities"), F.coalesce(F.size(j["claims"]), F.lit(0)).alias("claims"),
        F.coalesce(j["topics"], F.array().cast("array<string>")).alias("topics"), F.coalesce(F.when(j["sentiment"] != "", j["sentiment"]), F.lit("neutral")).alias("sentiment"),
    )


def trust_factors(claims: DataFrame) -> DataFrame:
    """claims(content_id, verdict, domain) -> supported share and different domains (an addition of this library)."""
    return claims.groupBy("content_id").agg(F.round(F.avg((F.col("verdict") == "supported").cast("double")), 6).alias("supported"), F.count_distinct("domain").alias("domains"))


def propagate_headers(inbox: Column, outgoing: Column, names: list[str]) -> Column:
    """Outgoing headers plus the named inbox headers that are not empty; those already set win."""
    passed = F.map_filter(inbox, lambda k, v: k.isin(names) & (v != "") & ~F.map_contains_key(outgoing, k))
    return F.map_concat(passed, outgoing)


def render(template: str, values: dict[str, Column]) -> Column:
    """Placeholders {name} replaced in one pass: the template is cut once, values are never scanned again."""
    import re

    parts = re.split(r"(\{[a-z_]+\})", template)
    return F.concat(*[F.coalesce(values[p[1:-1]].cast("string"), F.lit("")) if p[1:-1] in values and p.startswith("{") else F.lit(p) for p in parts if p])


def cascade(base: DataFrame, stages: list[tuple[str, DataFrame]], key: str = "content_id") -> DataFrame:
    """Left joins of stage outputs(key, value); a stage without output leaves null and later stages still run."""
    out = base
    for name, stage in stages:
        out = out.join(stage.select(F.col(key), F.col("value").alias(name)), key, "left")
    return out


def _first_object(t: str | None) -> str | None:
    at = t.find("{") if t else -1
    if at < 0:
        return None
    depth, quoted = 0, False
    for m in _SIGNS.finditer(t, at):
        sign = m.group()
        if sign == '"':
            quoted = not quoted
        elif sign[0] != "\\" and not quoted:
            depth += 1 if sign == "{" else -1
            if not depth:
                return t[at : m.end()]
    return None


def first_object(text: Column) -> Column:
    """The first balanced JSON object of a text; braces inside quoted strings do not count.  null where there is none."""
    return F.pandas_udf(lambda t: t.map(_first_object), "string")(text)


ENRICHED = "validity string, blacklist_reason string, blacklist_mode string, page_type string, article boolean, selectors map<string,struct<css:string,attribute:string,multi:boolean>>"
PAGE_TYPES = ("article", "list", "category", "index", "other")


def parse_enriched(text: Column) -> Column:
    """struct(kind, page_type, article, selectors, reason, mode, error) of a page-analysis answer.

    kind: blacklist, ok or legacy (selectors without a verdict).  Unknown page types are other, unknown modes drop.
    """
    body = first_object(text)
    j, bare = F.from_json(body, ENRICHED), F.from_json(body, "map<string,struct<css:string,attribute:string,multi:boolean>>")
    v = F.coalesce(j["validity"], F.lit(""))
    kind = F.when(body.isNull(), F.lit(None).cast("string")).when(v.isin("blacklist", "ok"), v).when(v == "", "legacy")
    error = F.when(body.isNull(), "no JSON object").when(kind.isNull(), "unknown validity")
    page = F.lower(F.trim(j["page_type"]))
    mode = F.lower(F.trim(F.coalesce(j["blacklist_mode"], F.lit(""))))
    black = kind == "blacklist"
    return F.struct(
        kind.alias("kind"), F.when(kind == "ok", F.when(page.isin(*PAGE_TYPES), page).otherwise("other")).alias("page_type"), F.when(kind == "ok", j["article"]).alias("article"),
        F.when(kind == "ok", j["selectors"]).when(kind == "legacy", bare).alias("selectors"),
        F.when(black, F.coalesce(F.when(F.trim(j["blacklist_reason"]) != "", F.trim(j["blacklist_reason"])), F.lit("(no reason provided)"))).alias("reason"),
        F.when(black, F.when(mode.isin("drop", "extract_links_only"), mode).otherwise("drop")).alias("mode"), error.alias("error"),
    )


#: Signs of a too long input, in lower case.
TOO_LONG = ("context length", "maximum context", "too many tokens", "context window")


def error_class(status: Column, message: Column) -> Column:
    """auth, rate_limit, server, context_limit, bad_request or unknown, by HTTP status and, for 400, the message."""
    low = F.lower(F.coalesce(message, F.lit("")))
    long = F.lit(False)
    for sign in TOO_LONG:
        long = long | low.contains(sign)
    return (
        F.when(status.isin(401, 403), "auth").when(status == 429, "rate_limit").when(status.between(500, 599), "server")
        .when((status == 400) & long, "context_limit").when(status.between(400, 499), "bad_request").otherwise("unknown")
    )


def may_delegate(kind: Column) -> Column:
    """Another provider may succeed wherever the request itself is not at fault."""
    return kind != "bad_request"


def to_persist(cascaded: DataFrame, score: str = "trust_score") -> DataFrame:
    """Records whose cascade reached a score; the others are forwarded without being stored."""
    return cascaded.filter(F.col(score).isNotNull())
