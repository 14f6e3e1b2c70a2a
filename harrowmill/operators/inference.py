"""URL path patterns inferred from samples, segment by segment, with grouped aggregates."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harrowmill.functions.urls import quote_regex

UUID = r"[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}"
#: Segment kinds from the narrowest to the widest, as (test, pattern).
KINDS = [(rf"^{UUID}$", rf"({UUID})"), (r"^(19|20)[0-9]{2}$", r"((19|20)\d{2})"), (r"^(0[1-9]|1[0-2])$", r"(0[1-9]|1[0-2])"), (r"^[0-9]+$", r"(\d+)")]
SLUG = r"([a-z0-9-]+)"
#: Patterns that match any path.
TOO_BROAD = ["", ".*", ".+", "/.*", "/.+", "^.*$", "^.+$", "^/$", "^/.*$", "^/.+$", "^/(.*)$", "^/(.+)$"]


def segments(path: Column) -> Column:
    trimmed = F.regexp_replace(path, r"^/+|/+$", "")
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, "/"))


def infer_patterns(samples: DataFrame, least: int = 3) -> DataFrame:
    """samples(rule_id, path) -> (rule_id, pattern) of rules with enough samples of one length and a kind for every part.

    Constant segments are quoted; others must all be of one kind: UUID, year, month, number, or slug with a hyphen.
    """
    s = samples.filter("path is not null").select("rule_id", segments(F.col("path")).alias("seg"))
    sizes = s.groupBy("rule_id").agg(F.count("*").alias("n"), F.min(F.size("seg")).alias("a"), F.max(F.size("seg")).alias("b")).filter((F.col("n") >= least) & (F.col("a") == F.col("b")))
    each = s.join(sizes.select("rule_id"), "rule_id", "left_semi").select("rule_id", F.posexplode("seg").alias("pos", "v"))
    v = F.col("v")
    slug = v.rlike("^[a-z0-9-]+$") & (F.length(v) >= 4) & v.contains("-")
    found = each.groupBy("rule_id", "pos").agg(F.min(v).alias("low"), F.max(v).alias("high"), *[F.bool_and(v.rlike(t)).alias(f"k{i}") for i, (t, _) in enumerate(KINDS)], F.bool_and(slug).alias("slug"))
    part = F.when(F.col("low") == F.col("high"), quote_regex(F.col("low")))
    for i, (_, p) in enumerate(KINDS):
        part = part.when(F.col(f"k{i}"), F.lit(p))
    part = part.when(F.col("slug"), F.lit(SLUG))
    parts = found.select("rule_id", "pos", part.alias("part"))
    whole = parts.groupBy("rule_id").agg(F.bool_and(F.col("part").isNotNull()).alias("ok"), F.array_sort(F.collect_list(F.struct("pos", "part"))).alias("p"))
    text = F.concat(F.lit("^/"), F.array_join(F.transform("p", lambda x: x["part"]), "/"), F.lit("$"))
    return whole.filter("ok").select("rule_id", text.alias("pattern"))


def is_too_broad(pattern: Column) -> Column:
    return F.trim(pattern).isin(TOO_BROAD)


#: Words put in the place of a constant segment: lower case, capitals, hyphenated.
FOREIGN = ("zzprobe", "QQQQQQ", "some-other-place")


def broad_patterns(patterns: DataFrame, samples: DataFrame) -> DataFrame:
    """(rule_id, broad): patterns that match paths their samples(rule_id, path) do not speak for.

    Where all samples of a rule have as many segments, the first of them is tried with a segment more at either end and
    with one less; where there are two samples or more, also with a foreign word in place of each segment that all of
    them share.  A pattern that does not compile is broad.
    """
    s = samples.filter("path is not null").select("rule_id", "path", segments(F.col("path")).alias("seg"))
    sizes = s.groupBy("rule_id").agg(F.count("*").alias("n"), F.min("path").alias("path"), F.min(F.size("seg")).alias("a"), F.max(F.size("seg")).alias("b"))
    each = s.select("rule_id", F.posexplode("seg").alias("pos", "v")).groupBy("rule_id", "pos").agg(F.min("v").alias("low"), F.max("v").alias("high"), F.count("*").alias("m"))
    shared = each.groupBy("rule_id").agg(F.collect_list(F.when(F.col("low") == F.col("high"), F.struct("pos", "m"))).alias("shared"))
    told = sizes.join(shared, "rule_id", "left")
    seg, even = segments(F.col("path")), (F.col("a") == F.col("b")) & (F.col("b") > 0)
    path_of = lambda parts: F.concat(F.lit("/"), F.array_join(parts, "/"))
    k = F.size(seg)
    longer = [path_of(F.concat(F.array(F.lit(FOREIGN[0])), seg)), path_of(F.concat(seg, F.array(F.lit(FOREIGN[0]))))]
    shorter = F.when(k > 1, F.array(path_of(F.slice(seg, F.lit(2), k - 1)), path_of(F.slice(seg, F.lit(1), k - 1)))).otherwise(F.array().cast("array<string>"))
    # Segments that every sample has, with one value.
    fixed = F.when(F.col("n") > 1, F.filter("shared", lambda x: x["m"] == F.col("n")))

    def with_word(at: Column, word: str) -> Column:
        return F.transform(seg, lambda v, i: F.when(i == at, F.lit(word)).otherwise(v))

    swapped = F.flatten(F.transform(F.coalesce(fixed, F.array().cast("array<struct<pos:int,m:bigint>>")), lambda x: F.array(*[
        path_of(with_word(x["pos"], w)) for w in FOREIGN])))
    probes = F.when(even, F.array_except(F.concat(F.array(*longer), shorter, swapped), F.array("path"))).otherwise(F.array().cast("array<string>"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for t in batches:
            out = []
            for rule, pattern, tried in zip(t["rule_id"], t["pattern"], t["probes"]):
                try:
                    rx = re.compile(pattern)
                    out.append((rule, any(rx.search(x) for x in tried)))
                except (re.error, TypeError):
                    out.append((rule, True))
            yield pd.DataFrame(out, columns=["rule_id", "broad"])

    asked = patterns.select("rule_id", "pattern").join(told.select("rule_id", probes.alias("probes")), "rule_id")
    return asked.mapInPandas(run, f"rule_id {dict(patterns.dtypes)['rule_id']}, broad boolean")


def refine_rules(rules: DataFrame, samples: DataFrame, least: int = 5) -> tuple[DataFrame, DataFrame]:
    """One cycle of the refiner: (rules to insert, rule_id whose samples are purged).

    rules(rule_id, host_pattern, path_pattern, target_type, version, enabled, origin): enabled catch-alls of origin
    'auto' with `least` or more samples(rule_id, path) take the path pattern of their samples, as the next version of
    host, pattern and type; the old rule stays.  Patterns that are too broad, or that miss one of their samples, are left out.
    """
    catch_all = rules.filter(F.col("enabled") & (F.col("origin") == "auto") & (F.col("path_pattern") == ""))
    own = samples.join(catch_all.select("rule_id"), "rule_id", "left_semi").filter("path is not null")
    found = infer_patterns(own, least).filter(~is_too_broad(F.col("pattern")))
    sound = found.join(broad_patterns(found, own).filter(~F.col("broad")).select("rule_id"), "rule_id", "left_semi")
    missed = own.join(sound, "rule_id").filter(~F.rlike(F.col("path"), F.col("pattern"))).select("rule_id").distinct()
    sound = sound.join(missed, "rule_id", "left_anti")
    new = catch_all.join(sound, "rule_id").select("rule_id", "host_pattern", F.col("pattern").alias("path_pattern"), "target_type")
    last = rules.groupBy("host_pattern", "path_pattern", "target_type").agg(F.max("version").alias("last"))
    new = new.join(last, ["host_pattern", "path_pattern", "target_type"], "left")
    insert = new.select("rule_id", "host_pattern", "path_pattern", "target_type", (F.coalesce("last", F.lit(0)) + 1).alias("version"), F.lit(True).alias("enabled"))
    return insert, insert.select("rule_id")
