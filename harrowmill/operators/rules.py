"""Rule resolution: host equality plus a regular expression on the path, best match first."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Constructs that a linear-time regular expression engine refuses.
_REFUSED = re.compile(r"\(\?(?:=|!|<=|<!|>)|\\[1-9]|[*+?}]\+")


def usable_patterns(rules: DataFrame, pattern: str = "path_pattern") -> DataFrame:
    """Rules whose pattern compiles in a linear-time dialect; '' is a catch-all, others are skipped, not errors.

    A trailing $ is tied to the end of the text, as it would otherwise match before a final newline.
    """

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def fixed(p: str | None) -> str | None:
            if p is None or _REFUSED.search(p):
                return None
            try:
                re.compile(p)
            except re.error:
                return None
            p = p.replace("(?P<", "(?<")
            return p[:-1] + r"\z" if p.endswith("$") and not p.endswith(r"\$") else p

        for b in batches:
            b = b.assign(_re=[fixed(p) for p in b[pattern]])
            yield b[b["_re"].notna()]

    schema = ", ".join(f"`{n}` {t}" for n, t in rules.dtypes) + ", _re string"
    return rules.mapInPandas(check, schema)


def path_matches(path: Column, pattern: Column) -> Column:
    return (pattern == "") | F.rlike(path, pattern)


def best_rule(pages: DataFrame, rules: DataFrame, *order: Column, keep: list[str]) -> DataFrame:
    """pages(key, host, path, ...) with the columns `keep` of the first rule in `order` whose host and path match.

    The join key is the host, the pattern a residual condition on its few rules.  The rule table holds a handful of
    rules a host and is joined by its size: Spark broadcasts it below the configured threshold.  Pages without a match
    keep nulls.
    """
    usable = usable_patterns(rules)
    r = usable.select(F.col("host_pattern").alias("_host"), "_re", F.length("path_pattern").alias("_len"), *[c for c in usable.columns if c not in ("host_pattern", "_re")])
    hit = pages.join(r, (pages.host == r._host) & path_matches(pages.path, r._re), "left")
    ranked = hit.withColumn("_rank", F.row_number().over(W.partitionBy("key").orderBy(*order)))
    return ranked.filter("_rank = 1").select(*pages.columns, *keep)


def classify(verdicts: DataFrame, mode: str = "mode") -> DataFrame:
    """mode -> verdict: drop, extract_links_only or allow; a failed or missing lookup allows."""
    return verdicts.withColumn("verdict", F.when(F.col(mode).isin("drop", "extract_links_only"), F.col(mode)).otherwise(F.lit("allow")))


def unmatched(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """Pages that no enabled rule matches (anti-join with the pattern as residual condition)."""
    r = usable_patterns(rules.filter("enabled")).select(F.col("host_pattern").alias("_host"), "_re")
    return pages.join(r, (pages.host == r._host) & path_matches(pages.path, r._re), "left_anti")


def next_versions(rules: DataFrame) -> DataFrame:
    return rules.groupBy("host_pattern", "path_pattern", "target_type").agg((F.coalesce(F.max("version"), F.lit(0)) + 1).alias("next_version"))


def has_any_rule(rules: DataFrame) -> DataFrame:
    return rules.groupBy("host_pattern").agg((F.count("*") > 0).alias("any_rule"), F.coalesce(F.bool_or("enabled"), F.lit(False)).alias("any_enabled"))
