"""Views over the project's tables and the rule tables the queries use, for Spark and as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harrowmill.sources.tables import table

CANONICAL_DATE = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}Z$"


def contents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """contents with published_s: epoch seconds of a canonical published_at, null for the zero time and other notations."""
    readable = F.col("published_at").rlike(CANONICAL_DATE) & ~F.col("published_at").startswith("0001")
    return table(spark, sf_dir, "contents").withColumn("published_s", F.when(readable, F.unix_timestamp(F.to_timestamp("published_at"))))


CONTENTS = r"""content_rows as (select *, case when regexp_matches(published_at, '^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}Z$') and published_at not like '0001%'
  then epoch(strptime(published_at, '%Y-%m-%dT%H:%M:%SZ'))::bigint end as published_s from contents)"""

#: host_pattern, path_pattern, target_type, version, enabled, source_name, article
PARSER_RULES = [
    ("www.velmoracourier.example", "", "page", 1, True, "Velmora Courier", True),
    ("www.velmoracourier.example", "^/politics/.+$", "page", 2, True, "Velmora Courier", True),
    ("www.velmoracourier.example", "^/politics/.+$", "page", 1, True, "Velmora Courier", True),
    ("www.velmoracourier.example", "^/(sports|travel)/", "page", 1, False, "Velmora Courier", True),
    ("www.tarnwickdispatch.example", "^/economy/[a-z0-9-]+$", "page", 1, True, "Tarnwick Dispatch", True),
    ("www.onbyeoldaily.example", "^/[a-z]+/story-[0-9a-z]+$", "page", 3, True, "Onbyeol Daily", True),
    ("www.quillhavenpost.example", "^/local/(?=x)", "page", 1, True, "Quillhaven Post", False),
    ("www.quillhavenpost.example", "", "list", 1, True, "Quillhaven Post", False),
    ("www.dorrimoortimes.example", "", "page", 1, False, "Dorrimoor Times", True),
    ("www.porchsideboard.example", "([unclosed", "page", 1, True, "Porchside Board", False),
]
#: id, host_pattern, path_pattern, mode, enabled
BLACKLIST = [
    (1, "www.velmoracourier.example", "^/sports/", "drop", True),
    (2, "www.velmoracourier.example", "", "extract_links_only", True),
    (3, "www.tarnwickdispatch.example", "^/opinion/", "drop", True),
    (4, "www.tarnwickdispatch.example", "^/opinion/.*council", "extract_links_only", True),
    (5, "www.kelpgateherald.example", "", "drop", False),
    (6, "www.junior-lantern.example", "", "drop", True),
    (7, "www.trellistalk.example", "[broken", "drop", True),
]
#: host_pattern, path_pattern, priority (in input order)
PRIORITY_RULES = [
    ("www.velmoracourier.example", "", 2), ("www.velmoracourier.example", "^/politics/", 1), ("www.velmoracourier.example", "^/politic", 3),
    ("www.tarnwickdispatch.example", "", 3), ("www.brennmarkbote.example", "^/science/", 1),
]
#: source -> priority of the composite lookup
SOURCE_PRIORITY = [("src-junior-lantern", 3), ("src-bexholm-policy", 1)]


def _literal(v: object) -> str:
    if isinstance(v, bool):
        return "true" if v else "false"
    return str(v) if isinstance(v, int) else "'" + str(v).replace("'", "''") + "'"


def values(name: str, columns: list[str], rows: list[tuple]) -> str:
    return f"{name}({', '.join(columns)}) as (values " + ", ".join("(" + ", ".join(map(_literal, r)) + ")" for r in rows) + ")"


RULE_COLUMNS = ["host_pattern", "path_pattern", "target_type", "version", "enabled", "source_name", "article"]
BLACKLIST_COLUMNS = ["id", "host_pattern", "path_pattern", "mode", "enabled"]
#: Rules whose pattern the reference dialect cannot compile (look-ahead, unclosed groups) are skipped by either side.
VALID_RULES = [r for r in PARSER_RULES if "(?=" not in r[1] and r[1] != "([unclosed"]
VALID_BLACKLIST = [r for r in BLACKLIST if r[2] != "[broken"]


def parser_rules(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(PARSER_RULES, "host_pattern string, path_pattern string, target_type string, version int, enabled boolean, source_name string, article boolean")


def blacklist(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(BLACKLIST, "id int, host_pattern string, path_pattern string, mode string, enabled boolean")
