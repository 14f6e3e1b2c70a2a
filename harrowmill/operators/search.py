"""Content search: composable filters, list and full projections, ordered pages, counts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_LIMIT = 50


def all_of(*conditions: Column | None) -> Column:
    """Conjunction of the given predicates; None stands for no predicate."""
    return reduce(lambda a, b: a & b, [c for c in conditions if c is not None], F.lit(True))


def equals(column: str, value: str | None) -> Column | None:
    return F.col(column) == value if value else None


def has_all_tags(column: str, tags: Sequence[str] | None) -> Column | None:
    """Every given tag is among the row's tags; null tags hold none."""
    if not tags:
        return None
    return F.coalesce(F.size(F.array_except(F.array(*[F.lit(t) for t in tags]), F.col(column))) == 0, F.lit(False))


def content_filter(
    *, country: str | None = None, language: str | None = None, category: str | None = None, source_id: str | None = None, source_type: str | None = None,
    published_from: int | None = None, published_to: int | None = None, tags: Sequence[str] | None = None, min_reliability: float | None = None,
) -> Column:
    """Optional predicates over contents; empty strings and None put none.  Bounds are epoch seconds, inclusive."""
    return all_of(
        equals("country", country), equals("language", language), equals("category", category), equals("source_id", source_id), equals("source_type", source_type),
        F.col("published_s") >= published_from if published_from is not None else None,
        F.col("published_s") <= published_to if published_to is not None else None,
        has_all_tags("tags", tags),
        F.col("reliability").cast("double") >= min_reliability if min_reliability else None,
    )


def raw_filter(*, country: str | None = None, source_name: str | None = None, created_from: int | None = None, created_to: int | None = None, status_code: int = 0) -> Column:
    return all_of(
        F.col("source.country") == country if country else None,
        F.col("source.name") == source_name if source_name else None,
        F.unix_timestamp("created_at") >= created_from if created_from is not None else None,
        F.unix_timestamp("created_at") <= created_to if created_to is not None else None,
        F.col("status_code") == status_code if status_code else None,
    )


def rule_filter(*, source_name: str = "", host: str = "", target_type: str = "", only_enabled: bool = False, article: bool | None = None) -> Column:
    return all_of(
        equals("source_name", source_name), equals("host_pattern", host), equals("target_type", target_type),
        F.col("enabled") if only_enabled else None, F.col("article") == article if article is not None else None,
    )


def page(df: DataFrame, *order: Column, limit: int = DEFAULT_LIMIT, offset: int = 0) -> DataFrame:
    """One ordered page; non-positive limits mean the default, negative offsets the start."""
    return df.orderBy(*order).offset(max(0, offset)).limit(limit if limit > 0 else DEFAULT_LIMIT)


def full_view(contents: DataFrame, bodies: DataFrame, meta: DataFrame) -> DataFrame:
    """Vertically split record put together: missing body parts are '' and 0, missing images an empty array."""
    joined = contents.join(bodies, contents.id == bodies.content_id, "left").drop("content_id").join(meta, contents.id == meta.content_id, "left").drop("content_id")
    return joined.withColumns({"body": F.coalesce("body", F.lit("")), "summary": F.coalesce("summary", F.lit("")), "word_count": F.coalesce("word_count", F.lit(0)), "image_urls": F.coalesce("image_urls", F.array().cast("array<string>"))})


def list_view(contents: DataFrame) -> DataFrame:
    """Listing without body and meta; neither table is read."""
    return contents.drop("body", "image_urls", "extra", "summary", "word_count")
