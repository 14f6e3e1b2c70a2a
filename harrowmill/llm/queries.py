"""Queries of the corpus problems over the project's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harrowmill.llm import boilerplate, encoding, leakage, mixing, names, reading, residue, sitelines
from harrowmill.session import cut_lineage
from harrowmill.sources.tables import table

#: Vocabulary file of the public tokenizer that p9 counts tokens with.
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = residue.residue(table(spark, sf_dir, "contents"), table(spark, sf_dir, "raw_contents"))
    return hits.select("record_table", "record_id")


def p1_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = residue.residue(table(spark, sf_dir, "contents"), table(spark, sf_dir, "raw_contents"))
    return hits.groupBy("record_table", "reason").agg(F.count("*").alias("n"))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return names.variant_pairs(table(spark, sf_dir, "entities"), table(spark, sf_dir, "claims"))


def p2_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every spelling with the key of the person or organisation it means."""
    return names.entity_names(table(spark, sf_dir, "entities"), table(spark, sf_dir, "claims"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = encoding.fields_of(table(spark, sf_dir, "contents"), table(spark, sf_dir, "raw_contents"))
    return encoding.damaged_fields(fields).select("record_table", "record_id", "field").distinct()


def p4_restored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damaged fields with their text put right, as its hash, and how many damaged words were filled in or left open."""
    fields = encoding.fields_of(table(spark, sf_dir, "contents"), table(spark, sf_dir, "raw_contents"))
    damaged = cut_lineage(encoding.damaged_fields(fields))
    filled = encoding.restore_lost(damaged, fields)
    readable = damaged.filter(~F.col("lost")).withColumn("restored", F.lit(0)).withColumn("open", F.lit(0))
    columns = ["record_table", "record_id", "field", "text", "restored", "open"]
    out = readable.select(*columns).unionByName(filled.select(*columns))
    return out.select("record_table", "record_id", "field", F.md5("text").alias("text_md5"), "restored", "open")


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = sitelines.repeated_occurrences(table(spark, sf_dir, "contents"))
    return hits.select(F.col("doc_id").alias("content_id"), "line_no")


def p5_excess(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of the repeated lines those significantly more frequent in their source than outside it."""
    hits = sitelines.repeated_occurrences(table(spark, sf_dir, "contents"), excess=True)
    return hits.select(F.col("doc_id").alias("content_id"), "line_no")


def p5_cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each body without the repeated lines, as a hash and its length in characters."""
    out = sitelines.without_repeated_lines(table(spark, sf_dir, "contents"))
    return out.select(F.col("doc_id").alias("content_id"), F.length("body").alias("n_chars"), F.md5("body").alias("body_md5"))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = boilerplate.boilerplate_lines(*(table(spark, sf_dir, name) for name in ("contents", "raw_contents", "sources")))
    return hits.select(F.col("id").alias("content_id"), "line_no")


def p6_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main content of every raw page, as its length and hash."""
    out = boilerplate.main_text(table(spark, sf_dir, "raw_contents"))
    return out.select("raw_id", F.length("body").alias("n_chars"), F.md5("body").alias("body_md5"))


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leakage.leaked_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"))


def p8_paraphrased(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leakage.paraphrased_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"))


def p9_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets"), tokenizer=TOKENIZER)


def p9_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture_shares(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets"), tokenizer=TOKENIZER)


def p10_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reading.reading_levels(table(spark, sf_dir, "documents"), table(spark, sf_dir, "reading_labels"))


def p10_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents per language and reading level."""
    return p10_levels(spark, sf_dir).groupBy("lang", "level").agg(F.count("*").alias("n"), F.round(F.avg("score"), 3).alias("mean_score"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "p1_found": p1_found,
    "p1_reasons": p1_reasons,
    "p2_found": p2_found,
    "p2_entities": p2_entities,
    "p4_found": p4_found,
    "p4_restored": p4_restored,
    "p5_found": p5_found,
    "p5_excess": p5_excess,
    "p5_cleaned": p5_cleaned,
    "p6_found": p6_found,
    "p6_main_text": p6_main_text,
    "p8_found": p8_found,
    "p8_paraphrased": p8_paraphrased,
    "p9_mixture": p9_mixture,
    "p9_shares": p9_shares,
    "p10_levels": p10_levels,
    "p10_profile": p10_profile,
}

_P5 = r"""
  lines as (select id, source_id, unnest(range(len(string_split(body, chr(10))))) as line_no, unnest(string_split(body, chr(10))) as line
            from contents where body is not null),
  keyed as (select id, source_id, line_no, line, lower(regexp_replace(line, '[^\p{L}]+', '', 'g')) as key from lines),
  hot as (select source_id, key from keyed where key <> '' group by all having count(distinct id) >= 5)
"""

_TERM = "({k} * ln(greatest(least({p}, 1 - 1e-12), 1e-12)) + ({n} - {k}) * ln(1 - greatest(least({p}, 1 - 1e-12), 1e-12)))"
_P5_EXCESS = f"""
  each as (select distinct id, source_id, key from keyed where key <> '' and source_id is not null),
  counted as (select source_id, key, count(*)::double as a from each group by all),
  sizes as (select source_id, count(*)::double as n1 from contents where body is not null and source_id is not null group by all),
  figures as (select source_id, key, a, sum(a) over (partition by key) - a as b, greatest(n1, a) as n1,
                greatest(greatest((select sum(n1) from sizes) - n1, 1), sum(a) over (partition by key) - a) as n2 from counted join sizes using (source_id)),
  rated as (select *, case when a / n1 > b / n2 then greatest(0.0, 2 * ({_TERM.format(k="a", n="n1", p="(a / n1)")} + {_TERM.format(k="b", n="n2", p="(b / n2)")}
                - {_TERM.format(k="a", n="n1", p="((a + b) / (n1 + n2))")} - {_TERM.format(k="b", n="n2", p="((a + b) / (n1 + n2))")})) else 0.0 end as llr from figures where a >= 2),
  tailed as (select *, sqrt(llr / 2) as x, 1 / (1 + 0.3275911 * sqrt(llr / 2)) as t from rated),
  p as (select *, least(1.0, t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429)))) * exp(-x * x)) as p_value from tailed),
  bins as (select floor(least(llr, 2000.0) * 100) as bin, count(*) as n, max(p_value) as p from p group by 1),
  ranked as (select bin, p, sum(n) over (order by bin desc) as rank, sum(n) over () as m from bins),
  bar as (select min(bin) / 100 as least from ranked where p <= 0.05 * rank / m)"""

SQL: dict[str, str] = {
    "p5_excess": f"with {_P5}, {_P5_EXCESS} select id as content_id, line_no::int as line_no from keyed join hot using (source_id, key) join p using (source_id, key) where llr >= (select least from bar)",
    "p5_found": f"with {_P5} select id as content_id, line_no::int as line_no from keyed join hot using (source_id, key)",
    "p5_cleaned": f"with {_P5}, kept as (select k.id, string_agg(line, chr(10) order by line_no) as body from keyed k "
    "left join hot h on h.source_id = k.source_id and h.key = k.key where h.key is null group by k.id) "
    "select c.id as content_id, length(coalesce(k.body, ''))::int as n_chars, md5(coalesce(k.body, '')) as body_md5 "
    "from contents c left join kept k on k.id = c.id",
}
