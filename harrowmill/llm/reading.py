"""Reading level of each document (problem 10).

Familiar-word formula: the share of words outside a list of frequent words, plus the average
sentence length.  A word is familiar in a language if at least `share` of that language's documents
hold it; document frequencies cover the whole corpus.  The list of a language cannot exceed the
mean number of different words a document has, divided by `share`, whatever the size of the corpus,
and may therefore be broadcast.

A level from 1 (easy) to 5 (hard) is read off the two figures with weights fitted to judgements,
language by language where there are enough of them.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harrowmill.session import cut_lineage, spread

_WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*")
_SENTENCE = re.compile(r"[.!?…。]+[”\"’»)\]]*(?:\s+|$)|\n+")
_LETTER = re.compile(r"[^\W\d_]")
_HANGUL = re.compile("[가-힣]")
#: Words a task counts before it hands them on.
HELD_WORDS = 400_000
#: Most judgements used for the fit, and least for a language to have weights of its own.
MOST_LABELS, LEAST_LABELS = 5000, 30


def base_language(lang: Column) -> Column:
    """'en' for 'en-US', 'EN' and the like; null for null and blank."""
    code = F.lower(F.regexp_extract(F.trim(lang), r"^([A-Za-z]{2,3})(?:[-_].*)?$", 1))
    return F.when(code != "", code)


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def sentences_of(text: str) -> int:
    """Stretches between sentence ends and line breaks that hold a letter; at least one."""
    return max(1, sum(_LETTER.search(x) is not None for x in _SENTENCE.split(text)))


def language_of(lang: str | None, text: str) -> str:
    """The stated language; without one Korean where a third of the signs are Hangul, else 'und'."""
    if lang is not None:
        return lang
    signs = len("".join(text.split()))
    return "ko" if len(_HANGUL.findall(text)) * 3 > signs else "und"


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", base_language(F.col("lang")).alias("lang"), "text").filter(F.col("doc_id").isNotNull() & F.col("text").isNotNull())


def familiar_words(docs: DataFrame, share: float = 0.02) -> DataFrame:
    """(lang, word, df): words in at least `share` of the documents of their language that have any word.

    Documents are counted within a task first; a row with the empty word counts the documents.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, Counter] = {}
        columns = ["lang", "word", "n"]

        def counted() -> pd.DataFrame:
            rows = [(lang, w, n) for lang, c in held.items() for w, n in c.items()]
            held.clear()
            return pd.DataFrame(rows, columns=columns)

        for batch in batches:
            for lang, text in zip(batch["lang"], batch["text"]):
                lang = language_of(lang, text)
                if lang != "und" and (w := words_of(text)):
                    c = held.setdefault(lang, Counter())
                    c.update(set(w))
                    c[""] += 1
            if sum(map(len, held.values())) >= HELD_WORDS:
                yield counted()
        yield counted()

    df = spread(_texts(docs), "doc_id").mapInPandas(count, "lang string, word string, n bigint").groupBy("lang", "word").agg(F.sum("n").alias("df"))
    df = cut_lineage(df)
    size = df.filter(F.col("word") == "").select("lang", F.col("df").alias("n"))
    return df.filter(F.col("word") != "").join(F.broadcast(size), "lang").filter(F.col("df") >= F.col("n") * share).select("lang", "word", "df")


def reading_figures(docs: DataFrame, share: float = 0.02) -> DataFrame:
    """(doc_id, lang, n_words, unfamiliar, sentence_words, score) per document with at least one word.

    Documents of unknown language are measured by the list that knows most of their words ('und' if none knows any).
    Of rows repeated under one doc_id the least remains.  The lists go to all tasks, see above for their size; words
    are looked up where the text is read and never shuffled.
    """
    lists: dict[str, set[str]] = {}
    for r in familiar_words(docs, share).toLocalIterator():
        lists.setdefault(r["lang"], set()).add(r["word"])
    names = sorted(lists)

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc, lang, text in zip(batch["doc_id"], batch["lang"], batch["text"]):
                w = words_of(text)
                if not w:
                    continue
                lang = language_of(lang, text)
                if lang == "und":
                    known, lang = max([(sum(map(lists[x].__contains__, w)), x) for x in names], default=(0, "und"))
                    lang = lang if known else "und"
                else:
                    known = sum(map(lists.get(lang, frozenset()).__contains__, w))
                out.append((doc, lang, len(w), known, sentences_of(text)))
            yield pd.DataFrame(out, columns=["doc_id", "lang", "n", "known", "sentences"])

    out = spread(_texts(docs), "doc_id").mapInPandas(measure, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, lang string, n bigint, known bigint, sentences bigint")
    unfamiliar = 1 - F.col("known") / F.col("n")
    length = F.col("n") / F.col("sentences")
    score = 0.1579 * 100 * unfamiliar + 0.0496 * length + F.when(unfamiliar > 0.05, 3.6365).otherwise(0.0)
    out = out.select("doc_id", "lang", F.col("n").alias("n_words"), F.round(unfamiliar, 6).alias("unfamiliar"), F.round(length, 6).alias("sentence_words"), F.round(score, 6).alias("score"))
    pick = F.min(F.struct("lang", "n_words", "unfamiliar", "sentence_words", "score")).alias("f")
    return out.groupBy("doc_id").agg(pick).select("doc_id", "f.*")


def fit_levels(figures: DataFrame, labels: DataFrame) -> dict[str, list[float]]:
    """Weights (constant, unfamiliar share, log sentence length) per language and, under '', for all others.

    Judgements of one document are averaged; at most MOST_LABELS of them, the lowest hashes, are used.
    """
    mean = labels.filter(F.col("doc_id").isNotNull() & F.col("level").between(1, 5)).groupBy("doc_id").agg(F.avg("level").alias("level"))
    rows = mean.join(figures, "doc_id").select("doc_id", "lang", "unfamiliar", "sentence_words", "level").orderBy(F.xxhash64("doc_id"), "doc_id").limit(MOST_LABELS).toPandas()
    if not len(rows):
        return {"": [1.0, 0.0, 1.0]}

    def solve(part: pd.DataFrame, prior: np.ndarray | None) -> np.ndarray:
        x = np.column_stack([np.ones(len(part)), part["unfamiliar"], np.log1p(part["sentence_words"])])
        ridge = np.diag([1e-6, 2.0, 0.2])
        y = part["level"].to_numpy(dtype=float)
        start = prior if prior is not None else np.array([y.mean(), 0.0, 0.0])
        return start + np.linalg.solve(x.T @ x + ridge, x.T @ (y - x @ start))

    pooled = solve(rows, None)
    out = {"": [float(v) for v in pooled]}
    for lang, part in rows.groupby("lang"):
        if len(part) >= LEAST_LABELS:
            out[str(lang)] = [float(v) for v in solve(part, pooled)]
    return out


def reading_levels(docs: DataFrame, labels: DataFrame, share: float = 0.02) -> DataFrame:
    """(doc_id, lang, score, level): formula score and calibrated level of every document with at least one word."""
    figures = cut_lineage(reading_figures(docs, share))
    weights = fit_levels(figures, labels)

    def predict(w: list[float]) -> Column:
        return w[0] + w[1] * F.col("unfamiliar") + w[2] * F.log1p("sentence_words")

    value = predict(weights[""])
    for lang in sorted(k for k in weights if k):
        value = F.when(F.col("lang") == lang, predict(weights[lang])).otherwise(value)
    level = F.least(F.greatest(F.round(value), F.lit(1.0)), F.lit(5.0)).cast("int")
    return figures.select("doc_id", "lang", "score", level.alias("level"))
