"""Evaluation texts leaking into training text (problem 8).

Latent semantic retrieval.  Documents are cut into passages of 24 words, 12 apart, so that every
run of 12 words lies inside one passage; items are cut into windows of 12 words, 3 apart.  TF-IDF
weights use document frequencies over all passages.  A randomised SVD of the passage matrix, done
by distributed products with a small right factor, gives the latent space; passages whose cosine
with an item window reaches the threshold are candidates, which are then compared word by word.

Only words of the items carry weight, so the right factor has one row per item word: it is bounded
by the stated item set, not by the corpus.  The space is fitted on at most fit_passages passages, those with the
smallest hashes; counts, search and checks take every passage.  All passages are cut and the space is fitted once;
the stated items are then compared with all passages in blocks of max_items.  A passage with fewer item words than a
run or, where paraphrases are wanted, than the least subsequence asked for, cannot hold either and is skipped.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harrowmill.llm.text import words
from harrowmill.session import cut_lineage, spread

WIDTH, RUN = 24, 12
#: Passages weighted at a time, and tasks that share the sample the space is fitted on.
CHUNK, FIT_TASKS = 512, 8


class ItemSet:
    """Words, windows and 12-word runs of a block of items; plain data for the workers."""

    def __init__(self, rows: list[tuple[int, str]], run: int, step: int):
        self.run = run
        self.tokens = {i: words(t) for i, t in rows}
        self.vocab = {w: k for k, w in enumerate(sorted({w for t in self.tokens.values() for w in t}))}
        ids = {i: [self.vocab[w] for w in t] for i, t in self.tokens.items()}
        self.ids = ids
        self.owner, self.windows = [], []
        self.grams: dict[tuple[int, ...], list[int]] = defaultdict(list)
        for i, t in ids.items():
            last = max(0, len(t) - run)
            for s in sorted({*range(0, last + 1, step), last}):
                self.owner.append(i)
                self.windows.append(t[s : s + run])
            for s in range(len(t) - run + 1):
                owners = self.grams[tuple(t[s : s + run])]
                if i not in owners:
                    owners.append(i)


def _weighted(windows: list, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(unit rows of tf * idf over the words that occur, numbers of these words); ids below zero are words that no item has."""
    size = np.fromiter(map(len, windows), dtype=np.int64, count=len(windows))
    flat = np.concatenate([np.asarray(w, dtype=np.int64) for w in windows]) if len(windows) else np.zeros(0, dtype=np.int64)
    row = np.repeat(np.arange(len(windows)), size)
    row, flat = row[flat >= 0], flat[flat >= 0]
    pair, n = np.unique(row * len(idf) + flat, return_counts=True)
    row, word = pair // len(idf), pair % len(idf)
    weight = (1.0 + np.log(n)) * idf[word]
    norm = np.sqrt(np.bincount(row, weight**2, minlength=len(windows)))
    used, at = np.unique(word, return_inverse=True)
    out = np.zeros((len(windows), len(used)), dtype=np.float32)
    out[row, at] = weight / np.where(norm == 0, 1, norm)[row]
    return out, used


def _passages(docs: DataFrame, items: ItemSet, least: int) -> DataFrame:
    """(doc_id, start, terms) of passages with at least `least` item words, and (null, term, [df, passages]) counts per task."""
    vocab, run, width = items.vocab, items.run, WIDTH
    step = width - run

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        df, total = np.zeros(len(vocab), dtype=np.int64), 0
        for batch in batches:
            texts = [np.fromiter((vocab.get(w, -1) for w in words(text)), dtype=np.int64) for text in batch["text"]]
            size = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
            number = np.maximum(1, -((run - 1 - size) // step))
            base = np.concatenate([[0], np.cumsum(number)])
            total += int(base[-1])
            flat = np.concatenate(texts) if len(texts) else np.zeros(0, dtype=np.int64)
            doc = np.repeat(np.arange(len(texts)), size)
            place = np.arange(len(flat)) - np.repeat(np.concatenate([[0], np.cumsum(size)[:-1]]), size) if len(flat) else flat
            known = flat >= 0
            doc, place, flat = doc[known], place[known], flat[known]
            held = np.zeros(base[-1], dtype=np.int64)
            pairs = []
            # A word lies in the passages that begin up to a width before it.
            for back in range(-(-width // step)):
                k = place // step - back
                ok = (k >= 0) & (k < number[doc]) & (place < k * step + width)
                at = base[doc[ok]] + k[ok]
                held += np.bincount(at, minlength=base[-1])
                pairs.append(at * len(vocab) + flat[ok])
            df += np.bincount(np.unique(np.concatenate(pairs)) % len(vocab), minlength=len(vocab))
            out = []
            for g in np.flatnonzero(held >= least):
                d = int(np.searchsorted(base, g, side="right")) - 1
                s = int(g - base[d]) * step
                out.append((batch["doc_id"].iloc[d], s, texts[d][s : s + width].astype(np.int32)))
            if out:
                yield pd.DataFrame(out, columns=["doc_id", "start", "terms"])
        rows = [(None, k, [int(n), 0]) for k, n in enumerate(df) if n] + [(None, -1, [0, total])]
        counts = pd.DataFrame(rows, columns=["doc_id", "start", "terms"])
        counts["doc_id"] = counts["doc_id"].astype("Int64")
        yield counts

    return spread(docs.select("doc_id", "text").filter(F.col("doc_id").isNotNull()), "doc_id").mapInPandas(cut, "doc_id bigint, start int, terms array<int>")


def _sum_rows(df: DataFrame, size: int, width: int) -> np.ndarray:
    """Sum of vectors per row number; at most `size` rows of `width` numbers reach the driver."""
    summed = df.groupBy("row").agg(vector_to_array(Summarizer.sum(array_to_vector("vec"))).alias("vec"))
    out = np.zeros((size, width))
    for r in summed.toLocalIterator():
        out[r["row"]] = r["vec"]
    return out


def _own_product(windows: list, idf: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Weighted windows times a right factor, a chunk of windows at a time."""
    parts = [_weighted(windows[lo : lo + CHUNK], idf) for lo in range(0, len(windows), CHUNK)]
    return np.concatenate([a @ right[used] for a, used in parts])


def latent_space(passages: DataFrame, windows: list, idf: np.ndarray, rank: int, power: int, seed: int) -> np.ndarray:
    """Right singular vectors (terms x rank) of the passage matrix with the items' own windows added.

    Tasks without passages give no rows; without any passage the items' windows alone span the space.
    """
    size = len(idf)
    width = min(size, rank + 16)
    basis = np.linalg.qr(np.random.default_rng(seed).standard_normal((size, width)))[0]

    def products(right: np.ndarray, gram: bool):
        """Per task the rows of A'(A right), or of (A right)'(A right)."""
        right = right.astype(np.float32)

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total = np.zeros((width if gram else size, width))
            for batch in batches:
                for lo in range(0, len(batch), CHUNK):
                    a, used = _weighted(list(batch["terms"].iloc[lo : lo + CHUNK]), idf)
                    y = a @ right[used]
                    if gram:
                        total += y.T @ y
                    else:
                        total[used] += a.T @ y
            hot = np.flatnonzero(np.abs(total).sum(axis=1))
            if len(hot):
                yield pd.DataFrame({"row": hot.astype("int32"), "vec": [total[k] for k in hot]})

        return passages.mapInPandas(run, "row int, vec array<double>")

    for _ in range(power):
        b = _sum_rows(products(basis, False), size, width)
        for lo in range(0, len(windows), CHUNK):
            a, used = _weighted(windows[lo : lo + CHUNK], idf)
            b[used] += a.T @ (a @ basis[used])
        basis = np.linalg.qr(b)[0]
    y = _own_product(windows, idf, basis)
    small = _sum_rows(products(basis, True), width, width) + y.T @ y
    values, vectors = np.linalg.eigh(small)
    return (basis @ vectors[:, np.argsort(-values)[:rank]]).astype(np.float32)


def _lcs(a: list[int], b: list[int]) -> int:
    """Length of the longest common subsequence, bit-parallel."""
    where: dict[int, int] = defaultdict(int)
    for i, x in enumerate(a):
        where[x] |= 1 << i
    row = full = (1 << len(a)) - 1
    for x in b:
        u = row & where.get(x, 0)
        row = ((row + u) | (row - u)) & full
    return len(a) - bin(row).count("1")


def leaked_passages(
    docs: DataFrame, items: DataFrame, *, run: int = RUN, step: int = 3, rank: int = 160, power: int = 2, threshold: float = 0.45,
    lcs: float | None = 0.75, keys: float = 0.75, max_items: int = 2000, fit_passages: int = 40_000, seed: int = 11,
) -> DataFrame:
    """(doc_id, item_id, score, longest_run, lcs_share, key_share): candidates checked word by word.

    score: best latent cosine of a passage with a window of the item.  longest_run: `run` or more if
    a passage holds that many consecutive words of the item (else 0).  lcs_share: share of an item
    window that is a subsequence of the passage, and key_share: share of its numbers and rare words
    (its answers) found there; both are of one window and passage, the best of those that reach `lcs`
    and `keys`, else the best that reaches `lcs`.  Every candidate is checked, whatever its cosine; a
    window that shares too few words with the passage to reach `lcs` counts as 0.  lcs None leaves
    paraphrases out.  Null or empty texts and items hold nothing; items shorter
    than `run` words are compared as paraphrases only; equal texts each get their rows; repeated rows
    of a doc_id give one row per item.
    """
    schema = "doc_id bigint, item_id bigint, score double, longest_run int, lcs_share double, key_share double"
    listed = items.select(F.col("item_id").cast("bigint").alias("item_id"), "text").filter(F.col("item_id").isNotNull() & F.col("text").isNotNull())
    every = ItemSet(sorted({(r["item_id"], r["text"]) for r in listed.toLocalIterator()}), run, step)
    if not every.vocab:
        return docs.sparkSession.createDataFrame([], schema)
    # Matches that a window needs to reach the share asked for.
    needed = [max(1, math.ceil(lcs * len(w) - 1e-9)) for w in every.windows] if lcs is not None else [0] * len(every.windows)
    least = min([run, *(n for n, w in zip(needed, every.windows) if w and n)])
    cut = cut_lineage(_passages(docs, every, least))
    counts = cut.filter(F.col("doc_id").isNull()).groupBy("start").agg(
        F.sum(F.element_at("terms", 1).cast("bigint")).alias("df"), F.sum(F.element_at("terms", 2).cast("bigint")).alias("n")
    )
    df, total = np.zeros(len(every.vocab)), 0
    for r in counts.toLocalIterator():  # one row per item word
        if r["start"] < 0:
            total = r["n"]
        else:
            df[r["start"]] = r["df"]
    idf = np.log((1.0 + total) / (1.0 + df)) + 0.05
    passages = cut.filter(F.col("doc_id").isNotNull())
    sample = passages.orderBy(F.xxhash64("doc_id", "start"), "doc_id", "start").limit(fit_passages).repartition(FIT_TASKS, "doc_id", "start")
    space = latent_space(cut_lineage(sample), every.windows, idf, rank, power, seed)
    latent = _own_product(every.windows, idf, space)
    latent /= np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-9)
    owner = np.array(every.owner)
    items_in_order = list(dict.fromkeys(every.owner))
    found = None
    for lo in range(0, len(items_in_order), max_items):
        block = np.flatnonzero(np.isin(owner, items_in_order[lo : lo + max_items]))
        part = _search(passages, every, block, owner, latent, space, idf, needed, threshold, lcs, keys, schema)
        found = part if found is None else found.unionByName(part)
    # Both shares of one window: the highest of each apart may belong to different places.
    best = F.max(F.struct((F.col("key_share") >= keys).alias("ok"), "lcs_share", "key_share")).alias("_b")
    out = found.groupBy("doc_id", "item_id").agg(F.max("score").alias("score"), F.max("longest_run").alias("longest_run"), best)
    return out.select("doc_id", "item_id", "score", "longest_run", F.col("_b.lcs_share").alias("lcs_share"), F.col("_b.key_share").alias("key_share"))


def _search(passages, items: ItemSet, block, owner, latent, space, idf, needed, threshold, lcs, keys, schema) -> DataFrame:
    """One block of the stated items against every passage."""
    run = items.run
    owner, latent = owner[block], latent[block]
    windows, needed = [items.windows[k] for k in block], [needed[k] for k in block]
    wanted = set(owner.tolist())
    grams = {g: [i for i in of if i in wanted] for g, of in items.grams.items() if not wanted.isdisjoint(of)}
    typical = np.median(idf)
    keyed = [{k for k in w if idf[k] >= typical} for w in windows]

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for lo in range(0, len(batch), CHUNK):
                part = batch.iloc[lo : lo + CHUNK]
                terms = [list(map(int, t)) for t in part["terms"]]
                weights, used = _weighted(terms, idf)
                p = weights @ space[used]
                p /= np.maximum(np.linalg.norm(p, axis=1, keepdims=True), 1e-9)
                cosine = p @ latent.T
                hit, of = np.nonzero(cosine >= threshold)
                ends = np.searchsorted(hit, np.arange(len(terms) + 1))
                for r, (doc, t) in enumerate(zip(part["doc_id"], terms)):
                    near = of[ends[r] : ends[r + 1]]
                    if not len(near):
                        continue
                    best: dict[int, list] = {}
                    held = set(t)
                    for k, i, c in zip(near.tolist(), owner[near].tolist(), cosine[r, near].tolist()):
                        b = best.setdefault(i, [0.0, 0, 0.0, 0.0])
                        b[0] = max(b[0], c)
                        if lcs is None or not windows[k] or sum(x in held for x in windows[k]) < needed[k]:
                            continue
                        share = _lcs(windows[k], t) / len(windows[k])
                        if share >= lcs:
                            key = len(keyed[k] & held) / max(1, len(keyed[k]))
                            if (key >= keys, share, key) > (b[3] >= keys, b[2], b[3]):
                                b[2], b[3] = share, key
                    for s in range(len(t) - run + 1):
                        for i in grams.get(tuple(t[s : s + run]), ()):
                            if i in best:
                                best[i][1] = run
                    out += [(int(doc), i, *b) for i, b in best.items() if b[1] or b[2] > 0]
            yield pd.DataFrame(out, columns=["doc_id", "item_id", "score", "longest_run", "lcs_share", "key_share"])

    return passages.mapInPandas(search, schema)


def leaked_documents(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """(doc_id, item_id) of documents that hold at least `run` consecutive words of an item."""
    return leaked_passages(docs, items, lcs=None, **options).filter(F.col("longest_run") > 0).select("doc_id", "item_id")


def paraphrased_documents(docs: DataFrame, items: DataFrame, lcs: float = 0.75, keys: float = 0.75, **options) -> DataFrame:
    """Documents without a full run that still hold most of a window in order, with its numbers and rare words."""
    near = leaked_passages(docs, items, lcs=lcs, keys=keys, **options)
    return near.filter((F.col("longest_run") == 0) & (F.col("lcs_share") >= lcs) & (F.col("key_share") >= keys)).drop("longest_run")
