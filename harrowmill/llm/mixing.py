"""Mixing sources to target weights (problem 9).

Sizes are tokens of a public tokenizer.  The total is the largest one at which every source reaches
its share without being repeated more often than allowed.  Each document of a source then has the
same expected number of copies; its whole part is given to all, its fraction is drawn by the cube
method: within a block, fractional inclusion probabilities move along the null-space of the
constraints (documents, tokens) until all but two are zero or one.  What blocks leave over is
balanced again, level by level, until two documents a source remain; these land by least error.

A source with a third of all documents is many blocks; a block holds about BLOCK documents.
"""

from __future__ import annotations

import base64
import random
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from harrowmill.session import cut_lineage, spread

#: Splitting pattern of the tokenizer.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
BLOCK, FAN_IN = 20_000, 500
_EPS = 1e-9


def token_sizes(docs: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, source, tokens) of documents with id, source and text; the vocabulary (under 1 MB) is sent to the workers."""
    with open(tokenizer, "rb") as f:
        vocabulary = f.read()

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines())}
        coder = tiktoken.Encoding("sizes", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc_id"], "source": b["source"], "tokens": [len(coder.encode_ordinary(t)) for t in b["text"]]})

    kept = docs.select("doc_id", "source", "text").filter(F.col("doc_id").isNotNull() & F.col("source").isNotNull() & F.col("text").isNotNull())
    return spread(kept, "doc_id").mapInPandas(count, "doc_id bigint, source string, tokens bigint")


def mixture_plan(totals: list[tuple[str, int, int]], targets: list[tuple[str, float, int]]) -> dict[str, dict]:
    """Expected copies per source from (source, docs, tokens) and (source, target_share, max_repeats).

    Shares of targets that have no tokens go to the others in proportion.
    """
    have = {s: (n, t) for s, n, t in totals if t > 0}
    wanted = {}
    for s, share, most in targets:
        if s is not None and share is not None and share > 0 and (most or 0) > 0 and s not in wanted:
            wanted[s] = (float(share), int(most))
    reachable = {s: v for s, v in wanted.items() if s in have}
    norm = sum(share for share, _ in reachable.values())
    total = min((most * have[s][1] * norm / share for s, (share, most) in reachable.items()), default=0.0)
    plan = {}
    for s, (share, most) in wanted.items():
        n, t = have.get(s, (0, 0))
        copies = share / norm * total / t if t else 0.0
        plan[s] = {"target_share": share, "max_repeats": most, "docs": n, "tokens": t, "copies": min(copies, float(most))}
    return plan


def cube_flight(pi: list[float], size: list[float], rng: random.Random) -> list[float]:
    """Moves probabilities until at most two are fractional, keeping their sum and their sum weighted by size."""
    out = list(pi)
    active: list[int] = []
    for k in range(len(out)):
        if not _EPS < out[k] < 1 - _EPS:
            out[k] = float(round(out[k]))
            continue
        active.append(k)
        while len(active) == 3:
            a, b, c = active
            u = (size[b] - size[c], size[c] - size[a], size[a] - size[b])
            if not any(u):
                u = (1.0, -1.0, 0.0)
            up = down = float("inf")
            for i, d in zip(active, u):
                if d > 0:
                    up, down = min(up, (1 - out[i]) / d), min(down, out[i] / d)
                elif d < 0:
                    up, down = min(up, -out[i] / d), min(down, -(1 - out[i]) / d)
            step = up if rng.random() * (up + down) < down else -down
            rest = []
            for i, d in zip(active, u):
                out[i] += step * d
                if out[i] < _EPS:
                    out[i] = 0.0
                elif out[i] > 1 - _EPS:
                    out[i] = 1.0
                else:
                    rest.append(i)
            active = rest
    return out


_ROWS = "doc_id bigint, source string, tokens bigint, block int, pi double"


def _balanced(rows: DataFrame, seed: int) -> DataFrame:
    def flight(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values(["doc_id", "tokens"], kind="stable")
        rng = random.Random(f"{seed}|{block['source'].iloc[0]}|{int(block['block'].iloc[0])}|{len(block)}")
        order = list(range(len(block)))
        rng.shuffle(order)
        block = block.iloc[order]
        return block.assign(pi=cube_flight(block["pi"].tolist(), block["tokens"].astype(float).tolist(), rng))[[c.split()[0] for c in _ROWS.split(", ")]]

    return rows.groupBy("source", "block").applyInPandas(flight, _ROWS)


def _land(rest: list[tuple[int, str, int, int, float]]) -> list[tuple[int, str, int, int, float]]:
    """The last one or two documents of each source: the outcome nearest to the expected documents and tokens."""
    out = []
    for source in sorted({r[1] for r in rest}):
        own = sorted(r for r in rest if r[1] == source)
        docs, tokens = sum(r[4] for r in own), sum(r[4] * r[2] for r in own)
        scale = max(1, max(r[2] for r in own))
        best = None
        for code in range(2 ** len(own)):
            picks = [code >> i & 1 for i in range(len(own))]
            error = abs(sum(picks) - docs) * 0.1 + abs(sum(p * r[2] for p, r in zip(picks, own)) - tokens) / scale
            if best is None or error < best[0] - _EPS:
                best = (error, picks)
        out += [(*r[:4], float(p)) for r, p in zip(own, best[1])]
    return out


def mixture(docs: DataFrame, targets: DataFrame, *, tokenizer: str, seed: int = 17) -> DataFrame:
    """(doc_id, source, tokens, copies) of documents in the mixture.

    Sources without target, documents without text and targets without documents take no part; documents given twice
    are two documents.  No source is repeated more than max_repeats times.
    """
    sizes = cut_lineage(token_sizes(docs, tokenizer))
    spark = docs.sparkSession
    wanted = [(r["source"], r["target_share"], r["max_repeats"]) for r in targets.select("source", "target_share", "max_repeats").collect()]  # stated targets
    if not wanted:
        return sizes.limit(0).withColumn("copies", F.lit(0))
    named = spark.createDataFrame([(s,) for s in sorted({w[0] for w in wanted if w[0] is not None})], "source string")
    sizes = sizes.join(F.broadcast(named), "source").select("doc_id", "source", "tokens")
    totals = [(r["source"], r["n"], r["t"]) for r in sizes.groupBy("source").agg(F.count("*").alias("n"), F.sum("tokens").alias("t")).collect()]  # one row per target
    plan = mixture_plan(totals, wanted)
    facts = [(s, int(p["copies"] + 1e-9), max(0.0, p["copies"] - int(p["copies"] + 1e-9)), -(-p["docs"] // BLOCK)) for s, p in plan.items() if p["docs"]]
    if not facts:
        return sizes.limit(0).withColumn("copies", F.lit(0))
    table = spark.createDataFrame(facts, "source string, whole int, pi double, blocks int")
    rows = sizes.join(F.broadcast(table), "source")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.col("blocks")).cast("int"))
    flown = cut_lineage(_balanced(rows.select("doc_id", "source", "tokens", "block", "pi"), seed))
    open_ = (F.col("pi") > _EPS) & (F.col("pi") < 1 - _EPS)
    done = flown.filter(~open_)
    rest = flown.filter(open_)
    blocks = max(f[3] for f in facts)
    while blocks > 1:
        blocks = -(-blocks // FAN_IN)
        rest = rest.withColumn("block", F.floor(F.col("block") / FAN_IN).cast("int"))
        again = cut_lineage(_balanced(rest, seed))
        done, rest = done.unionByName(again.filter(~open_)), again.filter(open_)
    last = _land([tuple(r) for r in rest.select("doc_id", "source", "tokens", "block", "pi").collect()])  # at most two per target
    if last:
        done = done.unionByName(spark.createDataFrame(last, _ROWS))
    out = done.join(F.broadcast(table.select("source", "whole")), "source")
    out = out.select("doc_id", "source", "tokens", (F.col("whole") + F.round("pi").cast("int")).alias("copies"))
    return out.filter(F.col("copies") > 0)


def mixture_shares(docs: DataFrame, targets: DataFrame, **options) -> DataFrame:
    """(source, target_share, max_repeats, docs, draws, tokens, most_copies, actual_share), one row per target."""
    chosen = mixture(docs, targets, **options)
    got = chosen.groupBy("source").agg(
        F.count("*").alias("docs"), F.sum("copies").alias("draws"), F.sum(F.col("copies") * F.col("tokens")).alias("tokens"), F.max("copies").alias("most_copies")
    )
    named = targets.select("source", "target_share", "max_repeats").filter(F.col("source").isNotNull()).dropDuplicates(["source"])
    out = named.join(F.broadcast(got), "source", "left").fillna(0, ["docs", "draws", "tokens", "most_copies"])
    total = F.sum("tokens").over(W.partitionBy(F.lit(0)))  # one row per target
    share = F.when(total > 0, F.round(F.col("tokens") / total, 6)).otherwise(F.lit(0.0)).alias("actual_share")
    return out.select("source", "target_share", "max_repeats", "docs", "draws", "tokens", "most_copies", share)
