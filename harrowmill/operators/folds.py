"""Order-dependent state machines over the events of one key.

Rows are brought together by key and sorted within partitions; each task then walks through its
rows batch by batch and carries only the state of the current key.  A key with a third of all
events is walked by one task, as its order demands, but it is never gathered in memory.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame


def walk(events: DataFrame, keys: list[str], fields: list[str], schema: str, fresh: Callable[[], Any], step: Callable[[Any, tuple], list | None], close: Callable[[Any], list | None] | None = None) -> DataFrame:
    """Runs step(state, row) over the rows of each key in (ts_us, id) order; step and close may return output rows without keys."""
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, state = None, None
        for b in batches:
            out: list[tuple] = []
            for row in b.itertuples(index=False, name=None):
                key, rest = row[: len(keys)], row[len(keys) :]
                if key != current:
                    if current is not None and close:
                        out += [(*current, *r) for r in close(state) or []]
                    current, state = key, fresh()
                out += [(*key, *r) for r in step(state, rest) or []]
            yield pd.DataFrame(out, columns=names)
        if current is not None and close:
            yield pd.DataFrame([(*current, *r) for r in close(state) or []], columns=names)

    order = [*keys, *[c for c in ("ts_us", "id")]]
    return events.select(*keys, *fields).repartition(*keys).sortWithinPartitions(*order).mapInPandas(run, schema)


def _with_keys(events: DataFrame, keys: list[str], rest: str) -> str:
    types = dict(events.dtypes)
    return ", ".join(f"{k} {types[k]}" for k in keys) + ", " + rest


def ttl_accepts(events: DataFrame, keys: list[str], ttl: int | str) -> DataFrame:
    """(keys, ts_us, id, accepted): an event is accepted unless one was accepted less than a TTL before; rejects do not extend.

    ttl: microseconds, or the name of a column that gives them; the TTL of the accepted event holds.
    """
    own = isinstance(ttl, str)

    def step(state: dict, row: tuple) -> list:
        t = int(row[0])
        ok = state["until"] is None or t >= state["until"]
        if ok:
            state["until"] = t + (int(row[2]) if own else ttl)
        return [(t, row[1], ok)]

    fields = ["ts_us", "id", *([ttl] if own else [])]
    return walk(events, keys, fields, _with_keys(events, keys, f"ts_us bigint, id {dict(events.dtypes)['id']}, accepted boolean"), lambda: {"until": None}, step)


def token_bucket(events: DataFrame, keys: list[str], per_hour: float, burst: float) -> DataFrame:
    """(keys, allowed, refused): bucket of `burst` tokens refilled at per_hour/3600 a second; per_hour <= 0 is unlimited."""

    def step(state: dict, row: tuple) -> None:
        t = int(row[0])
        if state["at"] is not None:
            state["tokens"] = min(state["tokens"] + (t - state["at"]) / 1e6 * (per_hour / 3600.0), float(burst))
        state["at"] = t
        if per_hour <= 0 or state["tokens"] >= 1.0:
            state["tokens"] -= per_hour > 0
            state["allowed"] += 1
        else:
            state["refused"] += 1

    schema = _with_keys(events, keys, "allowed bigint, refused bigint")
    return walk(events, keys, ["ts_us", "id"], schema, lambda: {"tokens": float(burst), "at": None, "allowed": 0, "refused": 0}, step, lambda s: [(s["allowed"], s["refused"])])


def circuit_breaker(events: DataFrame, keys: list[str], failures: int, cooldown_us: int) -> DataFrame:
    """(keys, admitted, rejected, opened): `failures` failures in a row open it; after the cooldown one probe decides."""

    def step(state: dict, row: tuple) -> None:
        t, ok = int(row[0]), bool(row[2])
        if state["until"] is not None and t < state["until"]:
            state["rejected"] += 1
            return
        probe = state["until"] is not None
        state["admitted"] += 1
        state["run"] = 0 if ok else state["run"] + 1
        if not ok and (probe or state["run"] >= failures):
            state.update(until=t + cooldown_us, run=0, opened=state["opened"] + 1)
        else:
            state["until"] = None

    schema = _with_keys(events, keys, "admitted bigint, rejected bigint, opened bigint")
    fresh = lambda: {"run": 0, "until": None, "admitted": 0, "rejected": 0, "opened": 0}
    return walk(events, keys, ["ts_us", "id", "ok"], schema, fresh, step, lambda s: [(s["admitted"], s["rejected"], s["opened"])])


def host_breaker(events: DataFrame, keys: list[str], hits: int = 3, cooldown_us: int = 600_000_000) -> DataFrame:
    """(keys, admitted, refused, blocked): `hits` rate-limit answers in a row shut a host for the cooldown.

    events have limited(boolean).  A call at the end of the cooldown is admitted and starts afresh, any other answer
    clears the count, and refused calls have no answer.
    """

    def step(state: dict, row: tuple) -> None:
        t = int(row[0])
        if state["until"] is not None:
            if t < state["until"]:
                state["refused"] += 1
                return
            state.update(until=None, run=0)
        state["admitted"] += 1
        state["run"] = state["run"] + 1 if row[2] else 0
        if state["run"] >= hits:
            state.update(until=t + cooldown_us, blocked=state["blocked"] + 1)

    fresh = lambda: {"run": 0, "until": None, "admitted": 0, "refused": 0, "blocked": 0}
    schema = _with_keys(events, keys, "admitted bigint, refused bigint, blocked bigint")
    return walk(events, keys, ["ts_us", "id", "limited"], schema, fresh, step, lambda s: [(s["admitted"], s["refused"], s["blocked"])])


def smoothed(events: DataFrame, keys: list[str], value: str, alpha: float = 0.2, failed: str | None = None) -> DataFrame:
    """(keys, ema, n, failures, failure_rate): exponential moving average in event order, the first sample is the seed.

    failed: a boolean column; without one no event has failed.
    """

    def step(state: dict, row: tuple) -> None:
        v = float(row[2])
        state["ema"] = v if state["n"] == 0 else alpha * v + (1 - alpha) * state["ema"]
        state["n"] += 1
        state["failures"] += bool(failed and row[3])

    schema = _with_keys(events, keys, "ema double, n int, failures int, failure_rate double")
    fresh = lambda: {"ema": None, "n": 0, "failures": 0}
    return walk(events, keys, ["ts_us", "id", value, *([failed] if failed else [])], schema, fresh, step, lambda s: [(s["ema"], s["n"], s["failures"], s["failures"] / s["n"])])
