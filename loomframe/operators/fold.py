"""Causal post-processing of action streams, as folds: latch, rate limiter, boundary blend, and the three in one.

Each rule is a step function (state, row, ...) -> (state, output) over NumPy vectors: all dimensions of a frame at once,
frames in order. State is a dict of vectors, so that it fits typed columns of a state store. Batch runs a rule by
applyInPandas over each episode, in time that grows with its frames; streams run it on keyed state.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

E, FR = "episode_index", "frame_index"

State = dict[str, np.ndarray]
Rule = Callable[[State, np.ndarray, int], tuple[State, np.ndarray]]
#: All that a rule may keep between two frames of an episode.
FIELDS = ("last", "delta", "anchor", "closed", "count", "age", "limited", "initial")


def limit_step(state: State, row: np.ndarray, dims: list[int], most: list[float], most2: list[float] | None = None) -> tuple[State, np.ndarray]:
    """Clamp the change (and the change of the change) of some dimensions to the last output."""
    out, delta = row.copy(), state.get("delta", np.zeros(len(dims)))
    if "last" in state:
        step = np.clip(row[dims] - state["last"][dims], -np.asarray(most), most)
        if most2:
            step = delta + np.clip(step - delta, -np.asarray(most2), most2)
        out[dims], delta = state["last"][dims] + step, step
    return {**state, "last": out, "delta": delta}, out


def blend_step(state: State, row: np.ndarray, at: int, steps: int, dims: list[int]) -> tuple[State, np.ndarray]:
    """Ramp the first `steps` rows of a chunk from the last output (the first chunk's from its own first row): at is the row's place in its chunk."""
    if at == 0:
        state = {**state, "anchor": state.get("last", row)}
    out = row.copy()
    if at < steps:
        share = (at + 1) / steps
        out[dims] = (1 - share) * state["anchor"][dims] + share * row[dims]
    return {**state, "last": out}, out


def latch_step(state: State, row: np.ndarray, dims: list[int], intents: int, close: float = 0.7, open_: float = 0.3, min_close: int = 0, min_open: int = 0) -> tuple[State, np.ndarray]:
    """Hold 0 or 1 until `intents` rows in a row call for the other (at least `close`, at most `open_`) and the state has lasted long enough. state["initial"]: the row to start from."""
    closed = state["closed"] > 0 if "closed" in state else state["initial"][dims] >= 0.5 if "initial" in state else np.zeros(len(dims), bool)
    least = np.where(closed, min_close, min_open)
    count, age = state.get("count", np.zeros(len(dims))), state.get("age", least)
    count = np.where(np.where(closed, row[dims] <= open_, row[dims] >= close), count + 1, 0)
    turn = (count >= intents) & (age >= least)
    closed, count, age = closed ^ turn, np.where(turn, 0, count), np.where(turn, 0, age) + 1
    out = row.copy()
    out[dims] = closed
    return {**state, "closed": closed.astype(float), "count": count.astype(float), "age": age.astype(float)}, out


def compose(place_in_chunk: Callable[[int], int], dims: list[int], most: list[float], steps: int, latch_dims: list[int], intents: int, initial: list[float] | None = None, close: float = 0.7, open_: float = 0.3) -> Rule:
    """Blend, then limit, then latch; the blend starts from the final output. initial: the action before the first."""

    def step(state: State, row: np.ndarray, frame: int) -> tuple[State, np.ndarray]:
        if not state and initial is not None:
            first = np.array(initial, float)
            state = {"last": first, "limited": first, "initial": first}
        state, out = blend_step(state, row, place_in_chunk(frame), steps, dims)
        inner = {k: state[k] for k in ("delta",) if k in state} | ({"last": state["limited"]} if "limited" in state else {})
        inner, limited = limit_step(inner, out, dims, most)
        state, out = latch_step(state, limited, latch_dims, intents, close, open_)
        return {**state, "last": out, "limited": limited, "delta": inner["delta"]}, out

    return step


def run(rule: Rule, state: State, rows: Iterable[np.ndarray], frames: Iterable[int]) -> tuple[State, list[np.ndarray]]:
    """A rule over rows in order."""
    out = []
    for row, frame in zip(rows, frames):
        state, x = rule(state, np.asarray(row, float), int(frame))
        out.append(x)
    return state, out


def run_batch(frames: DataFrame, v: str, rule: Rule) -> DataFrame:
    """A rule over each episode's frames in order: rows (episode, frame, x). An episode, which is a recording's length, is one group."""

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(FR)
        return pd.DataFrame({E: pdf[E], FR: pdf[FR], "x": run(rule, {}, pdf[v], pdf[FR])[1]})

    return frames.select(E, FR, v).groupBy(E).applyInPandas(fold, f"{E} bigint, {FR} bigint, x array<double>")
