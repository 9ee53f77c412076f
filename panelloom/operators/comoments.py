"""Co-moments of every column pair in one scan: packed triangles, one row per task, merged in a tree.

A state holds, per pair of columns, the rows where both are known, both means, the sums of squares and of products
around them, and the size of the terms those sums were made of. Two states merge without knowing a common shift, so
no earlier pass has to find the means.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelloom.session import materialize

#: States that one task merges in a round.
FAN = 64
#: Pairs in one row; a triangle of more pairs is cut into bands, so no cell grows with the square of the columns.
BAND = 1 << 16
#: Below this part of its terms a sum of squares is rounding: the side is constant over the shared rows.
ROUNDING = 1e-13
_FIELDS = 8  # n, mean x, mean y, xx, yy, xy, size of xx, size of yy
_STATE = pa.schema([("part", pa.int64()), ("band", pa.int32()), ("state", pa.binary())])
_STATE_DDL = "part long, band int, state binary"


def batch_state(x: np.ndarray) -> np.ndarray:
    """The state of some rows; NaN is missing. A constant column has a spread of exactly zero."""
    known = ~np.isnan(x)
    at = np.argmax(known, axis=0)
    first = np.nan_to_num(x[at, np.arange(x.shape[1])], nan=0.0)
    d = np.where(known, x - first, 0.0)
    center = d.sum(axis=0) / np.maximum(known.sum(axis=0), 1)
    d = np.where(known, d - center, 0.0)
    shift = first + center
    seen = known.astype(float)
    n, s, q, c = seen.T @ seen, d.T @ seen, (d * d).T @ seen, d.T @ d
    i, j = np.triu_indices(x.shape[1], 1)
    n, sx, sy = n[i, j], s[i, j], s[j, i]
    each = 1.0 / np.maximum(n, 1.0)
    xx, yy = q[i, j], q[j, i]
    return np.stack([
        n, shift[i] + sx * each, shift[j] + sy * each, xx - sx * sx * each, yy - sy * sy * each, c[i, j] - sx * sy * each,
        xx, yy,
    ])


def merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The state of the rows of both."""
    n = a[0] + b[0]
    share = b[0] / np.maximum(n, 1.0)
    weight = a[0] * share
    dx, dy = (np.where(weight > 0, b[k] - a[k], 0.0) for k in (1, 2))
    mean = [np.where(a[0] > 0, a[k] + d * share, b[k]) for k, d in ((1, dx), (2, dy))]
    xx, yy = dx * dx * weight, dy * dy * weight
    return np.stack([
        n, *mean, a[3] + b[3] + xx, a[4] + b[4] + yy, a[5] + b[5] + dx * dy * weight, a[6] + b[6] + xx, a[7] + b[7] + yy,
    ])


def _bands(pairs: int, band: int) -> range:
    return range(-(-pairs // band))


def _rows(part: int, state: np.ndarray, band: int) -> pa.RecordBatch:
    bands = _bands(state.shape[1], band)
    cut = [{"part": part, "band": b, "state": state[:, b * band : (b + 1) * band].tobytes()} for b in bands]
    return pa.RecordBatch.from_pylist(cut, schema=_STATE)


def _of(cell: bytes) -> np.ndarray:
    return np.frombuffer(cell).reshape(_FIELDS, -1)


def task_states(data: DataFrame, pairs: int, band: int = BAND) -> DataFrame:
    """Stored ``(part, band, state)``: one row per task that saw rows (one per band of a wide table)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None
        for batch in batches:
            if batch.num_rows:
                x = np.column_stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns])
                state = batch_state(x) if state is None else merged(state, batch_state(x))
        if state is not None:
            yield _rows(TaskContext.get().partitionId(), state, band)

    return materialize(data.mapInArrow(run, _STATE_DDL), "co-moments")


def tree_merged(states: DataFrame, fan: int = FAN) -> DataFrame:
    """One row per band: states of neighbouring parts meet in rounds, ``fan`` at a time, one state held by a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, key = None, None
        for batch in batches:
            for part, band, cell in zip(*(batch.column(c).to_pylist() for c in ("part", "band", "state")), strict=True):
                if key == (part, band):
                    held = merged(held, _of(cell))
                    continue
                if key is not None:
                    yield pa.RecordBatch.from_pylist([{"part": key[0], "band": key[1], "state": held.tobytes()}], schema=_STATE)
                held, key = _of(cell), (part, band)
        if key is not None:
            yield pa.RecordBatch.from_pylist([{"part": key[0], "band": key[1], "state": held.tobytes()}], schema=_STATE)

    last = states.agg(F.max("part")).first()[0] or 0
    rounds = 1
    while last >= fan:
        last, rounds = last // fan, rounds + 1
    for _ in range(rounds):
        placed = states.withColumn("part", F.floor(F.col("part") / fan)).repartition("part", "band")
        states = placed.sortWithinPartitions("part", "band").mapInArrow(run, _STATE_DDL)
    return states


def pair_correlations(df: DataFrame, names: Sequence[str], band: int = BAND) -> DataFrame:
    """``(i, j, correlation)`` for i < j over double columns ``names``; NULL where a side does not vary or no row is shared."""
    p = len(names)
    pairs = p * (p - 1) // 2
    states = task_states(df.select(*names), pairs, band)
    none = [(0, b, np.zeros((_FIELDS, min(band, pairs - b * band))).tobytes()) for b in _bands(pairs, band)]
    zero = df.sparkSession.createDataFrame(none, _STATE_DDL)  # pairs are listed even where no row is
    whole = tree_merged(states.unionByName(zero))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        left, right = np.triu_indices(p, 1)
        for frame in frames:
            for number, cell in zip(frame["band"], frame["state"], strict=True):
                _, _, _, xx, yy, xy, all_x, all_y = _of(cell)
                varied = (xx > ROUNDING * all_x) & (yy > ROUNDING * all_y)
                found = np.full(len(xx), np.nan)
                found[varied] = xy[varied] / (np.sqrt(xx[varied]) * np.sqrt(yy[varied]))
                at = slice(number * band, (number + 1) * band)
                yield pd.DataFrame({"i": left[at], "j": right[at], "correlation": found})

    out = whole.mapInPandas(run, "i int, j int, correlation double")
    return out.withColumn("correlation", F.nullif("correlation", F.lit(float("nan"))))
