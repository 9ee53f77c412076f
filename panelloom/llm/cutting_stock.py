"""Cutting stock by column generation on a length histogram; plain numpy, at most ``units`` rows.

Patterns are multisets of piece sizes that fit one sequence. A linear program over the patterns known so far
gives a price for each size; a knapsack dynamic program finds the pattern worth most at these prices; it
joins the program while it is worth more than the one sequence it costs.
"""

from __future__ import annotations

from collections import Counter

import numpy as np

Pattern = tuple[tuple[int, int], ...]  # (size, pieces of it), by falling size


def _knapsack(prices: np.ndarray, units: int) -> tuple[np.ndarray, np.ndarray]:
    """Unbounded knapsack: the highest total price that fits each room, and the size to take there first."""
    worth, taken = np.zeros(units + 1), np.zeros(units + 1, np.int64)
    for room in range(1, units + 1):
        gains = prices[1 : room + 1] + worth[room - 1 :: -1][:room]  # sizes 1..room leave room-1..0
        best = int(np.argmax(gains))
        if gains[best] > worth[room - 1] + 1e-12:
            worth[room], taken[room] = gains[best], best + 1
        else:
            worth[room] = worth[room - 1]
    return worth, taken


def _patterns(sizes: np.ndarray, taken: np.ndarray, units: int) -> np.ndarray:
    """For each size the best pattern that holds it, a row of counts by size."""
    place = np.full(units + 1, -1)
    place[sizes] = np.arange(len(sizes))
    rows, room = np.eye(len(sizes)), units - sizes
    while (room > 0).any():
        size = np.where(room > 0, taken[np.maximum(room, 0)], 0)
        hit = np.flatnonzero(size)
        rows[hit, place[size[hit]]] += 1
        room = room - np.maximum(size, 1)
    return np.unique(rows, axis=0)


def _first_columns(sizes: np.ndarray, wanted: np.ndarray, units: int) -> np.ndarray:
    """A first basis: fill sequences longest piece first, each pattern until it has used up some size.

    Pattern ``i`` holds size ``i`` and no size used up before, so the patterns are independent.
    """
    rest, columns = wanted.copy(), np.diag((units // sizes).astype(float))
    while (rest > 0).any():
        column, room = np.zeros(len(sizes)), units
        for i in np.flatnonzero(rest > 0)[::-1]:
            column[i] = min(room // sizes[i], max(1, rest[i])) // 1
            room -= column[i] * sizes[i]
            if room < sizes[0]:
                break
        held = np.flatnonzero(column)
        times = rest[held] / column[held]
        gone = held[np.argmin(times)]
        rest[held] -= times.min() * column[held]
        rest[gone] = 0
        rest[rest < 1e-6] = 0
        columns[gone] = column
    return columns


def solve(demand: np.ndarray, units: int, gap: float = 1e-4, most_rounds: int = 300) -> list[tuple[Counter, float]]:
    """Patterns and how often each is used in the linear optimum; ``demand[s]`` pieces have size ``s``.

    New patterns are priced between the current prices and the best feasible ones, which are proportional to
    size at first; that keeps prices from swinging. Stops when the bound that feasible prices give proves that
    at most the share ``gap`` of the sequences could be saved.
    """
    sizes = np.flatnonzero(demand[: units + 1])
    if not len(sizes):
        return []
    wanted = demand[sizes].astype(float)
    columns = _first_columns(sizes, wanted, units)
    inverse = np.linalg.inv(columns.T)
    used = np.maximum(inverse @ wanted, 0)
    best, weight = sizes / units, 0.7
    bound = wanted @ best
    for _ in range(most_rounds):
        now = np.maximum(inverse.sum(0), 0)
        if used.sum() <= bound * (1 + gap):
            break
        prices = np.zeros(units + 1)
        prices[sizes] = mixed = weight * best + (1 - weight) * now
        worth, taken = _knapsack(prices, units)
        feasible = mixed / max(1.0, worth[units])
        if wanted @ feasible > bound:
            best, bound = feasible, wanted @ feasible
        fresh = _patterns(sizes, taken, units)
        improved = False
        for _ in range(len(sizes)):
            values = fresh @ inverse.sum(0)
            enter = int(np.argmax(values))
            if values[enter] <= 1 + 1e-7:
                break
            improved = True
            step = inverse @ fresh[enter]
            up = np.flatnonzero(step > 1e-9)
            ratios = used[up] / step[up]
            leave, move = int(up[np.argmin(ratios)]), float(ratios.min())
            used = np.maximum(used - move * step, 0)
            used[leave] = move
            row = inverse[leave] / step[leave]
            inverse -= np.outer(step, row)
            inverse[leave] = row
            columns[leave] = fresh[enter]
        if not improved:
            if weight == 0:
                break
            weight = weight / 2 if weight > 0.05 else 0.0
    return [
        (Counter({int(s): int(n) for s, n in zip(sizes, c, strict=True) if n}), float(x))
        for c, x in zip(columns, used, strict=True)
        if x > 1e-9
    ]


def _first_fit(rest: np.ndarray, units: int) -> list[Counter]:
    """Sequences for the pieces that whole patterns leave over, longest first, each where it fits tightest."""
    bins: list[Counter] = []
    by_room: dict[int, list[int]] = {}
    for size in range(len(rest) - 1, 0, -1):
        for _ in range(int(rest[size])):
            room = min((r for r, held in by_room.items() if r >= size and held), default=None)
            if room is None:
                bins.append(Counter())
                at, room = len(bins) - 1, units
            else:
                at = by_room[room].pop()
            bins[at][size] += 1
            by_room.setdefault(room - size, []).append(at)
    return bins


def plan(demand: np.ndarray, units: int) -> list[tuple[Pattern, int]]:
    """Whole patterns with their number of sequences; together they hold every piece of the histogram."""
    rest = np.zeros(units + 1, np.int64)
    rest[: len(demand)] = demand
    out: list[tuple[Pattern, int]] = []
    for counts, times in solve(rest.copy(), units):
        whole = int(times + 1e-7)
        # never more than there are pieces: a pattern may cover a size beyond its demand
        whole = min([whole, *(int(rest[s]) // n for s, n in counts.items())])
        if whole:
            out.append((tuple(sorted(counts.items(), reverse=True)), whole))
            for s, n in counts.items():
                rest[s] -= n * whole
    last = Counter(tuple(sorted(b.items(), reverse=True)) for b in _first_fit(rest, units))
    return out + sorted(last.items(), reverse=True)
