"""Shortest edit paths of a conversation by the auction algorithm with node prices; plain Python, integer costs.

A node ``(row, state)`` says how many rows are behind and what was last put out: nothing, a system turn, a user
turn, or an assistant turn. Arcs are edits: D and K and R move on by a row, I stays and puts out a turn. A label
names at most one arc of a node, so a string of labels is a path.

Prices never exceed the cost of an arc plus the price at its end. A path starts at an origin and is extended over
the arc that is tight; where none is, the price of the end node rises to the cheapest arc and the path contracts by
one. When it meets a node whose price has converged, prices along it are distances. Origins are taken from the last
row back, each row's prices starting at the least of the next row's, so a path has few steps and the work is linear
in the rows. All arcs of all cheapest paths are then tight, and :func:`trace` follows the least label.
"""

from __future__ import annotations

from collections.abc import Sequence

NONE = 1 << 60  # a price above any distance: no path
START, SYSTEM, USER, ASSISTANT = range(4)
#: A code of a row: its role (below) plus 4 times its fault.
OTHER_ROLE, SYSTEM_ROLE, USER_ROLE, ASSISTANT_ROLE = range(4)
SOUND, GONE, CUT = range(3)  # GONE rows are deleted; CUT ones cost more unless they are
DELETE_COST, REROLE_COST, INSERT_COST, CUT_COST = 2, 1, 5, 5
LABELS = "DIKR"  # in the order of ties
#: The turn that may be put in after each state, and the state after keeping a role.
NEXT = (USER, USER, ASSISTANT, USER)
KEEP = (
    (None, SYSTEM, USER, None),
    (None, None, USER, None),
    (None, None, None, ASSISTANT),
    (None, None, USER, None),
)
#: The states that may follow in any number of edits.
_REACH = ((0, 1, 2, 3), (1, 2, 3), (2, 3), (2, 3))
END = (0, NONE, NONE, 0)  # nothing at all, or an assistant turn last


def arcs_of(code: int, state: int) -> list[tuple[int, int, int, int]]:
    """``(label, rows ahead, next state, cost)`` of the edits before a row, by label."""
    role, fault = code & 3, code >> 2
    arcs = [(0, 1, state, DELETE_COST), (1, 0, NEXT[state], INSERT_COST)]
    if fault != GONE:
        more = CUT_COST if fault == CUT else 0
        if KEEP[state][role] is not None:
            arcs.append((2, 1, KEEP[state][role], more))
        arcs.append((3, 1, NEXT[state], REROLE_COST + more))
    return arcs


ARCS = tuple(tuple(tuple(arcs_of(code, state)) for state in range(4)) for code in range(12))


def prices(codes: bytes, leaving: Sequence[int] = END) -> list[int]:
    """The cheapest cost from each node ``4 * row + state`` on; ``leaving`` are the costs from the states at the end."""
    n = len(codes)
    price = [NONE] * (4 * n + 4)
    settled = bytearray(4 * n + 4)
    possible = [any(leaving[s] < NONE for s in _REACH[q]) for q in range(4)]
    floor = min(leaving)
    for row in range(n, -1, -1):
        base = 4 * row
        for state in range(4):
            if possible[state]:
                price[base + state] = floor
        # Where a path ends or goes on: per state the arcs as (next node, cost).
        if row < n:
            ways = [[(base + 4 * ahead + to, cost) for _, ahead, to, cost in ARCS[codes[row]][q]] for q in range(4)]
        else:
            ways = [[(base + NEXT[q], INSERT_COST)] for q in range(4)]
        for origin in range(base, base + 4):
            if not possible[origin - base]:
                settled[origin] = 1
                continue
            path = [origin]
            while not settled[path[-1]]:
                node = path[-1]
                state = node - base
                best, to = (leaving[state], -1) if row == n else (NONE, -1)
                for end, cost in ways[state]:
                    if price[end] + cost < best:
                        best, to = price[end] + cost, end
                if price[node] < best:
                    price[node] = best  # no arc was tight: the price rises
                    if best >= NONE:
                        price[node] = NONE
                        settled[node] = 1
                    if len(path) > 1:
                        path.pop()
                elif to < 0:
                    break  # the end itself is the tight way
                else:
                    path.append(to)
            for node in path:
                settled[node] = 1
        floor = min(price[base : base + 4])
    return price


def trace(codes: bytes, price: Sequence[int], state: int, leaving: Sequence[int] = END, last: bool = True) -> tuple[str, int]:
    """The least labels of the cheapest paths from ``state`` before the first row, and the state they end in.

    Unless these are the ``last`` rows, the path ends where they are behind it, before what is put in there.
    """
    labels, row, n = [], 0, len(codes)
    while row < n:
        now = price[4 * row + state]
        for label, ahead, to, cost in ARCS[codes[row]][state]:
            if price[4 * (row + ahead) + to] + cost == now:
                labels.append(LABELS[label])
                row, state = row + ahead, to
                break
        else:
            raise ValueError("no way on: the state cannot be repaired")
    while last and leaving[state] != price[4 * n + state]:
        labels.append("I")
        state = NEXT[state]
    return "".join(labels), state


def transfer(codes: bytes) -> list[int]:
    """Cheapest costs through the rows from each state (16 numbers, by entry then exit)."""
    columns = [prices(codes, [0 if q == out else NONE for q in range(4)])[:4] for out in range(4)]
    return [columns[out][into] for into in range(4) for out in range(4)]


def through(matrix: Sequence[int], leaving: Sequence[int]) -> list[int]:
    """Costs before some rows, from those after them."""
    return [min(NONE, *(matrix[4 * q + r] + leaving[r] for r in range(4))) for q in range(4)]
