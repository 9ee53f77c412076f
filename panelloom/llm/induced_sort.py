"""Suffix sorting by induction, with queues that spill to disk.

Types, left-most S places and the two inductions are those of induced sorting; the S order comes from sorting the
pieces between S places, several symbols at a time, and the string of their names, recursively while names repeat.
Induction is a priority queue on
(symbol, arrival): it is kept as buckets of neighbouring symbols, each an append-only list of places that goes to
a temporary file when the queue outgrows its memory and is read back when its turn comes. Items leave a bucket in
runs that cannot induce anything smaller than what leaves with them, so each step works on whole arrays.

Only the waiting places spill; symbols, types, order and output stay in memory, so callers must bound the text.
"""

from __future__ import annotations

import os
import tempfile

import numpy as np

#: Buckets of a queue, the fewest places in one, and how many waiting places are looked at together at least.
_SHARES, _LEAST_SHARE, _STEP = 256, 4096, 1024


class Queue:
    """Places waiting by bucket, in order of arrival; at most ``memory`` of them in memory."""

    def __init__(self, n_buckets: int, memory: int, folder: str):
        self.waiting: list[list[np.ndarray]] = [[] for _ in range(n_buckets)]
        self.memory, self.folder, self.held = memory, folder, 0
        self.files: set[int] = set()
        self.name = f"{folder}/{id(self)}"

    def push(self, places: np.ndarray, buckets: np.ndarray) -> None:
        order = np.argsort(buckets, kind="stable")  # 16 bits: counted, not compared
        places, buckets = places[order], buckets[order]
        edges = [0, *(np.flatnonzero(buckets[1:] != buckets[:-1]) + 1).tolist(), len(places)]
        for b, lo, hi in zip(buckets[edges[:-1]].tolist(), edges, edges[1:], strict=False):
            self.waiting[b].append(places[lo:hi])
        self.held += len(places)
        if self.held > self.memory:
            for b, parts in enumerate(self.waiting):
                if parts:
                    with open(f"{self.name}.{b}", "ab") as f:
                        np.concatenate(parts).tofile(f)
                    self.files.add(b)
                    self.waiting[b] = []
            self.held = 0

    def pop(self, b: int) -> np.ndarray:
        parts, self.waiting[b] = self.waiting[b], []
        self.held -= sum(map(len, parts))
        if b in self.files:
            parts = [np.fromfile(f"{self.name}.{b}", np.int64), *parts]
            os.remove(f"{self.name}.{b}")
        return np.concatenate(parts) if parts else np.zeros(0, np.int64)


def _induce(symbols: np.ndarray, seeds: np.ndarray, take: np.ndarray, memory: int, folder: str) -> np.ndarray:
    """Order of the places in ``take`` that the sorted ``seeds`` induce.

    Works through places by symbol, those induced before seeds of the same symbol. A place that leaves induces
    the one before it if that is in ``take``, whose symbol is then not smaller.
    """
    counts = np.bincount(symbols)
    share = max(_LEAST_SHARE, len(symbols) // _SHARES)
    bucket = (np.cumsum(counts) - 1).clip(0) // share  # by symbol; neighbouring rare symbols share one
    bucket = np.unique(bucket, return_inverse=True)[1].astype(np.uint16)
    n_buckets = int(bucket[-1]) + 1
    ends = np.searchsorted(bucket, np.arange(n_buckets), side="right")  # the first symbol behind each bucket
    # What a place induces: the symbol before it, -1 where nothing.
    given = np.full(len(symbols), -1, np.int32)
    np.copyto(given[1:], symbols[:-1], where=take[:-1])
    queue, out = Queue(n_buckets, memory, folder), []
    edges = np.searchsorted(bucket[symbols[seeds]], np.arange(n_buckets + 1))
    none = np.zeros(0, np.int64)
    for b in range(n_buckets):
        queued, fresh = queue.pop(b), seeds[edges[b] : edges[b + 1]]
        waiting = np.concatenate((queued, fresh))
        keys = 2 * symbols[waiting].astype(np.int64)
        keys[len(queued) :] += 1
        order = np.argsort(keys, kind="stable")
        waiting, keys = waiting[order], keys[order]
        at, step = 0, _STEP
        near, near_keys = none, none  # induced into this very bucket, later than all that waited there
        while at < len(waiting) or len(near):
            # What may leave next: some of those that waited, and the near ones that come before the rest.
            upto = min(at + step, len(waiting))
            n_near = len(near) if upto == len(waiting) else int(np.searchsorted(near_keys, keys[upto], "left"))
            places, now = waiting[at:upto], keys[at:upto]
            if n_near:
                places = np.concatenate((places, near[:n_near]))
                now = np.concatenate((now, near_keys[:n_near]))
                order = np.argsort(now, kind="stable")
                places, now = places[order], now[order]
            target = given[places]
            inside = np.flatnonzero((target >= 0) & (target < ends[b]))
            cut = len(places)
            if len(inside):
                # Nothing leaves behind a larger key than one that is induced before it.
                least = np.minimum.accumulate(2 * target[inside].astype(np.int64))
                late = np.searchsorted(now, least, side="right")
                late = np.maximum(late, inside + 1)
                cut = int(late.min())
                inside = inside[inside < cut]
            if n_near:
                old = int(np.count_nonzero(order[:cut] < upto - at))
                at, near, near_keys = at + old, near[cut - old :], near_keys[cut - old :]
            else:
                at += cut
            places, now, target = places[:cut], now[:cut], target[:cut]
            out.append(places[(now & 1) == 0])
            far = np.flatnonzero(target >= ends[b])
            if len(far):
                queue.push(places[far] - 1, bucket[target[far]])
            if len(inside):
                near = np.concatenate((near, places[inside] - 1))
                near_keys = np.concatenate((near_keys, 2 * target[inside].astype(np.int64)))
                order = np.argsort(near_keys, kind="stable")
                near, near_keys = near[order], near_keys[order]
            step = max(_STEP, 2 * cut)
    return np.concatenate(out) if out else none


def _types(symbols: np.ndarray) -> np.ndarray:
    """Whether the suffix at each place is smaller than the next; the last place is the end mark."""
    change = np.flatnonzero(symbols[1:] != symbols[:-1])
    up = symbols[change] < symbols[change + 1]
    return np.append(np.repeat(up, np.diff(change, prepend=-1)), True)


def _sort_pieces(symbols: np.ndarray, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the pieces from each mark to the next, and their names in that order; equal ones share a name.

    As many symbols as go into 64 bits are compared at a time. A piece that begins another ends in a smaller
    suffix than the other's symbol can start, so it sorts behind: what follows an end counts as largest.
    """
    n = len(symbols)
    bits = int(symbols.max() + 1).bit_length()
    per, above = 64 // bits, np.uint64((1 << bits) - 1)
    size = np.append(np.diff(marks) + 1, 1)

    def words(which: np.ndarray, done: int) -> np.ndarray:
        word, place, left = np.zeros(len(which), np.uint64), marks[which] + done, size[which] - done
        for j in range(per):
            symbol = symbols[np.minimum(place + j, n - 1)].astype(np.uint64)
            symbol[left <= j] = above
            word = word << np.uint64(bits) | symbol
        return word

    word = words(np.arange(len(marks)), 0)
    order = np.argsort(word)
    word = word[order]
    new = np.append(True, word[1:] != word[:-1])
    done = per
    while True:
        # Equal so far, and not yet at their ends: place in ``order``, group, and next symbols.
        group = np.cumsum(new) - 1
        alone = new & np.append(new[1:], True)
        open_ = np.flatnonzero(~alone & (size[order] >= done))
        if not len(open_) or int(size[order[open_]].max()) <= done:
            return order, group
        word, own = words(order[open_], done), group[open_]
        inner = np.lexsort((word, own))
        order[open_] = order[open_][inner]
        word, own = word[inner], own[inner]
        new[open_] = np.append(True, (word[1:] != word[:-1]) | (own[1:] != own[:-1]))
        done += per


def _order(symbols: np.ndarray, memory: int, folder: str) -> np.ndarray:
    """Sorted suffixes of ``symbols``, whose last symbol is 0 and the only one."""
    n = len(symbols)
    if n < 3:
        return np.arange(n)[::-1].copy()
    small = _types(symbols)
    marks = np.flatnonzero(small[1:] & ~small[:-1]) + 1  # left-most S places, the end mark last
    order, names = _sort_pieces(symbols, marks)
    if names[-1] + 1 < len(marks):  # names repeat: sort the string of names
        by_place = np.empty(len(marks), np.int32)
        by_place[order] = names
        del names
        order = _order(by_place, memory, folder)
    larger = _induce(symbols, marks[order], ~small, memory, folder)
    smaller = _induce(symbols.max() - symbols, larger[::-1], small, memory, folder)[::-1]
    # Of each symbol the larger suffixes come first.
    found = np.concatenate(([n - 1], larger, smaller))
    rank = 2 * symbols[found]
    rank[1 + len(larger) :] += 1
    return found[np.argsort(rank, kind="stable")]


def suffix_order(text: np.ndarray, memory: int = 1 << 24) -> np.ndarray:
    """Starts of the suffixes of ``text`` in order; queues hold ``memory`` places at most.

    Symbols are whole numbers from 1, below 2 ** 30, as is the number of them.
    """
    with tempfile.TemporaryDirectory() as folder:
        return _order(np.append(text, 0).astype(np.int32), memory, folder)[1:]


def shared_prefix(text: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """For each suffix but the first, in order, whether it shares ``length`` symbols with the one before.

    Common prefixes are carried from place to place: if the symbols before a suffix and its neighbour agree, it
    shares one symbol less than the suffix a place earlier. Only the others are compared, four symbols (below
    2 ** 16) at a time, and no further than the places they carry to need.
    """
    n = len(text)
    if n < 2:
        return np.zeros(max(0, n - 1), bool)
    before = np.full(n, -1)
    before[order[1:]] = order[:-1]
    own = np.ones(n, bool)
    linked = before[1:] > 0
    own[1:][linked] = text[:-1][linked] != text[before[1:][linked] - 1]
    own[1:][before[1:] <= 0] = True
    first = np.flatnonzero(own)
    need = length + np.diff(np.append(first, n))
    padded = np.concatenate((text.astype(np.uint64), np.zeros(4, np.uint64)))
    words = sum(padded[i : i + n + 1] << np.uint64(16 * i) for i in range(4))
    common, active = np.zeros(len(first), np.int64), np.flatnonzero(before[first] >= 0)
    while len(active):
        at, other = first[active] + common[active], before[first[active]] + common[active]
        differ = words[at] ^ words[other]  # one reaches the zeros after the end before the other
        low = differ & (~differ + np.uint64(1))
        common[active] += np.where(differ == 0, 4, (np.bitwise_count(low - np.uint64(1)) // 16).astype(np.int64))
        active = active[(differ == 0) & (common[active] < need[active])]
    which = np.cumsum(own) - 1
    enough = common[which] - (np.arange(n) - first[which]) >= length
    return enough[order[1:]]
