"""Bins for a histogram of lengths by a configuration linear program.

A configuration says how many pieces of each size class a bin takes. The program

    least sum of x_c  so that every class is covered:  sum of x_c * a_cj >= n_j

has far too many configurations to list. Multiplicative weights solve it: a class
is worth its size times exp(-RATE * covered share), the configuration worth most
is found by a dynamic program over a knapsack of the bin's size (pricing), and it
is used until its scarcest class is covered by STEP more. The worth of all pieces
over that of the best configuration bounds the optimum from below.

Sizes are rounded up to classes of 1 / ``UNITS`` of a bin, and pieces below
``SMALL`` classes stay out of the program: they fill the room that the
others leave. The fractions are rounded down, then up as long as the pieces last,
and what is left goes by best fit into bins of its own.

Everything here works on the histogram (a count for each length up to the bin's
size), so time and memory do not grow with the number of pieces: bins with the
same content are one run with a count.
"""

from __future__ import annotations

import math
from bisect import bisect_left, bisect_right, insort

import numpy as np

UNITS, SMALL = 256, 16
STEP, RATE = 0.25, 4.0
#: Rounds of pricing at most; the rest is for the rounding.
ROUNDS = 1500
#: Shares of the program's solution that are rounded; the fewest bins win.
SHARES = (1.0, 0.9, 0.75, 0.5, 0.25, 0.0)

#: (bins, ((length, copies), ...)), lengths descending.
Run = tuple[int, tuple[tuple[int, int], ...]]


def best_configuration(worth: np.ndarray, most: np.ndarray, room: int) -> tuple[dict[int, int], float]:
    """The pieces of classes 1, 2, ... (``most`` of each at most) of the greatest
    total worth that fit ``room``, and that worth. Copies are taken in powers of
    two, so a class takes a few passes over the knapsack."""
    best = np.zeros(room + 1)
    passes = []
    for size in np.flatnonzero(most).tolist():
        left, copies = min(int(most[size]), room // size), 1
        while left > 0:
            copies = min(copies, left)
            left -= copies
            wide = copies * size
            with_it = best[: room + 1 - wide] + copies * worth[size]
            better = with_it > best[wide:]
            passes.append((size, copies, wide, better))
            best = np.concatenate((best[:wide], np.where(better, with_it, best[wide:])))
            copies *= 2
    at, found = room, {}
    for size, copies, wide, better in reversed(passes):
        if at >= wide and better[at - wide]:
            found[size] = found.get(size, 0) + copies
            at -= wide
    return found, float(best[room])


def solve(demand: np.ndarray, room: int) -> tuple[dict[tuple, float], float]:
    """Bins of each configuration that cover ``demand`` (a count for each class), as
    fractions, and a lower bound of the least sum of them."""
    classes = np.flatnonzero(demand)
    x: dict[tuple, float] = {}
    bound = 0.0
    if not len(classes):
        return x, bound
    covered = np.zeros(len(demand))
    need = np.where(demand > 0, demand, 1).astype(float)
    size = np.arange(len(demand), dtype=float)
    for _ in range(ROUNDS):
        least = covered[classes].min()
        if least >= 1:
            break
        worth = size * np.exp(-RATE * (covered - least))
        found, value = best_configuration(worth, demand, room)
        bound = max(bound, float((worth * demand).sum()) / value)
        step = STEP * min(need[j] / a for j, a in found.items())
        for j, a in found.items():
            covered[j] += step * a / need[j]
        key = tuple(sorted(found.items(), reverse=True))
        x[key] = x.get(key, 0.0) + step
    # What covers some class more than needed goes, the rarest bins first.
    for key, share in sorted(x.items(), key=lambda kv: (kv[1], kv[0])):
        spare = min([share, *((covered[j] - 1) * need[j] / a for j, a in key)])
        if spare > 0:
            x[key] = share - spare
            for j, a in key:
                covered[j] -= spare * a / need[j]
    return x, bound


class Stock:
    """Pieces that are left, by length, with the lengths in order."""

    def __init__(self, histogram: np.ndarray):
        self.left = histogram.astype(object)
        self.lengths = np.flatnonzero(histogram).tolist()

    def take(self, length: int, count: int) -> None:
        self.left[length] -= count
        if not self.left[length]:
            self.lengths.pop(bisect_left(self.lengths, length))

    def largest(self, at_most: int, used: dict[int, int], least: int = 1) -> int | None:
        """The largest length in least..at_most of which more is left than ``used``."""
        i = bisect_right(self.lengths, at_most) - 1
        while i >= 0 and self.lengths[i] >= least:
            if self.left[self.lengths[i]] > used.get(self.lengths[i], 0):
                return self.lengths[i]
            i -= 1
        return None


def _filled(stock: Stock, used: dict[int, int], room: int) -> None:
    """Best fit: the largest piece that fits the room left, again and again."""
    while room and (length := stock.largest(room, used)) is not None:
        copies = min(room // length, stock.left[length] - used.get(length, 0))
        used[length] = used.get(length, 0) + copies
        room -= copies * length


def _run(stock: Stock, used: dict[int, int], bins) -> Run:
    """Bins with the content ``used``, as many as the stock has pieces for."""
    bins = min([bins, *(stock.left[length] // a for length, a in used.items())])
    for length, a in used.items():
        stock.take(length, bins * a)
    return bins, tuple(sorted(used.items(), reverse=True))


def _rounded(stock: Stock, x: dict[tuple, float], unit: int, capacity: int):
    """Runs of the program's configurations, made of the largest pieces of their
    classes. The last and smallest piece is the one that fits best into the room
    that the true lengths of the others leave, and so is what follows it."""
    shares = sorted(x.items(), key=lambda kv: (-kv[1], kv[0]))
    for up in (False, True):
        for configuration, share in shares:
            bins = math.floor(share + 1e-9)
            bins = int(share - bins > 1e-9) if up else bins
            sizes = [j for j, a in configuration for _ in range(a)]
            while bins:
                used: dict[int, int] = {}
                room = capacity
                for j in sizes[: max(1, len(sizes) - 1)]:
                    length = stock.largest(min(j * unit, room), used, (j - 1) * unit + 1)
                    if length is None:
                        break
                    used[length] = used.get(length, 0) + 1
                    room -= length
                else:
                    _filled(stock, used, room)
                    run = _run(stock, used, bins)
                    bins -= run[0]
                    yield run
                    continue
                break  # a class has run out


def _best_fit(stock: Stock, capacity: int):
    while stock.lengths:
        used: dict[int, int] = {}
        _filled(stock, used, capacity)
        yield _run(stock, used, stock.left[max(used)])


def bins(histogram: np.ndarray, capacity: int) -> tuple[list[Run], dict]:
    """Runs of bins for ``histogram[length]`` pieces of each length from 1 to
    ``capacity``, and what the program said: its sum, its lower bound, the bins
    that came from it and all bins. Several shares of the solution are rounded, as
    a smaller one leaves best fit more to choose from, down to best fit alone."""
    unit = -(-capacity // UNITS)
    room = capacity // unit
    classes = -(-np.arange(capacity + 1) // unit)
    large = (classes > SMALL) & (classes <= room)
    demand = np.bincount(classes[large], weights=histogram[large], minlength=room + 1).astype(np.int64)
    x, bound = solve(demand, room)
    tried = []
    for share in SHARES:
        stock = Stock(histogram)
        from_program = list(_rounded(stock, {c: share * v for c, v in x.items()}, unit, capacity))
        runs = from_program + list(_best_fit(stock, capacity))
        said = {"program": float(sum(x.values())), "bound": bound, "share": share, "from_program": sum(b for b, _ in from_program)}
        tried.append((runs, said | {"bins": sum(b for b, _ in runs)}))
    return min(tried, key=lambda t: t[1]["bins"])
