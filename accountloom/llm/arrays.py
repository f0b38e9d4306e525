"""Array expressions: a value computed once, hashes of runs of elements, minima of windows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def paired(left: Column, right: Column, gap: int, join: Callable[[Column, Column], Column]) -> Column:
    """join of each element of left and the element of right that lies gap places on.

    left has no fewer elements than right has from that place on.
    """

    def both(r: Column) -> Column:
        first = F.slice(left, 1, F.greatest(F.size(r) - gap, F.lit(0)))
        return F.transform(first, lambda x, i: join(x, F.get(r, i + gap)))

    return let(right, both)


def run_hashes(hashes: Column, widths: list[int], body: Callable[[dict[int, Column]], Column]) -> Column:
    """body({width: hash of each run of that many elements}), from the elements' hashes.

    Runs are put together from runs of half the length, so a width costs its binary
    digits and not its length.
    """
    most = max(widths)

    def combined(powers: dict[int, Column]) -> Column:
        found = {}
        for width in widths:
            done, run = 0, None
            for size in sorted(powers, reverse=True):
                if width & size:
                    run = powers[size] if run is None else paired(run, powers[size], done, F.xxhash64)
                    done += size
            found[width] = run
        return body(found)

    def grow(powers: dict[int, Column]) -> Column:
        size = max(powers)
        if 2 * size > most:
            return combined(powers)
        return let(paired(powers[size], powers[size], size, F.xxhash64), lambda x: grow({**powers, 2 * size: x}))

    return let(hashes, lambda h: grow({1: h}))


def window_minima(values: Column, width: int) -> Column:
    """The least element of each window of that many elements; none if there are fewer."""

    def grow(least: Column, size: int) -> Column:
        if 2 * size <= width:
            return let(paired(least, least, size, F.least), lambda x: grow(x, 2 * size))
        return paired(least, least, width - size, F.least) if size < width else least

    return let(values, lambda v: grow(v, 1))
