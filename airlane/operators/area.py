"""Positions along a space-filling curve: a cell number per row, a box as a few ranges of cells.

Latitude and longitude are cut into 2**16 steps each, whose bits alternate in the cell number, so rows
near each other mostly have near numbers. Rows stored in this order, see `sources.area`, let a box skip
row groups by the ranges; the exact comparison with the borders follows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Steps per axis are 2**BITS; a box is told as at most this many ranges.
BITS, MOST_RANGES = 16, 32
#: Name of the cell column in stored rows.
CELL = "position_cell"

Box = tuple[float, float, float, float]
_SOUTH, _WEST, _HEIGHT, _WIDTH = -90.0, -180.0, 180.0, 360.0
#: Shifts and masks that spread 16 bits over the even places of 32.
_SPREAD = [(8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)]


def _step_of(value: float, low: float, span: float) -> int:
    return int(min(max((value - low) / span * 2.0**BITS, 0.0), 2.0**BITS - 1))


def _step(value: Column, low: float, span: float) -> Column:
    """The same on a column: the same double operations, so borders fall alike. NaN is in the last step."""
    at = (value - F.lit(low)) / F.lit(span) * F.lit(2.0**BITS)
    return F.least(F.greatest(at, F.lit(0.0)), F.lit(2.0**BITS - 1)).cast("bigint")


def _spread(x: Column) -> Column:
    for shift, mask in _SPREAD:
        x = x.bitwiseOR(F.shiftleft(x, shift)).bitwiseAND(F.lit(mask).cast("bigint"))
    return x


def cell(latitude="latitude", longitude="longitude") -> Column:
    """The cell number of a position; null where a coordinate is null. Values outside the globe count as its edge."""
    north, east = F.col(latitude), F.col(longitude)
    number = F.shiftleft(_spread(_step(north, _SOUTH, _HEIGHT)), 1).bitwiseOR(_spread(_step(east, _WEST, _WIDTH)))
    return F.when(north.isNotNull() & east.isNotNull(), number)


def parts(box: Box) -> list[Box]:
    """The box as boxes that do not cross the date line; west beyond east means that it does."""
    south, west, north, east = box
    if south > north:
        return []
    return [box] if west <= east else [(south, west, north, 180.0), (south, -180.0, north, east)]


def ranges(box: Box, most: int = MOST_RANGES) -> list[tuple[int, int]]:
    """At most ``most`` (two at least, one per part) ascending cell ranges, ends included, that cover the box."""
    flat = [(_step_of(s, _SOUTH, _HEIGHT), _step_of(w, _WEST, _WIDTH), _step_of(n, _SOUTH, _HEIGHT), _step_of(e, _WEST, _WIDTH))
            for s, w, n, e in parts(box)]
    found = [(0, 4**BITS - 1)] if flat else []
    squares = [(0, 0, 0)] if flat else []  # first row, first column, first cell
    whole: list[tuple[int, int]] = []
    for level in range(1, BITS + 1):
        side = 1 << (BITS - level)
        cut = []
        for row, column, first in squares:
            for k in range(4):
                r, c, at = row + (k >> 1) * side, column + (k & 1) * side, first + k * side * side
                met = [b for b in flat if b[0] < r + side and b[2] >= r and b[1] < c + side and b[3] >= c]
                if any(b[0] <= r and b[2] >= r + side - 1 and b[1] <= c and b[3] >= c + side - 1 for b in met):
                    whole.append((at, at + side * side - 1))
                elif met:
                    cut.append((r, c, at))
        told = _joined(whole + [(at, at + side * side - 1) for _, _, at in cut])
        if len(told) > most:
            break
        found, squares = told, cut
    return found


def _joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for first, last in sorted(spans):
        if out and first <= out[-1][1] + 1:
            out[-1] = out[-1][0], max(out[-1][1], last)
        else:
            out.append((first, last))
    return out


def in_box(rows: DataFrame, box: Box, most: int = MOST_RANGES) -> DataFrame:
    """Rows inside south, west, north, east, borders included; a box with west beyond east crosses the date line.

    Rows with a cell column, as `sources.area` stores them, are cut by cell ranges first, which reaches
    the file scan. Rows without a position are outside every box; an upside-down box is empty.
    """
    inside = [F.col("latitude").between(s, n) & F.col("longitude").between(w, e) for s, w, n, e in parts(box)]
    exact = reduce(Column.__or__, inside, F.lit(False))
    if CELL in rows.columns and inside:
        near = reduce(Column.__or__, [F.col(CELL).between(a, b) for a, b in ranges(box, most)])
        return rows.where(near).where(exact)
    return rows.where(exact)
