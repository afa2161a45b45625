"""Cells along a curve: keys by which a box of coordinates is a few ranges."""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from placeload.functions.geo import LEVEL_STEP, ROW_STEP, grid_level

# Spreading 32 bits over 64: how far to shift, and what stays.
SPREAD = tuple((2**n, sum((2 ** 2**n - 1) << at for at in range(0, 64, 2 ** (n + 1)))) for n in (4, 3, 2, 1, 0))

# How far, in cells, a box is widened before its edge cells are taken: more than rounding can move a place.
SLACK = 1e-6

# A square of cells: the power of two that is its side, and its row and column among such squares.
Square = tuple[int, int, int]
# First and last row, first and last column.
Window = tuple[int, int, int, int]


def curve_key(cell: Column | str) -> Column:
    """Key (long) of a ``geo_cell`` in the order of a Z-shaped curve.

    The bits of the cell's row and column take turns, so cells that are near each other mostly
    have near keys, and a square of cells whose side is a power of two is one range. The level stays on
    top. NULL for NULL. Keys of one cell are equal and those of different cells differ.
    """
    cell = F.col(cell) if isinstance(cell, str) else cell
    row = F.shiftright(cell, 29).bitwiseAND(F.lit(ROW_STEP - 1))
    column = cell.bitwiseAND(F.lit(ROW_STEP - 1))
    level = F.shiftright(cell, 58) * F.lit(LEVEL_STEP)
    return level + F.shiftleft(_spread(row), 1) + _spread(column)


def _spread(bits: Column) -> Column:
    return reduce(lambda x, step: x.bitwiseOR(F.shiftleft(x, step[0])).bitwiseAND(F.lit(step[1])), SPREAD, bits)


@dataclass(frozen=True)
class Box:
    """Coordinates in degrees, edges included; a box whose west is above its east crosses the 180th meridian."""

    south: float
    west: float
    north: float
    east: float

    def __post_init__(self) -> None:
        if not -90 <= self.south <= self.north <= 90:
            raise ValueError(f"latitudes must be -90 <= south <= north <= 90, got {self.south}, {self.north}")
        if not (-180 <= self.west <= 180 and -180 <= self.east <= 180):
            raise ValueError(f"longitudes must be -180 to 180, got {self.west}, {self.east}")

    def spans(self) -> list[tuple[float, float]]:
        """The longitudes as one or two spans of degrees east of the 180th meridian."""
        west, east = (self.west + 180) % 360.0, (self.east + 180) % 360.0
        if (self.west, self.east) == (-180, 180):
            return [(0.0, 360.0)]
        return [(west, east)] if west <= east else [(west, 360.0), (0.0, east)]

    def holds(self, latitude: Column | str, longitude: Column | str) -> Column:
        """Whether a coordinate lies in the box; the longitude wraps. NULL where a coordinate is NULL."""
        lat = (F.col(latitude) if isinstance(latitude, str) else latitude).cast("double")
        lon = (F.col(longitude) if isinstance(longitude, str) else longitude).cast("double")
        turned = F.pmod(lon + 180, F.lit(360.0))
        around = reduce(Column.__or__, [turned.between(low, high) for low, high in self.spans()])
        return lat.between(self.south, self.north) & around


def curve_ranges(box: Box, resolution: int, most: int = 32) -> list[tuple[int, int]]:
    """Ranges of ``curve_key``, ends included, that together hold every cell the box touches.

    Squares of cells are split in four, those within the box kept whole and those beyond it left out, as
    long as no more than ``most`` are left; then the ones at the edge are taken whole. So the ranges
    may hold more than the box: ``Box.holds`` decides. Their number does not depend on the resolution.
    """
    if most < 4:
        raise ValueError(f"most must be at least 4, got {most}")
    level = grid_level(resolution)
    windows = _windows(box, level)
    whole: list[Square] = []
    edge = [square for square in ((level, 0, 0), (level, 0, 1)) if _touches(square, windows)]
    while edge:
        inside = [square for square in edge if _within(square, windows)]
        split = [square for square in edge if square not in inside]
        parts = [part for square in split for part in _quarters(square) if _touches(part, windows)]
        whole += inside
        if len(whole) + len(parts) > most:
            whole += split
            break
        edge = parts
    ranges: list[tuple[int, int]] = []
    for low, high in sorted(_range(square, level) for square in whole):
        if ranges and ranges[-1][1] + 1 == low:
            ranges[-1] = (ranges[-1][0], high)
        else:
            ranges.append((low, high))
    return ranges


def _windows(box: Box, level: int) -> list[Window]:
    """First and last row and column of the cells the box touches, per span of longitudes."""
    rows, columns = 2**level, 2 ** (level + 1)
    south, north = ((math.sin(math.radians(d)) + 1) / 2 * rows for d in (box.south, box.north))
    bottom, top = max(0, math.floor(south - SLACK)), min(rows - 1, math.floor(north + SLACK))
    return [
        (bottom, top, max(0, math.floor(west / 360 * columns - SLACK)), min(columns - 1, math.floor(east / 360 * columns + SLACK)))
        for west, east in box.spans()
    ]


def _quarters(square: Square) -> list[Square]:
    side, row, column = square
    return [(side - 1, 2 * row + r, 2 * column + c) for r in (0, 1) for c in (0, 1)]


def _extent(square: Square) -> Window:
    side, row, column = square
    return row << side, ((row + 1) << side) - 1, column << side, ((column + 1) << side) - 1


def _touches(square: Square, windows: list[Window]) -> bool:
    bottom, top, left, right = _extent(square)
    return any(w[0] <= top and bottom <= w[1] and w[2] <= right and left <= w[3] for w in windows)


def _within(square: Square, windows: list[Window]) -> bool:
    bottom, top, left, right = _extent(square)
    return any(w[0] <= bottom and top <= w[1] and w[2] <= left and right <= w[3] for w in windows)


def _range(square: Square, level: int) -> tuple[int, int]:
    side, row, column = square
    code = sum(((row >> n & 1) << 2 * n + 1) + ((column >> n & 1) << 2 * n) for n in range(level + 1))
    low = level * LEVEL_STEP + (code << 2 * side)
    return low, low + (1 << 2 * side) - 1
