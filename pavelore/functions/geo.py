"""Distance and nested grid cells on the sphere.

A cell is (row, column). Rows are latitude bands of equal height. Every row is cut into a
whole number of columns, so columns wrap at the antimeridian, and their width in metres
is at least the cell size at every latitude. Level 0 has the given cell size; each further
level cuts a cell into 4 x 4 children. Coarser cells are whole-number quotients of the
finest ones, so a place never falls into a child of a cell it is not in.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..fixed import EARTH_RADIUS_M

MAX_LEVEL = 6
_BITS = 2  # a level cuts each side into 2**_BITS
_MARGIN = 1.0 + 1e-7


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in metres."""
    half = (
        F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2)
        + F.cos(F.radians(lat1))
        * F.cos(F.radians(lat2))
        * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    )
    return F.lit(2 * EARTH_RADIUS_M) * F.asin(F.sqrt(F.least(F.lit(1.0), half)))


def _vector(lat: Column, lon: Column) -> list[Column]:
    """A place as a vector of length one."""
    up, along = F.radians(lat), F.radians(lon)
    return [F.cos(up) * F.cos(along), F.cos(up) * F.sin(along), F.sin(up)]


def _cross(u: list[Column], v: list[Column]) -> list[Column]:
    return [u[1] * v[2] - u[2] * v[1], u[2] * v[0] - u[0] * v[2], u[0] * v[1] - u[1] * v[0]]


def _dot(u: list[Column], v: list[Column]) -> Column:
    return u[0] * v[0] + u[1] * v[1] + u[2] * v[2]


def segment_line(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """What :func:`line_distance_m` needs of a segment, computed once: its ends ``a`` and ``b``,
    the normal ``n`` of its plane and ``n``'s length, and the directions along it at both ends."""
    a, b = _vector(lat1, lon1), _vector(lat2, lon2)
    normal = _cross(a, [y - x for x, y in zip(a, b)])
    parts = {"a": a, "b": b, "n": normal, "on": _cross(normal, a), "back": _cross(b, normal)}
    fields = [column.alias(f"{name}{i}") for name, vector in parts.items() for i, column in enumerate(vector)]
    size = F.sqrt(_dot(normal, normal)).alias("size")
    ends = [c.alias(name) for c, name in zip((lat1, lon1, lat2, lon2), ("lat1", "lon1", "lat2", "lon2"))]
    return F.struct(*fields, size, *ends)


def line_distance_m(lat: Column, lon: Column, line: Column) -> Column:
    """Great-circle distance in metres of a place from a :func:`segment_line`.

    Beside the arc it is the distance from its great circle, else that from the nearer end.
    Differences from the first end keep it exact for very short segments. Two ends on
    opposite sides of the sphere have no shorter arc; they count as two places.
    """
    a, b, normal, on, back = ([line[f"{name}{i}"] for i in range(3)] for name in ("a", "b", "n", "on", "back"))
    p = _vector(lat, lon)
    away = [z - x for x, z in zip(a, p)]
    beside = (line["size"] > 1e-15) & (_dot(on, away) > 0) & (_dot(back, [z - y for y, z in zip(b, p)]) > 0)
    arc = F.lit(EARTH_RADIUS_M) * F.asin(F.least(F.lit(1.0), F.abs(_dot(normal, away)) / line["size"]))
    ends = F.least(*[haversine_m(lat, lon, line[f"lat{i}"], line[f"lon{i}"]) for i in (1, 2)])
    return F.when(beside, arc).otherwise(ends)


def segment_distance_m(
    lat: Column, lon: Column, lat1: Column, lon1: Column, lat2: Column, lon2: Column
) -> Column:
    """Great-circle distance in metres of a place from the shorter arc between two places."""
    return line_distance_m(lat, lon, segment_line(lat1, lon1, lat2, lon2))


ORDER_BITS = 16  # of latitude and of longitude in a Z-order cell


def _half_of_width(lat: float) -> int:
    return min((1 << ORDER_BITS) - 1, max(0, math.floor((lat + 90) * (1 << ORDER_BITS) / 180)))


def _part_of_turn(lon: float) -> int:
    return min((1 << ORDER_BITS) - 1, max(0, math.floor((lon + 180) * (1 << ORDER_BITS) / 360)))


def _spread_bits(value: Column) -> Column:
    """A 16-bit number with a zero after each bit."""
    for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
        value = value.bitwiseOR(F.shiftleft(value, shift)).bitwiseAND(F.lit(mask))
    return value


def z_cell(lat: Column, lon: Column) -> Column:
    """The Z-order number of a place: the bits of its latitude and longitude one after another.

    Places that are near each other mostly have near numbers, so tables sorted by it keep
    neighbours together. Null where a coordinate is.
    """
    size = 1 << ORDER_BITS

    def part(degrees: Column, whole: int) -> Column:
        return F.least(F.lit(size - 1), F.greatest(F.lit(0), F.floor((degrees + whole / 2) * size / whole))).cast("long")

    y, x = part(lat, 180), part(lon, 360)
    cell = _spread_bits(x).bitwiseOR(F.shiftleft(_spread_bits(y), 1))
    return F.when(lat.isNotNull() & lon.isNotNull(), cell)


def z_ranges(
    min_lat: float, min_lon: float, max_lat: float, max_lon: float, most: int = 32
) -> list[tuple[int, int]]:
    """At most ``most`` ranges of Z-order cells that hold all places of a rectangle.

    With ``min_lon`` above ``max_lon`` the rectangle crosses 180 degrees. Squares that the
    border crosses are cut into four, large ones first, while there are few enough.
    """
    if min_lat > max_lat:
        return []
    if min_lon > max_lon:
        west = z_ranges(min_lat, min_lon, max_lat, 180.0, max(1, most // 2))
        east = z_ranges(min_lat, -180.0, max_lat, max_lon, max(1, most // 2))
        return _joined(west + east)
    low_x, high_x = _part_of_turn(min_lon), _part_of_turn(max_lon)
    low_y, high_y = _half_of_width(min_lat), _half_of_width(max_lat)
    todo, done = [(0, 0, ORDER_BITS)], []  # squares: corner and size in bits
    while todo and len(todo) + len(done) + 3 <= most:
        x, y, bits = todo.pop(0)
        end = (1 << bits) - 1
        if low_x <= x and x + end <= high_x and low_y <= y and y + end <= high_y:
            done.append((x, y, bits))
            continue
        half = 1 << (bits - 1)
        for dy in (0, half):
            for dx in (0, half):
                u, v = x + dx, y + dy
                if u <= high_x and u + half > low_x and v <= high_y and v + half > low_y:
                    todo.append((u, v, bits - 1))
    spread = lambda v: sum((v >> i & 1) << 2 * i for i in range(ORDER_BITS))
    starts = [(spread(x) | spread(y) << 1, bits) for x, y, bits in todo + done]
    return _joined([(start, start + (1 << 2 * bits) - 1) for start, bits in starts])


def _joined(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted ranges, with neighbours as one."""
    found: list[tuple[int, int]] = []
    for low, high in sorted(ranges):
        if found and low <= found[-1][1] + 1:
            found[-1] = (found[-1][0], max(high, found[-1][1]))
        else:
            found.append((low, high))
    return found


def row_height(cell_m: float) -> float:
    """Height of a level-0 row in degrees."""
    return math.degrees(cell_m / EARTH_RADIUS_M) * _MARGIN


def _row(lat: Column, cell_m: float, level: int) -> Column:
    finest = F.floor(lat * F.lit((1 << _BITS * MAX_LEVEL) / row_height(cell_m))).cast("long")
    return F.shiftright(finest, _BITS * (MAX_LEVEL - level))


def columns_in_row(row: Column, cell_m: float) -> Column:
    """How many columns a level-0 row is cut into."""
    height = row_height(cell_m)
    edge = F.least(F.lit(90.0), F.greatest(F.abs(row), F.abs(row + 1)) * F.lit(height))
    fitting = F.floor(F.lit(360.0) * F.cos(F.radians(edge)) / F.lit(height))
    return F.greatest(F.lit(1).cast("long"), fitting.cast("long"))


def cell_at(lat: Column, lon: Column, cell_m: float, level: int = 0) -> Column:
    """The cell of a place at a level."""
    columns = columns_in_row(_row(lat, cell_m, 0), cell_m) * (1 << _BITS * MAX_LEVEL)
    finest = F.pmod(F.floor((lon + 180) * columns / 360).cast("long"), columns)
    column = F.shiftright(finest, _BITS * (MAX_LEVEL - level))
    return F.struct(_row(lat, cell_m, level).alias("row"), column.alias("column"))


def _rows_touched(lat: Column, reach: Column, cell_m: float) -> Column:
    """Array of the level-0 rows that a circle may touch; ``reach`` is its radius in degrees."""
    return F.sequence(_row(lat - reach, cell_m, 0), _row(lat + reach, cell_m, 0))


def _span(lat: Column, angle: Column) -> Column:
    """Largest longitude offset on a circle; the whole row where the circle holds a pole."""
    tangent = F.sin(angle) / F.cos(F.radians(lat))
    polar = (F.abs(lat) + F.degrees(angle) >= 90) | (tangent >= 1)
    return F.when(polar, F.lit(180.0)).otherwise(
        F.degrees(F.asin(F.least(F.lit(1.0), tangent))) * _MARGIN
    )


def _columns_touched(lon: Column, span: Column, n: Column) -> Column:
    """Array of the columns that a circle may touch in a row of ``n`` columns, not wrapped."""
    first = F.floor((lon - span + 180) * n / 360).cast("long")
    last = F.least(F.floor((lon + span + 180) * n / 360).cast("long"), first + n - 1)
    return F.sequence(first, last)


def cells_touched(lat: Column, lon: Column, radius_m: Column, cell_m: float) -> Column:
    """Array of the level-0 cells a circle may touch, each once."""
    angle = radius_m * F.lit(_MARGIN / EARTH_RADIUS_M)
    span = _span(lat, angle)

    def in_row(row: Column) -> Column:
        n = columns_in_row(row, cell_m)
        return F.transform(
            _columns_touched(lon, span, n),
            lambda c: F.struct(row.alias("row"), F.pmod(c, n).alias("column")),
        )

    return F.flatten(F.transform(_rows_touched(lat, F.degrees(angle), cell_m), in_row))


def explode_touched(df: DataFrame, lat: str, lon: str, radius_m: str, cell_m: float) -> DataFrame:
    """Each row once per ``cell`` that its circle may touch: the cells of :func:`cells_touched`.

    Rows and columns are exploded one after the other, so all that depends on the circle or
    its row of cells is computed once, in compiled code.
    """
    angle = F.col(radius_m) * F.lit(_MARGIN / EARTH_RADIUS_M)
    rows = _rows_touched(F.col(lat), F.degrees(angle), cell_m)
    df = df.select("*", _span(F.col(lat), angle).alias("_span"), F.explode(rows).alias("_row"))
    df = df.withColumn("_n", columns_in_row(F.col("_row"), cell_m))
    df = df.select("*", F.explode(_columns_touched(F.col(lon), F.col("_span"), F.col("_n"))).alias("_column"))
    cell = F.struct(F.col("_row").alias("row"), F.pmod("_column", "_n").alias("column"))
    return df.withColumn("cell", cell).drop("_span", "_row", "_n", "_column")


def place_along(
    share: Column, lat1: Column, lon1: Column, lat2: Column, lon2: Column, angle: Column
) -> tuple[Column, Column]:
    """The place at a share of the way along a segment of a known angle."""
    whole = F.sin(angle)
    tiny = whole < 1e-12
    first = F.when(tiny, 1 - share).otherwise(F.sin((1 - share) * angle) / whole)
    second = F.when(tiny, share).otherwise(F.sin(share * angle) / whole)
    x, y, z = (first * u + second * v for u, v in zip(_vector(lat1, lon1), _vector(lat2, lon2)))
    return F.degrees(F.atan2(z, F.sqrt(x * x + y * y))), F.degrees(F.atan2(y, x))


def cell_children(cell: Column) -> Column:
    """Array of the child cells of a cell."""
    cut = 1 << _BITS
    return F.array(*[
        F.struct(
            (cell["row"] * cut + i).alias("row"), (cell["column"] * cut + j).alias("column")
        )
        for i in range(cut) for j in range(cut)
    ])


def _cell_sides(cell: Column, cell_m: float, level: int) -> tuple[float, Column]:
    top = F.shiftright(cell["row"], _BITS * level)
    scale = 1 << _BITS * level
    return row_height(cell_m) / scale, F.lit(360.0) / (columns_in_row(top, cell_m) * scale)


def cell_centre(cell: Column, cell_m: float, level: int) -> tuple[Column, Column]:
    """Latitude and longitude of a cell's centre."""
    height, width = _cell_sides(cell, cell_m, level)
    return (cell["row"] + 0.5) * F.lit(height), (cell["column"] + 0.5) * width - 180


def cell_reach_m(cell: Column, cell_m: float, level: int) -> Column:
    """Upper bound of the distance from a cell's centre to any place in it."""
    height, width = _cell_sides(cell, cell_m, level)
    low, high = cell["row"] * F.lit(height), (cell["row"] + 1) * F.lit(height)
    flattest = F.when((low <= 0) & (high >= 0), F.lit(0.0)).otherwise(
        F.least(F.abs(low), F.abs(high))
    )
    half = F.sqrt(
        F.pow(F.lit(math.radians(height) / 2), 2)
        + F.pow(F.radians(width) / 2 * F.cos(F.radians(flattest)), 2)
    )
    return half * F.lit(EARTH_RADIUS_M * _MARGIN) + F.lit(1e-6)
