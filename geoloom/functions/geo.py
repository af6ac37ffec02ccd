"""Scalar geometry as Column functions: distances, grids, tiles, codecs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_M = 6371000.0
TILE_CELLS = 256
#: Nodata of raw rasters, and the range of stored metres.
RAW_NODATA, LOWEST, HIGHEST = -32768, -32767, 32767
#: Outline of the main island (lon, lat), and the box around the region.
ISLAND = (
    (132.00, 33.05), (132.30, 32.75), (133.10, 32.70), (134.20, 33.10), (134.85, 33.65),
    (134.70, 34.25), (134.20, 34.48), (133.35, 34.42), (132.65, 34.18), (132.15, 33.65),
)
REGION_LAT, REGION_LON = (32.0, 35.0), (131.0, 135.5)


def _half_chord(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    across = F.sin(F.radians(lat2 - lat1) / 2)
    along = F.sin(F.radians(lon2 - lon1) / 2)
    return across * across + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * along * along


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle metres (arctangent form, as routes are measured)."""
    a = _half_chord(lat1, lon1, lat2, lon2)
    return 2 * F.lit(EARTH_M) * F.atan2(F.sqrt(a), F.sqrt(1 - a))


def haversine_asin_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle metres (arcsine form, as duplicates are measured)."""
    return 2 * F.lit(EARTH_M) * F.asin(F.sqrt(_half_chord(lat1, lon1, lat2, lon2)))


def within(lat: Column, lon: Column, min_lat, max_lat, min_lon, max_lon) -> Column:
    """Point in bounds, all four sides included."""
    return lat.between(min_lat, max_lat) & lon.between(min_lon, max_lon)


def in_region(lat: Column, lon: Column) -> Column:
    return within(lat, lon, *REGION_LAT, *REGION_LON)


def in_polygon(lat: Column, lon: Column, ring: Sequence[tuple[float, float]] = ISLAND) -> Column:
    """Even-odd rule over a fixed ring: crossings of the edges by a ray to the east."""
    crossings = F.lit(0)
    for (x1, y1), (x2, y2) in zip(ring, [ring[-1], *ring[:-1]]):
        if y1 == y2:
            continue
        spans = (F.lit(y1) > lat) != (F.lit(y2) > lat)
        meets = lon < (lat - F.lit(y1)) * F.lit(x2 - x1) / F.lit(y2 - y1) + F.lit(x1)
        crossings = crossings + F.when(spans & meets, 1).otherwise(0)
    return crossings % 2 == 1


# Source rasters: row 0 is the northern one.


def raster_row(lat: Column, max_lat: Column, step: Column, height: Column) -> Column:
    return F.least(F.floor((max_lat - lat) / step), height - 1).cast("int")


def raster_col(lon: Column, min_lon: Column, step: Column, width: Column) -> Column:
    return F.least(F.floor((lon - min_lon) / step), width - 1).cast("int")


def cell_centre(row: Column, col: Column, max_lat: Column, min_lon: Column, lat_step: Column, lon_step: Column) -> tuple[Column, Column]:
    return max_lat - (row + F.lit(0.5)) * lat_step, min_lon + (col + F.lit(0.5)) * lon_step


def stored_row(i: Column, start_x: Column, start_y: Column, width: Column) -> Column:
    """Row of the i-th stored sample: the first row begins at start_x, later ones are whole."""
    rest = i - (width - start_x)
    return F.when(rest < 0, start_y).otherwise(start_y + 1 + F.floor(rest / width)).cast("int")


def stored_col(i: Column, start_x: Column, width: Column) -> Column:
    rest = i - (width - start_x)
    return F.when(rest < 0, start_x + i).otherwise(F.pmod(rest, width)).cast("int")


def stored_index(row: Column, col: Column, start_x: Column, start_y: Column, width: Column) -> Column:
    """Place of a cell in the stored samples, null before the start."""
    later = (width - start_x) + (row - start_y - 1) * width + col
    return F.when((row == start_y) & (col >= start_x), col - start_x).when(row > start_y, later).cast("long")


def grid_capacity(start_x: Column, start_y: Column, width: Column, height: Column) -> Column:
    return (width - start_x) + width * (height - 1 - start_y)


# Tiles of 256 by 256 cells.


def global_cell(value: Column, origin: Column, step: Column, south: bool) -> Column:
    """Cell number from the grid's north-west corner; may be negative outside."""
    return F.floor(((origin - value) if south else (value - origin)) / step).cast("long")


def tile_of(cell: Column) -> Column:
    return F.floor(cell / F.lit(float(TILE_CELLS))).cast("long")


def in_tile(cell: Column) -> Column:
    return F.pmod(cell, F.lit(TILE_CELLS)).cast("int")


def aligned_origin(value: Column, step: Column, north: bool) -> Column:
    """The multiple of step at or beyond value."""
    return (F.ceil(value / step) if north else F.floor(value / step)) * step


def placement_offset(value: Column, origin: Column, step: Column) -> Column:
    """Cells between an origin and a raster's edge, rounded."""
    return F.round((value - origin) / step).cast("long")


def quantized(metres: Column) -> Column:
    """Whole metres, halves away from zero, held in the stored range; null stays null."""
    whole = F.round(metres.cast("double"))
    return F.when(metres.isNull() | F.isnan(metres), None).otherwise(F.greatest(F.least(whole, F.lit(float(HIGHEST))), F.lit(float(LOWEST)))).cast("smallint")


def raw_metres(stored: Column) -> Column:
    """Stored metres with the raw raster's nodata value for null."""
    return F.coalesce(stored, F.lit(RAW_NODATA)).cast("smallint")


def metres_of_raw(raw: Column) -> Column:
    return F.when(raw != RAW_NODATA, raw).cast("float")


# Terrain-RGB, contours, web tiles.


def terrain_code(metres: Column) -> Column:
    return F.greatest(F.least(F.round((metres + 10000) * 10), F.lit(16777215.0)), F.lit(0.0)).cast("int")


def terrain_rgb(metres: Column) -> Column:
    code = terrain_code(metres)
    return F.struct(F.shiftright(code, 16).alias("r"), F.shiftright(code, 8).bitwiseAND(255).alias("g"), code.bitwiseAND(255).alias("b"))


def terrain_metres(r: Column, g: Column, b: Column) -> Column:
    return F.lit(-10000.0) + (r * 65536 + g * 256 + b) * F.lit(0.1)


def contour_below(metres: Column, interval: int = 20) -> Column:
    return (F.floor(metres / F.lit(float(interval))) * interval).cast("int")


def mercator_x(lon: Column, zoom: Column) -> Column:
    return F.floor((lon + 180) / 360 * F.pow(F.lit(2.0), zoom)).cast("int")


def mercator_y(lat: Column, zoom: Column) -> Column:
    r = F.radians(lat)
    return F.floor((1 - F.log(F.tan(r) + 1 / F.cos(r)) / F.lit(3.141592653589793)) / 2 * F.pow(F.lit(2.0), zoom)).cast("int")


def tms_row(y: Column, zoom: Column) -> Column:
    return (F.pow(F.lit(2.0), zoom) - 1 - y).cast("int")


def tiles_over(min_lat: Column, max_lat: Column, min_lon: Column, max_lon: Column, zoom: Column) -> Column:
    """All web tiles of a zoom level that bounds touch, as an array of structs x, y, tms_y."""
    xs = F.sequence(mercator_x(min_lon, zoom), mercator_x(max_lon, zoom))
    ys = F.sequence(mercator_y(max_lat, zoom), mercator_y(min_lat, zoom))  # rows count from the north
    one = lambda x: F.transform(ys, lambda y: F.struct(x.alias("x"), y.alias("y"), tms_row(y, zoom).alias("tms_y")))
    return F.flatten(F.transform(xs, one))


def archive_tile(tile_id: Column, zoom: int) -> Column:
    """x and y of a Hilbert-ordered tile id of a zoom level (ids count from zoom 0).

    Two bits of the id for each level turn and shift the curve; the state is folded, so the expression does not grow.
    """
    number = lambda x: x.cast("long")
    start = F.struct(number(tile_id - (4**zoom - 1) // 3).alias("rest"), number(F.lit(0)).alias("x"), number(F.lit(0)).alias("y"))

    def level(s: Column, bit: Column) -> Column:
        side = F.call_function("shiftleft", F.lit(1).cast("long"), bit.cast("int"))
        rx = F.shiftright(s.rest, 1).bitwiseAND(1)
        ry = s.rest.bitwiseXOR(rx).bitwiseAND(1)
        low = ry == 0
        mirrored = low & (rx == 1)
        x, y = F.when(mirrored, side - 1 - s.x).otherwise(s.x), F.when(mirrored, side - 1 - s.y).otherwise(s.y)
        return F.struct(F.shiftright(s.rest, 2).alias("rest"), (F.when(low, y).otherwise(x) + rx * side).alias("x"), (F.when(low, x).otherwise(y) + ry * side).alias("y"))

    if zoom == 0:
        return F.struct(start.x.alias("x"), start.y.alias("y"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(zoom - 1)), start, level, lambda s: F.struct(s.x.alias("x"), s.y.alias("y")))
