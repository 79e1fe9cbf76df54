"""Geometry expressions: points, cells, distances, view boxes."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from layerspark.spec import geometry_metadata

EARTH_RADIUS_M = 6371008.8
# Fixed value: the geohash alphabet.
GEOHASH_ALPHABET = "0123456789bcdefghjkmnpqrstuvwxyz"


def point(lon: Column | str, lat: Column | str, z: Column | str | None = None) -> Column:
    """Point geometry, null when a coordinate is null."""
    parts = [_col(c) for c in ([lon, lat] if z is None else [lon, lat, z])]
    known = parts[0].isNotNull()
    for part in parts[1:]:
        known = known & part.isNotNull()
    return F.when(known, F.array(*[p.cast("double") for p in parts]))


def as_geometry(column: Column, name: str, kind: str) -> Column:
    return column.alias(name, metadata=geometry_metadata(kind))


def haversine_m(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Great-circle distance in metres between lon/lat in degrees."""
    half_lat = F.sin(F.radians(lat2 - lat1) / 2)
    half_lon = F.sin(F.radians(lon2 - lon1) / 2)
    a = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon * half_lon
    return F.lit(2 * EARTH_RADIUS_M) * F.asin(F.sqrt(F.least(a, F.lit(1.0))))


def radius_box(lon: float, lat: float, radius_m: float) -> tuple[float, float, float, float]:
    """West, south, east, north of a box that holds every point within the radius."""
    d_lat = math.degrees(radius_m / EARTH_RADIUS_M) * 1.000001
    south, north = lat - d_lat, lat + d_lat
    if north >= 90 or south <= -90:
        return -180.0, max(south, -90.0), 180.0, min(north, 90.0)
    reach = math.sin(math.radians(d_lat)) / math.cos(math.radians(lat))
    if reach >= 1:
        return -180.0, south, 180.0, north
    d_lon = math.degrees(math.asin(reach))
    return lon - d_lon, south, lon + d_lon, north


def view_box(
    lon: float, lat: float, zoom: float, aspect: float = 1.0
) -> tuple[float, float, float, float]:
    """Box shown at a zoom: 360 / 2**zoom degrees wide, ``aspect`` times that high."""
    width = 360.0 / 2.0**zoom
    height = width * aspect
    return lon - width / 2, max(lat - height / 2, -90.0), lon + width / 2, min(lat + height / 2, 90.0)


def in_box(lon: Column, lat: Column, box: tuple[float, float, float, float]) -> Column:
    """Inclusive box test of plain comparisons, so that it reaches the scan.

    A box over the antimeridian becomes two longitude ranges.
    """
    west, south, east, north = box
    lat_ok = lat.between(F.lit(south), F.lit(north))
    if east - west >= 360:
        return lat_ok & lon.between(F.lit(-180.0), F.lit(180.0))
    if west < -180:
        lon_ok = (lon >= F.lit(west + 360)) | (lon <= F.lit(east))
    elif east > 180:
        lon_ok = (lon >= F.lit(west)) | (lon <= F.lit(east - 360))
    else:
        lon_ok = lon.between(F.lit(west), F.lit(east))
    return lat_ok & lon_ok


def geohash_code(lon: Column | str, lat: Column | str, length: int) -> Column:
    """Geohash of 1 to 12 characters as a BIGINT (5 bits per character); null when a coordinate is null.

    Group and join on this code and turn it to text afterwards: a long key stays
    in the fast hash aggregate and is smaller in the shuffle.
    """
    if not 1 <= length <= 12:
        raise ValueError("a geohash has 1 to 12 characters")
    bits = 5 * length
    lon_bits, lat_bits = (bits + 1) // 2, bits // 2
    x = _step(_col(lon), -180.0, 360.0, lon_bits)
    y = _step(_col(lat), -90.0, 180.0, lat_bits)
    code = None
    for place in range(bits):
        source, width = (x, lon_bits) if place % 2 == 0 else (y, lat_bits)
        bit = F.shiftright(source, width - 1 - place // 2).bitwiseAND(F.lit(1).cast("long"))
        moved = F.shiftleft(bit, bits - 1 - place)
        code = moved if code is None else code.bitwiseOR(moved)
    return F.when(_col(lon).isNotNull() & _col(lat).isNotNull(), code)


def geohash_text(code: Column | str, length: int) -> Column:
    letters = F.lit(GEOHASH_ALPHABET)
    parts = []
    for i in range(length):
        five = F.shiftright(_col(code), 5 * (length - 1 - i)).bitwiseAND(F.lit(31).cast("long"))
        parts.append(F.substr(letters, five.cast("int") + 1, F.lit(1)))
    return F.concat(*parts)


def geohash(lon: Column | str, lat: Column | str, length: int) -> Column:
    return geohash_text(geohash_code(lon, lat, length), length)


def hilbert_index(lon: Column | str, lat: Column | str, bits: int = 16) -> Column:
    """Place of a point on a Hilbert curve over the lon/lat grid of 2**bits x 2**bits cells, as BIGINT.

    Cells next to each other on the curve are neighbours on the map, without the jumps
    of a geohash. Null when a coordinate is null; points outside the grid count
    to its border cells.
    """
    if not 1 <= bits <= 31:
        raise ValueError("a Hilbert index has 1 to 31 bits a side")
    zero, one = _long(0), _long(1)
    start = F.struct(
        zero.alias("code"),
        _step(_col(lon), -180.0, 360.0, bits).alias("x"),
        _step(_col(lat), -90.0, 180.0, bits).alias("y"),
        zero.alias("swapped"),
        zero.alias("flipped"),
    )

    def quarter(state: Column, place: Column) -> Column:
        """One quarter of the cell more, seen as the curve lies in it: mirrored, turned or as it is."""
        sides = [
            F.call_function("shiftright", state[c], place).bitwiseAND(one).bitwiseXOR(state["flipped"])
            for c in ("x", "y")
        ]
        turned = state["swapped"] == one
        across = F.when(turned, sides[1]).otherwise(sides[0])
        up = F.when(turned, sides[0]).otherwise(sides[1])
        low = one - up
        return F.struct(
            (state["code"] * 4 + (across * 3).bitwiseXOR(up)).alias("code"),
            state["x"].alias("x"),
            state["y"].alias("y"),
            state["swapped"].bitwiseXOR(low).alias("swapped"),
            state["flipped"].bitwiseXOR(low.bitwiseAND(across)).alias("flipped"),
        )

    places = F.sequence(F.lit(bits - 1), F.lit(0))
    index = F.aggregate(places, start, quarter, lambda state: state["code"])
    return F.when(_col(lon).isNotNull() & _col(lat).isNotNull(), index)


def h3_from_text(cell: Column | str) -> Column:
    """Hexadecimal cell id to BIGINT; H3 ids leave the top bit clear."""
    return F.conv(_col(cell), 16, 10).cast("long")


def h3_to_text(cell: Column | str) -> Column:
    return F.lower(F.hex(_col(cell)))


def h3_resolution(cell: Column | str) -> Column:
    return F.shiftright(_col(cell), 52).bitwiseAND(F.lit(15).cast("long")).cast("int")


def h3_parent(cell: Column | str, resolution: int) -> Column:
    """Parent cell: set the resolution field, fill the finer digits with 7."""
    if not 0 <= resolution <= 15:
        raise ValueError("an H3 resolution is 0 to 15")
    kept = _long(~(15 << 52))
    field = _long(resolution << 52)
    finer = _long((1 << (3 * (15 - resolution))) - 1)
    parent = _col(cell).bitwiseAND(kept).bitwiseOR(field).bitwiseOR(finer)
    return F.when(h3_resolution(cell) >= resolution, parent)


def square_ring(west: Column, south: Column, side: float) -> Column:
    """Closed ring of a square, counted from its south-west corner."""
    east, north = west + F.lit(side), south + F.lit(side)
    corners = [(west, south), (east, south), (east, north), (west, north), (west, south)]
    return F.array(*[F.array(x, y) for x, y in corners])


def _step(value: Column, start: float, span: float, bits: int) -> Column:
    top = 1 << bits
    raw = F.floor((value - F.lit(start)) / F.lit(span) * F.lit(float(top)))
    return F.least(F.greatest(raw, _long(0)), _long(top - 1))


def _long(value: int) -> Column:
    return F.lit(value).cast("long")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c
