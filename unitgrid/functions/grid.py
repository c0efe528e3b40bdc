"""Grid maths: positions, pixel windows and cell areas."""

import math

from pyspark.sql import functions as F

from unitgrid.functions.numbers import col

# Grid constants and the WGS84 ellipsoid.
METRES_PER_DEGREE = 111319.49079327357
STEP_20M = 20 / METRES_PER_DEGREE
STEP_500M = 500 / METRES_PER_DEGREE
TILE = 4096
EDGE_EPS = 1e-9
OFFSET_TOLERANCE = 1e-3
SEMI_MAJOR = 6378137.0
FLATTENING = 1 / 298.257223563
E2 = FLATTENING * (2 - FLATTENING)
SEMI_MINOR = SEMI_MAJOR * (1 - FLATTENING)


def row_of(lat, top, step):
    return F.floor((F.lit(top) - col(lat)) / F.lit(step))


def col_of(lon, left, step):
    return F.floor((col(lon) - F.lit(left)) / F.lit(step))


def centre_lon(c, left, step):
    return F.lit(left) + (col(c) + 0.5) * F.lit(step)


def centre_lat(r, top, step):
    return F.lit(top) - (col(r) + 0.5) * F.lit(step)


def pixel_window(minx, miny, maxx, maxy, left=0.0, top=0.0, step=1.0):
    """Rows r0..r1 and columns c0..c1 (ends exclusive) covering a box; a degenerate box keeps one pixel."""
    minx, miny, maxx, maxy = (col(c) for c in (minx, miny, maxx, maxy))
    left, top, step = F.lit(left), F.lit(top), F.lit(step)
    r0 = F.floor((top - maxy) / step + EDGE_EPS)
    r1 = F.ceil((top - miny) / step - EDGE_EPS)
    c0 = F.floor((minx - left) / step + EDGE_EPS)
    c1 = F.ceil((maxx - left) / step - EDGE_EPS)
    flat = (r1 <= r0) | (c1 <= c0)
    return {"r0": r0, "r1": F.when(flat, r0 + 1).otherwise(r1),
            "c0": c0, "c1": F.when(flat, c0 + 1).otherwise(c1)}


def grid_offset(a, b, step):
    """Offset of two origins in pixels."""
    return (col(a) - col(b)) / col(step)


def is_whole(k):
    return F.abs(k - F.rint(k)) <= OFFSET_TOLERANCE


def projected_cell_area(step_x, step_y):
    return F.abs(col(step_x)) * F.abs(col(step_y))


def _band_term(lat):
    """Antiderivative of the ellipsoidal zone area per radian of longitude."""
    s = F.sin(F.radians(lat))
    e = math.sqrt(E2)
    return F.lit(SEMI_MINOR ** 2 / 2) * (s / (1 - F.lit(E2) * s * s)
                                         + F.log((1 + F.lit(e) * s) / (1 - F.lit(e) * s)) / F.lit(2 * e))


def cell_area(lat_top, lat_bottom, step_lon):
    """Area in square metres of a cell between two parallels, closed form on the ellipsoid."""
    return F.abs(_band_term(col(lat_top)) - _band_term(col(lat_bottom))) * F.radians(F.abs(col(step_lon)))


def row_cell_area(row, top, step):
    """Cell area of one raster row of a geographic grid."""
    return cell_area(F.lit(top) - col(row) * F.lit(step), F.lit(top) - (col(row) + 1) * F.lit(step), F.lit(step))


def ground_length(x1, y1, x2, y2):
    """Metres between two close lon/lat points, from the radii of curvature at the mid latitude."""
    mid = F.radians((col(y1) + col(y2)) / 2)
    w = 1 - F.lit(E2) * F.pow(F.sin(mid), 2)
    meridian = F.lit(SEMI_MAJOR * (1 - E2)) / F.pow(w, 1.5)
    normal = F.lit(SEMI_MAJOR) / F.sqrt(w)
    return F.hypot(F.radians(col(y2) - col(y1)) * meridian,
                   F.radians(col(x2) - col(x1)) * normal * F.cos(mid))


def planar_length(x1, y1, x2, y2):
    return F.hypot(col(x2) - col(x1), col(y2) - col(y1))
