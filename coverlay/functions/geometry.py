"""Column functions over WKB geometry. The first one used loads the kernel into the active session."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from coverlay.kernel import enable

#: Steps per quarter circle of a round buffer corner when none are asked for.
QUADRANTS = 8


def _call(name: str, *args) -> Column:
    spark = SparkSession.getActiveSession()
    if spark is not None:
        enable(spark)
    return F.call_function(name, *[F.col(a) if isinstance(a, str) else a for a in args])


def _dbl(v) -> Column:
    return v if isinstance(v, Column) else F.lit(float(v))


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add an expensive column so that later filters on it reuse its value.

    Catalyst pushes a filter below a projection by computing the projected expression again inside the filter.
    It does not do so below a generator, and a one-element ``explode`` is a generator.
    """
    return df.select(*[c for c in df.columns if c != name], F.explode(F.array(value)).alias(name))


# ---- constructors and codec ----


def box(x0, y0, x1, y1) -> Column:
    return _call("cv_box", *[_dbl(v) if not isinstance(v, str) else F.col(v) for v in (x0, y0, x1, y1)])


def point(x, y) -> Column:
    return _call("cv_point", x, y)


def encode(nested) -> Column:
    """Parts → rings → points array to a (multi)polygon."""
    return _call("cv_encode", nested)


def decode(geom) -> Column:
    """Geometry to a parts → rings → points array; lines and points are one-ring parts."""
    return _call("cv_decode", geom)


def multi(geom) -> Column:
    """Single parts as collections of one part; other geometries as they are. Plain byte functions, no kernel."""
    g = F.col(geom) if isinstance(geom, str) else geom
    head = F.hex(F.substring(g, 1, 5))
    out = g
    for single, many in ((1, 4), (2, 5), (3, 6)):
        is_one = head.isin(f"01{single:02X}000000", f"00000000{single:02X}")
        out = F.when(is_one, F.concat(F.unhex(F.lit(f"01{many:02X}00000001000000")), g)).otherwise(out)
    return out


def line(points) -> Column:
    return _call("cv_line", points)


def from_text(wkt) -> Column:
    return _call("cv_from_text", wkt)


def as_text(geom) -> Column:
    return _call("cv_as_text", geom)


def plain_wkb(geom) -> Column:
    """Little-endian WKB without an embedded SRID."""
    return _call("cv_plain", geom)


# ---- measures ----


def area(geom) -> Column:
    return _call("cv_area", geom)


def length(geom) -> Column:
    return _call("cv_length", geom)


def num_points(geom) -> Column:
    return _call("cv_npoints", geom)


def num_parts(geom) -> Column:
    return _call("cv_nparts", geom)


def is_valid(geom) -> Column:
    return _call("cv_is_valid", geom)


def is_empty(geom) -> Column:
    return _call("cv_is_empty", geom)


def bounds(geom) -> Column:
    return _call("cv_bounds", geom)


def centroid(geom) -> Column:
    return _call("cv_centroid", geom)


def interior_point(geom) -> Column:
    """A point that lies inside an area, as a struct ``(x, y)``."""
    return _call("cv_interior_point", geom)


#: WKB kind codes of the OGC simple-feature standard (fixed values).
KINDS = {
    1: "Point",
    2: "LineString",
    3: "Polygon",
    4: "MultiPoint",
    5: "MultiLineString",
    6: "MultiPolygon",
    7: "GeometryCollection",
}


def kind_code(geom) -> Column:
    """The WKB kind code, read from the header bytes of either byte order; no geometry is parsed."""
    g = F.col(geom) if isinstance(geom, str) else geom
    little = F.hex(F.substring(g, 1, 1)) == "01"
    head = F.when(little, F.substring(g, 2, 1)).otherwise(F.substring(g, 5, 1))
    return F.conv(F.hex(head), 16, 10).cast("int")


def kind(geom) -> Column:
    code = kind_code(geom)
    names = F.create_map(*[F.lit(v) for kv in KINDS.items() for v in kv])
    return names[code]


def ewkb_srid(geom) -> Column:
    """SRID embedded in little-endian extended WKB; NULL when the header carries none."""
    g = F.col(geom) if isinstance(geom, str) else geom
    flagged = F.conv(F.hex(F.substring(g, 5, 1)), 16, 10).cast("int").bitwiseAND(F.lit(0x20)) != 0
    srid = F.conv(_little_hex(g, 6, 4), 16, 10)
    return F.when(flagged, srid.cast("int"))


def _little_hex(g: Column, start: int, n: int) -> Column:
    return F.concat(*[F.hex(F.substring(g, start + i, 1)) for i in reversed(range(n))])


# ---- predicates ----


def intersects(a, b) -> Column:
    return _call("cv_intersects", a, b)


def within(a, b) -> Column:
    return _call("cv_within", a, b)


def contains(a, b) -> Column:
    return _call("cv_contains", a, b)


def touches(a, b) -> Column:
    return _call("cv_touches", a, b)


def meets_inside(a, b) -> Column:
    """Do two lines meet anywhere but in a vertex that is an end of both?"""
    return _call("cv_meets_inside", a, b)


# ---- overlay ----


def intersection(a, b) -> Column:
    return _call("cv_intersection", a, b)


def difference(a, b) -> Column:
    return _call("cv_difference", a, b)


def near_part(a, b) -> Column:
    """``a`` without what lies well away from ``b``. Overlay of the result with ``b`` is that of ``a`` with ``b``."""
    return _call("cv_near_part", a, b)


def union(a, b) -> Column:
    return _call("cv_union", a, b)


def polygonal_intersection(a, b) -> Column:
    """The areas two geometries share; NULL when they meet only in lines or points, or not at all."""
    return _call("cv_polygonal_intersection", a, b)


def frontage(a, b, tolerance: float = 0.0) -> Column:
    """Length of the outline of ``b`` that runs within ``tolerance`` of ``a``."""
    return _call("cv_frontage", a, b, _dbl(tolerance))


def within_distance(a, b, distance: float) -> Column:
    return _call("cv_within_distance", a, b, _dbl(distance))


def contact_points(a, b, tolerance: float = 0.0) -> Column:
    """Distinct vertices of ``a`` within ``tolerance`` of the outline of ``b``, as an array of ``(x, y)``."""
    return _call("cv_contact_points", a, b, _dbl(tolerance))


def nearest_point(on, to) -> Column:
    """The point of ``on`` that is closest to ``to``."""
    return _call("cv_nearest_point", on, to)


def split_polygon(poly, blades) -> Column:
    """Pieces of ``poly`` after cutting it by each line of ``blades`` in turn, as an array of polygons."""
    return _call("cv_split", poly, blades)


def polygonize(lines) -> Column:
    return _call("cv_polygonize", lines)


def faces_inside(lines, geom, share: float) -> Column:
    """Faces formed by an array of lines of which more than ``share`` lies inside ``geom``."""
    return _call("cv_faces_inside", lines, geom, _dbl(share))


# ---- transforms ----


def buffer(geom, distance, quadrant_segments: int = QUADRANTS) -> Column:
    return _call("cv_buffer", geom, _dbl(distance), F.lit(quadrant_segments))


def buffer_flat(geom, distance, quadrant_segments: int = QUADRANTS) -> Column:
    """Buffer without rounded ends, for pieces of a line made by :func:`chop`."""
    return _call("cv_buffer_flat", geom, _dbl(distance), F.lit(quadrant_segments))


def make_valid(geom) -> Column:
    return _call("cv_make_valid", geom)


def simplify(geom, tolerance) -> Column:
    """Douglas–Peucker; the tolerance is a distance."""
    return _call("cv_simplify_dp", geom, _dbl(tolerance))


def simplify_vw(geom, tolerance) -> Column:
    """Visvalingam–Whyatt; the tolerance is an area."""
    return _call("cv_simplify_vw", geom, _dbl(tolerance))


def simplify_topology(geom, tolerance) -> Column:
    return _call("cv_simplify_topology", geom, _dbl(tolerance))


def snap_to_grid(geom, size) -> Column:
    return _call("cv_snap_to_grid", geom, _dbl(size))


def boundary(geom) -> Column:
    return _call("cv_boundary", geom)


def fill_holes(geom) -> Column:
    return _call("cv_fill_holes", geom)


# ---- generators (arrays to explode) and aggregates ----


def parts(geom) -> Column:
    return _call("cv_parts", geom)


def polygons(geom) -> Column:
    """Only the areas among the parts."""
    return _call("cv_polygons", geom)


def chop(geom, max_segments: int = 64) -> Column:
    """Lines as runs of at most ``max_segments``; neighbouring runs overlap by one segment."""
    return _call("cv_chop", geom, F.lit(max_segments))


def subdivide(geom, max_points: int = 512) -> Column:
    return _call("cv_subdivide", geom, F.lit(max_points))


def cut_rows(rows, max_points: int, deepest: int) -> Column:
    """Pieces ``tile, nested`` of an array of nested polygons, as :func:`~coverlay.operators.tiles.subdivide` makes them."""
    return _call("cv_cut_rows", rows, F.lit(max_points), F.lit(deepest))


def cut_tile(edges, tile, left, low, right, high, max_points: int, deepest: int) -> Column:
    """Pieces ``tile, nested`` of one tile, given as an array of its edges ``ring, x1, y1, x2, y2``, its number and its box."""
    return _call("cv_cut_tile", edges, tile, left, low, right, high, F.lit(max_points), F.lit(deepest))


def union_agg(geom) -> Column:
    return _call("cv_union_agg", geom)


def collect_agg(geom) -> Column:
    """Parts of a group side by side, without dissolving them."""
    return _call("cv_collect_agg", geom)


def open_close(geom, first: float, second: float) -> Column:
    """Paired buffers: shrink then grow drops slivers; unequal amounts leave a net growth."""
    return buffer(buffer(geom, first), second)
