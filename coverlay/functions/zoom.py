"""Map zoom level to thinning tolerance and coordinate precision, as columns."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the web-map tile scheme and of the thinning rule.
METRES_PER_PIXEL_0 = 156543.03390625
SPHERE_RADIUS = 6378137.0
SQUARE_PIXELS = 20

METRES_PER_DEGREE = 2.0 * math.pi * SPHERE_RADIUS / 360.0


def tolerance(zoom, units: str = "degrees") -> Column:
    """Area tolerance: twenty square pixels of the next zoom level, in square degrees or square metres."""
    z = F.col(zoom) if isinstance(zoom, str) else zoom
    side = F.lit(METRES_PER_PIXEL_0) / F.pow(F.lit(2.0), z.cast("double") + 1)
    if units == "degrees":
        side = side / F.lit(METRES_PER_DEGREE)
    elif units != "metres":
        raise ValueError(f"units must be 'degrees' or 'metres', not {units!r}")
    return side * side * F.lit(SQUARE_PIXELS)


def decimal_places(zoom) -> Column:
    """Decimals worth keeping: the leading zeros of a pixel's size in degrees to nine places, plus one."""
    z = F.col(zoom) if isinstance(zoom, str) else zoom
    size = F.lit(METRES_PER_PIXEL_0) / F.pow(F.lit(2.0), z.cast("double")) / F.lit(METRES_PER_DEGREE)
    digits = F.substring_index(F.format_string("%.9f", size), ".", -1)
    return (F.length(digits) - F.length(F.ltrim(digits, F.lit("0"))) + 1).cast("int")
