"""Distance on a sphere."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyhouse.functions.arithmetic import ColumnOrName, as_column

# Earth radius in miles, and kilometres per mile.
EARTH_RADIUS_MILES = 3961
KILOMETRES_PER_MILE = 1.60934


def haversine_distance(
    lat1: ColumnOrName, lon1: ColumnOrName, lat2: ColumnOrName, lon2: ColumnOrName, unit: str = "mi"
) -> Column:
    """Great-circle distance between two points given in degrees."""
    scale = {"mi": 1.0, "km": KILOMETRES_PER_MILE}.get(unit)
    if scale is None:
        raise ValueError(f"unit must be 'mi' or 'km', got {unit!r}")
    lat1, lon1, lat2, lon2 = (F.radians(as_column(c)) for c in (lat1, lon1, lat2, lon2))

    def half_chord(a: Column, b: Column) -> Column:
        return F.pow(F.sin((b - a) / 2), 2)

    chord = half_chord(lat1, lat2) + F.cos(lat1) * F.cos(lat2) * half_chord(lon1, lon2)
    # rounding can push opposite points just past 1, where asin is not defined
    return 2 * EARTH_RADIUS_MILES * F.asin(F.sqrt(F.least(chord, F.lit(1.0)))) * scale
