"""Display attributes of map cells as Columns: colour ramp, zoom, description."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Map zoom and wording per resolution.
DEFAULT_ZOOM = 5.0
ZOOM_OF_RESOLUTION = {6: 4.0, 7: 5.0, 8: 5.5, 9: 6.0}
DESCRIPTION_OF_RESOLUTION = {
    6: "~36 km² per hex - Continental/ocean-wide patterns",
    7: "~5 km² per hex - Regional shipping lanes",
    8: "~0.7 km² per hex - Port areas and coastal zones",
    9: "~0.1 km² per hex - Detailed vessel movements",
}


def _lookup(table: dict, key: Column) -> Column:
    pairs = [F.lit(part) for item in table.items() for part in item]
    return F.try_element_at(F.create_map(*pairs), key)


def zoom_of(resolution: Column) -> Column:
    return F.coalesce(_lookup(ZOOM_OF_RESOLUTION, resolution), F.lit(DEFAULT_ZOOM))


def description_of(resolution: Column) -> Column:
    return _lookup(DESCRIPTION_OF_RESOLUTION, resolution)


def min_max_scaled(value: Column, low: Column, high: Column) -> Column:
    """Position of ``value`` between the bounds; 0.0 when the bounds coincide."""
    return F.when(high > low, (value - low) / (high - low)).when(value.isNotNull(), F.lit(0.0))


def fire_green(scaled: Column) -> Column:
    """Green channel of the yellow (255) - orange (165) - red (0) ramp, truncated to an integer."""
    upper_half = F.lit(165.0) * (F.lit(1.0) - (scaled - F.lit(0.5)) * F.lit(2.0))
    lower_half = F.lit(255.0) - F.lit(90.0) * (scaled * F.lit(2.0))
    return F.when(scaled < 0.5, lower_half).otherwise(upper_half).cast("int")


def fire_rgba(scaled: Column) -> Column:
    """Opaque ``[r, g, b, a]`` array of the ramp."""
    return F.array(F.lit(255), fire_green(scaled), F.lit(0), F.lit(255))
