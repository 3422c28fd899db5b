"""Fixed values and parameters."""

from __future__ import annotations

import math
from dataclasses import dataclass, replace

# Surface-temperature scaling of the sensor, packing of the composite, masks.
DN_SCALE, DN_OFFSET, KELVIN = 0.00341802, 149.0, 273.15
CLAMP_LOW, CLAMP_HIGH = -50.0, 80.0
PACK_SCALE, PACK_OFFSET, PACK_MAX = 0.01, -50.0, 65535
FLOOR_C, HOT_C = -49.98, 70.0
CLEAR_BITS = 62  # bits 1 to 5: dilated cloud, cirrus, cloud, shadow, snow
PLATFORMS = ("landsat-8", "landsat-9")
TILE_DEG, PX_PER_DEG, PX_PER_CELL = 5, 3600, 36
NORTH, SOUTH = 60, -60
MERCATOR_RADIUS = 6378137.0


def _celsius(dn: int) -> float:
    return dn * DN_SCALE + DN_OFFSET - KELVIN


#: The counts whose temperature is within the clamp, inclusive; one contiguous range.
DN_LOW = next(d for d in range(math.floor((CLAMP_LOW + KELVIN - DN_OFFSET) / DN_SCALE) - 2, 65536) if d > 0 and _celsius(d) >= CLAMP_LOW)
DN_HIGH = next(d for d in range(math.ceil((CLAMP_HIGH + KELVIN - DN_OFFSET) / DN_SCALE) + 2, 0, -1) if _celsius(d) <= CLAMP_HIGH)


@dataclass(frozen=True)
class Params:
    """Of normalisation: largest believable scene offset (C), fewest pixels behind it on the native and on a coarser grid, cloud limit (%), coarse factor."""

    cap: float = 15.0
    floor: int = 500
    coarse_floor: int = 200
    max_cloud: float = 100.0
    factor: int = 2

    def on_grid(self, factor: int) -> Params:
        """The same with the floor of the grid that offsets are estimated on; one replaces the other, they don't convert."""
        return self if factor == 1 else replace(self, floor=self.coarse_floor)
