"""Geometry columns over (cx, cy, w, h) boxes in EMU."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
EMU = 914400
POS_TOL = 9144
TEXT_TOL = 45720
DAMAGE_MARGIN = 228600
ROT_TOL = 0.05


def _c(prefix: str, name: str) -> Column:
    return F.col(f"{prefix}{name}")


def boxes_meet(a: str, b: str) -> Column:
    """Boxes touch within the position tolerance; an unknown box meets anything."""
    test = F.lit(True)
    for centre, size in (("cx", "w"), ("cy", "h")):
        gap = F.abs(_c(a, centre) - _c(b, centre)) * 2
        test = test & (gap <= _c(a, size) + _c(b, size) + 2 * POS_TOL)
    return F.coalesce(test, F.lit(True))


def distance(a: str, b: str) -> Column:
    return F.coalesce(F.hypot(_c(a, "cx") - _c(b, "cx"), _c(a, "cy") - _c(b, "cy")), F.lit(0.0))


def inside(box: str, region: str, margin: int = DAMAGE_MARGIN) -> Column:
    """The centre of ``box`` lies in ``region`` grown by the margin."""
    ok = F.lit(True)
    for centre, size in (("cx", "w"), ("cy", "h")):
        low = _c(region, centre) - F.floor(_c(region, size) / 2)
        ok = ok & (_c(box, centre) >= low - margin) & (_c(box, centre) <= low + _c(region, size) + margin)
    return ok


def same_place(a: str, b: str) -> Column:
    return F.coalesce(
        (F.abs(_c(a, "cx") - _c(b, "cx")) <= F.greatest(F.lit(POS_TOL), F.floor(_c(b, "w") / 2)))
        & (F.abs(_c(a, "cy") - _c(b, "cy")) <= F.greatest(F.lit(POS_TOL), F.floor(_c(b, "h") / 2))), F.lit(False))


def covers(a: str, b: str) -> Column:
    return (same_place(a, b) & (_c(b, "w") > 0) & (_c(b, "h") > 0)
            & (_c(a, "w") * _c(a, "h") >= _c(b, "w") * _c(b, "h") * 0.5))
