"""Rounding, shares and binning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from voxmill.functions.binding import bind


def rounded(value: Column, places: int) -> Column:
    """Half-even rounding of the exact binary value: 2.675 is a little less, so it gives 2.67.

    The scaled value and its rounding error (by splitting both factors) tell on which side of a
    tie the value lies; only an exact tie goes to the even neighbour.
    """
    scale = float(10**places)

    def decide(x: Column) -> Column:
        scaled, split = x * scale, float(2**27 + 1)
        high = x * split - (x * split - x)
        scale_high = scale * split - (scale * split - scale)
        low, scale_low = x - high, scale - scale_high
        error = ((high * scale_high - scaled) + high * scale_low + low * scale_high) + low * scale_low
        floor = F.floor(scaled).cast("double")
        side = (scaled - floor - 0.5) + error
        even = floor + F.pmod(floor, F.lit(2.0))
        up = F.when(side > 0, floor + 1).when(side < 0, floor).otherwise(even)
        return F.when(F.abs(scaled) < 2.0**52, up / scale).otherwise(x)

    return bind(value.cast("double"), decide)


def percent(part: Column, whole: Column, places: int = 1) -> Column:
    """Share in percent, 0.0 for an empty group."""
    return F.when(whole > 0, rounded(part / whole * 100.0, places)).otherwise(F.lit(0.0))


def binned(value: Column, upper_bounds, labels) -> Column:
    """Right-closed bins: the first bound not below the value decides; the last bin is open."""
    result = F.when(value <= upper_bounds[0], labels[0])
    for bound, label in zip(upper_bounds[1:], labels[1:]):
        result = result.when(value <= bound, label)
    return result.when(value.isNotNull(), labels[len(upper_bounds)])


def text_bar(percentage: Column, per_mark: int, mark: str = "█") -> Column:
    return F.repeat(F.lit(mark), F.floor(percentage / per_mark).cast("int"))
