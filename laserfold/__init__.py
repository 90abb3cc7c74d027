"""laserfold: airborne laser-scan point analytics as Spark DataFrame jobs."""

from laserfold.params import GridParams

__all__ = ["GridParams"]
