"""Trip-record analytics as lazy Spark DataFrame expressions."""

from rideframe.spec import BinSpec, ZoneSpec

__all__ = ["BinSpec", "ZoneSpec"]
