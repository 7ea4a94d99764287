"""Weather classes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rideframe.spec import WEATHER_CLASSES


def weather_class(code: Column) -> Column:
    """Class name of a WMO weather code."""
    first, last, name = WEATHER_CLASSES[0]
    label = F.when(code.between(first, last), name)
    for first, last, name in WEATHER_CLASSES[1:]:
        label = label.when(code.between(first, last), name)
    return label.otherwise("unknown")
