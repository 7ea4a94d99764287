"""Trips as a stream.

The analyses are batch jobs and stay so. Their filters, derived columns and bins are
row-local expressions, so they take a streaming DataFrame as it is; this package only adds
the source.
"""

from rideframe.streaming.trips import stream_trips

__all__ = ["stream_trips"]
