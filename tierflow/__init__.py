"""Medallion analytics for keyed JSON event streams, written on Spark DataFrames.

``sources``    scans, sinks and the Bronze / Silver / Gold table layout
``functions``  column-level helpers (record coding, money, time, kinds)
``operators``  pure ``DataFrame -> DataFrame`` operators
``streaming``  Structured Streaming jobs
``plans``      multi-step jobs built from the layers above
"""

from tierflow.contracts import CLICKS, FEEDS, ORDERS, Feed

__all__ = ["CLICKS", "FEEDS", "ORDERS", "Feed"]
