"""Time-series features, training and forecasting over many series at once, on Spark."""

import sys

from pyspark import cloudpickle

from tidemark.session import build_session

# Functions that run in tasks travel by value: executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["build_session"]
