"""tickwarden: anomaly detection and series statistics for market trades, on Spark DataFrames."""

import sys

from pyspark import cloudpickle

from tickwarden.operators.detectors import DETECTORS, detect
from tickwarden.operators.scope import by_columns, rows, time_window, whole
from tickwarden.operators.series import Series

__all__ = ["DETECTORS", "Series", "by_columns", "detect", "rows", "time_window", "whole"]

# Functions sent to Python workers carry their code along, so executors need no copy of the
# package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
