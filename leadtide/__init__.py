"""Lead targets, time-series features, forecasts and their evaluation as Spark jobs."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors as they are, so nothing need be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
