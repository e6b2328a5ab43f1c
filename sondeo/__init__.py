"""Survey cleaning and analysis, and training-data preparation, on Spark."""

import sys

from pyspark import cloudpickle

# Functions travel to the executors by value, so that these need not have the package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
