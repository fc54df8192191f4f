"""Customer analytics on Spark: features, segments, density clusters, look-ups."""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel with the plan; executors need no install.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
