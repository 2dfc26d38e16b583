"""Analytics jobs for Spark: rollups, features, retrieval, experiment statistics, model comparison."""

import sys

from pyspark import cloudpickle

# The package may be importable on the driver only: ship its Python helpers with the tasks that use them.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
