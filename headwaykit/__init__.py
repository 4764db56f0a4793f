"""headwaykit: transit-operations analytics on Spark, as composable DataFrame functions."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Workers get the functions they run by value: the package need not be installed on the cluster's machines.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
