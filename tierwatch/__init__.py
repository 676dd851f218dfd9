"""tierwatch: tiered message surveillance as composable Spark DataFrame operators."""

import sys

from pyspark import cloudpickle

# The few functions that run in Python workers travel with the plan, so that executors
# need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
