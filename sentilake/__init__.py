"""Community-sentiment analytics on Spark DataFrames."""

import sys

from pyspark import cloudpickle

# Functions sent to Python workers travel with the job, so a cluster needs no
# installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
