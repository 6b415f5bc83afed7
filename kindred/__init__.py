"""Market baskets and near-duplicate texts as Spark jobs."""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel with the job, so the workers need not have
# this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
