"""Pressloom: a batch engine that turns landed news headlines into cross-outlet events, as Spark jobs."""

import sys

from pyspark import cloudpickle

# The few functions that run inside Python workers travel with the job, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
