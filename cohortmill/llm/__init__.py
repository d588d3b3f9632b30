"""Training-data operators: scoring, search, deduplication, mixing and token output."""

import sys

from pyspark import cloudpickle

# the functions that run in Python workers travel with the job, so executors need not have this package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])
