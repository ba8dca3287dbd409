"""Chat-data preparation as Spark jobs: convert, validate, deduplicate, split."""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel with the job, so that executors need not have the
# package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
