"""Curation of large item collections as Spark jobs: DataFrame in, DataFrame out."""

import sys

from pyspark import cloudpickle

# Functions sent to executors carry their own code, so that no node needs this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
