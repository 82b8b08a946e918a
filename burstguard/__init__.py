"""Behaviour risk detection as Spark jobs: DataFrames in, DataFrames out."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the Python workers with the job, so the cluster needs no
# installed copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
