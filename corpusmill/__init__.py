"""Compressed JSON-lines dumps to clean Parquet, Parquet folders to one table, and profiles of the result."""

import sys

from pyspark import cloudpickle

# The few Python functions that run inside tasks travel with the job, so executors need no install.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
