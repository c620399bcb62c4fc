"""Parallel-corpus curation, prompt rendering, tokenization and translation scoring on Spark DataFrames."""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel with the plan, so executors need no installed copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
