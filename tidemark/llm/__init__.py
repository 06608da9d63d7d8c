"""Operators and queries for large training-data corpora.

Functions that run on executors travel with the task by value, so executors need
numpy, pandas, pyarrow and xxhash but no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
