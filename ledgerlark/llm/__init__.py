"""Operators of a training-data pipeline over text corpora.

Functions that run in Python workers travel with the job, so executors need no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
