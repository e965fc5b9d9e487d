"""Operators for training-data pipelines: deduplication, mixing, scoring, filtering.

Functions that run inside tasks are shipped with the job, so that executors need
numpy and pyarrow but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
