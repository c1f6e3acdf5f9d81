"""Operators of a training-data pipeline.

Nothing outside this folder imports it. Python code of these operators runs
inside Spark tasks. It is sent along with each job instead of being imported
there, so executors need numpy, pyarrow and xxhash, but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
