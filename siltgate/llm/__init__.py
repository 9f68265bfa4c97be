"""Operations for training-data pipelines; nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# Functions of this package travel inside the jobs that use them: executors need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
