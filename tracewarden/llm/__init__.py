"""Operations of training-data pipelines on Spark; nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# tasks carry this package's functions along, so executors need not have it installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])
