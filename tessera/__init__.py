"""Analytics over tables of captured pages, logs, documents and labels, as PySpark DataFrame operators."""

import sys

from pyspark import cloudpickle

#: Functions that run on executors travel by value, so executors need no installed copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
