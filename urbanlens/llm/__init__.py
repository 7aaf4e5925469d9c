"""Operators a training-data pipeline needs, as Spark jobs.

One module per operator; ``queries`` registers them for the driver's entry
file.  Nothing else in the library imports this package.  Task bodies are
pickled by value, so executors need no install of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
