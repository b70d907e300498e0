"""Operators for large text corpora, and the pipeline built from them.

Nothing else in the library imports this package. Its functions travel to the executors
by value, so a cluster needs only the public libraries they use.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
