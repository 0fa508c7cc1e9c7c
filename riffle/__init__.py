"""DataFrame operators for recommendation logs and question corpora."""

import sys

from pyspark import cloudpickle

# Functions that run in Python tasks travel with their code, so executors need no copy
# of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
