"""Operators for preparing language-model training data."""

import sys

from pyspark import cloudpickle

# Python workers may run where this repository is not on the path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
