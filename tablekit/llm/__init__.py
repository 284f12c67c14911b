"""Operators for preparing training data: deduplication, search, tokens, quality, mixing.

Nothing else in the library imports this subpackage. Its task code travels to workers
that do not have the package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
