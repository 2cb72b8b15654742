"""Training-data pipeline operators: URL filters, nearest neighbours, source mixing, exact
top-k, sharding, substring removal, toxicity, quality, subword coding, near-duplicates.

Nothing else in the library imports this subpackage. ``queries`` registers the thin
contract queries ``op1_`` ... ``op10_`` over the operators.
"""

import sys

from pyspark import cloudpickle

# task functions travel to the executors by value, so no executor needs this package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])
