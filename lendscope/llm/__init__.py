"""Training-data pipeline operators.

Functions that run inside tasks travel by value, so workers need only the public
libraries, not this package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
