"""Operators that prepare training text: filters, near duplicates, tokens and archives.

Nothing outside this package imports it. Its functions travel to the executors by
value, so a worker needs the third-party libraries but no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
