"""Training-data operators over text corpora; nothing else in the library imports them.

Functions of this package travel to the executors by value, so these need no copy of the library.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
