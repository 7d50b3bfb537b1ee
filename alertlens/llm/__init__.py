"""Training-data operators: toxicity, near duplicates, personal data, mixing, packing, and
their kin.  Nothing outside this subpackage imports it.

Functions that run in Python workers are pickled by value, so executors need only numpy,
pyarrow and the libraries an operator names, not this package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
