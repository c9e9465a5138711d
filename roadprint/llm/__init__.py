"""Training-data operators: one module per operator, queries in ``queries``.

Task functions are pickled by value, so executors need only PySpark and the
public packages that an operator names, not this package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
