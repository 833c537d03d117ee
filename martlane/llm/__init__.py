"""Training-data operators: one module per operator, queries and SQL in ``queries``.

Nothing else in the library imports this package.  Its functions are pickled by value, so
executors need only numpy, pandas and the public wheels, not a copy of the repository.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
