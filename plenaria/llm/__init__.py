"""Operators of a pipeline that prepares training text, on the tables ``documents``, ``labels`` and ``embeddings``.

Nothing else in the library imports this subpackage. Its Python functions are sent to the executors by value, so
that the workers need not have the package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
