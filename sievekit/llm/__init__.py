"""Operators for building language-model training corpora.

Nothing outside this subpackage imports it. Each module holds one operator with
a general interface; ``queries`` holds the registered queries and their SQL.

Task functions travel by value, so executors need the Python libraries but not
this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
