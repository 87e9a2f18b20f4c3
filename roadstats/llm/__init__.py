"""Operators for preparing training text at scale (one module per operator).

Nothing else in the library imports this subpackage; it only borrows the session helpers.
``queries.py`` registers the contract queries, ``sql.py`` their DuckDB oracles.
"""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel by value: executors need the libraries, not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
