"""passagework: filings and web pages to searchable passages, on Spark.

Every public function takes and returns DataFrames (or Columns); nothing here
runs a job on its own except where its docstring says so.
"""

import sys

from pyspark import cloudpickle

# Functions and classes travel to the Python workers with the plan, so executors
# need no installation of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__version__ = "0.1.0"
