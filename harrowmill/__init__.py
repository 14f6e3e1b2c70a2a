"""harrowmill: Spark-first operators for news and community page pipelines.

Every operator takes DataFrames and returns a DataFrame (or a Column).  Logical plans are
declared with built-in expressions; Arrow UDFs appear only where markup, byte lattices or
linear algebra have to be processed.
"""

__version__ = "0.1.0"

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

# Functions that run on executors are shipped by value, so that workers need no copy of this package.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])
