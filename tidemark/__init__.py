"""tidemark: entity-signal analytics and training-data preparation on PySpark.

Everything is a function from DataFrame to DataFrame with explicit parameters.
The subpackage ``llm`` is optional: nothing else in the library imports it.
"""

__version__ = "0.1.0"

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

# Functions sent to Python workers travel by value: executors need no copy of the package.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])
