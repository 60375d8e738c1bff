"""Operations of a training-data pipeline.

Functions that run in Python workers travel by value, so executors need only
numpy, pyarrow and the libraries an operator names, not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
