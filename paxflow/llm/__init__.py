"""Operators for large training-data pipelines, one module each.

Nothing else in the package imports this subpackage.
"""

import sys

from pyspark import cloudpickle

# Functions of this subpackage travel to Python workers with their code, so a
# cluster needs no copy of the package on its machines.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
