"""Operators for preparing language-model training data.

The code of this subpackage travels with the jobs that use it; executors need
the installed libraries only.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
