"""Operators of a training-data pipeline, one module each, and their queries.

The Python helpers travel with the jobs by value, so executors need no copy of the
package beside the libraries themselves.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
