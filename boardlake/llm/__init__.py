"""Operators for preparing large text corpora.

Nothing outside this package imports it.  The functions that run inside tasks
are shipped by value, so executors need numpy, pyarrow and the tokenizer
libraries, but no copy of this package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
