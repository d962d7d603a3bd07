"""Operators for preparing language-model training data. Nothing else in the library imports it.

Functions that run in Python workers are sent with the jobs, so executors need the libraries
they use (numpy, pyarrow, tokenizers) but not this one.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
