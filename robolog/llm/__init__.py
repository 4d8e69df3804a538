"""Operators for preparing training corpora: deduplication, classification, tokenisation, mixing, formatting.

Functions that run inside Spark's Python workers are sent to them by value, so workers need
numpy, pyarrow and the tokenizer libraries but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
