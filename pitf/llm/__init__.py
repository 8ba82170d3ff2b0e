"""Operators for preparing training text: mixing, packing, extraction, search, joins, scoring and classification.

Nothing outside this subpackage imports it. Functions that run in Spark's Python workers travel
by value, so executors need the third-party packages only.
"""
import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
