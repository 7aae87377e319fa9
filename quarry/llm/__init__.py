"""Operators for building large text-model training sets.

Nothing outside this package imports it. Each operator module documents its
method, its bounds and what it does with nulls, empty and very long texts,
ties, repeated rows, empty tables and clashing extra columns; ``plans.py``
registers one ``opN_`` query per operator over the test tables.

Functions of this package that run in Python workers are sent to them by value,
so that executors need numpy and Arrow but no installed copy of the library.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
