"""Operators for building training corpora. Nothing else in the library imports them."""

from pyspark import cloudpickle

import tallyhouse.llm as _package

# Tasks carry the operators' code along, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(_package)
