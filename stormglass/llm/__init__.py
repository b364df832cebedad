"""Operators for training data: archives, language, duplicates, mixing, tokens, scoring, chat, search."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors with their code: the driver may have found the
# package on a path that only it has.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
