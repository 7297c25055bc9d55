"""Corpus operators for training-data pipelines; nothing else in the library imports this folder."""

import sys

from pyspark import cloudpickle

# Workers unpickle the functions themselves, so executors need no copy of the package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
