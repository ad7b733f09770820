"""Training-data operators: cleaning, deduplication, decontamination and packing of text corpora.

Functions that run inside tasks travel with the job (pickled by value), so executors need
the libraries they use but no copy of this package.
"""
import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
