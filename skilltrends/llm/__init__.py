"""Operators for preparing training text. Nothing outside this folder, its tests and
``corpus_pipeline.py`` imports it."""

import sys

from pyspark import cloudpickle

# tasks get the functions of this folder with their closures; executors need no copy of it
cloudpickle.register_pickle_by_value(sys.modules[__name__])
