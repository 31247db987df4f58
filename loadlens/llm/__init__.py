"""Operations for preparing training text: de-duplication, filters, tokens, mixing, language models."""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel with the task, so executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
