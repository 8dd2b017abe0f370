"""Operators of a training-data pipeline: tokens, secrets and personal data, duplicates, quality, mixing.

Nothing outside this package (and ``corpus_pipeline.py``) imports it; it uses ``chorale.session`` only.
"""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the Python workers with the task, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
