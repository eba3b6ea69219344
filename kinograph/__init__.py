"""kinograph: catalogue analytics written for Spark's DataFrame engine.

The core packages (``functions``, ``operators``, ``sources``, ``streaming``,
``plans``) stand alone.  ``kinograph.llm`` holds the operators for training
data; nothing outside that subpackage imports it.
"""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Functions that run in executors travel with the plan, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
