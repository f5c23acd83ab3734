"""listora: business-directory analytics expressed as Spark jobs."""

import sys

from pyspark import cloudpickle

from listora.settings import Settings

# Functions used inside tasks travel with them; executors need no install.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["Settings"]
