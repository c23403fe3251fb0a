"""Topic discovery and growth analytics as PySpark DataFrame transformations."""

import sys

from pyspark import cloudpickle

from topicloom.contract import DataContract
from topicloom.session import build_session, materialize

# Functions sent to tasks carry their code with them, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["DataContract", "build_session", "materialize"]
