"""Operators for training-data pipelines: thirteen methods, each a module of its own.

Every operator takes DataFrames and returns a DataFrame.  Nothing else in the
library imports this package.  Input rows travel as one struct column ``row``
where an operator carries them, so extra columns never clash with its own.

Functions that run in tasks travel with their code: workers need no copy of the
package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
