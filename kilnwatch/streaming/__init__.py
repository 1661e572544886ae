"""Streaming operators.

State workers do not receive files added to a session, so the processors and what they call travel whole:
nothing has to be installed on the machines that run them.
"""

import sys

from pyspark.cloudpickle import register_pickle_by_value

import kilnwatch.functions
import kilnwatch.operators
import kilnwatch.options
import kilnwatch.schemas

for _part in (
    kilnwatch.functions,
    kilnwatch.operators,
    kilnwatch.options,
    kilnwatch.schemas,
    sys.modules[__name__],
):
    register_pickle_by_value(_part)
