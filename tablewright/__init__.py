"""tablewright: Spark-native tabular and text analytics.

Operators are ``DataFrame -> DataFrame`` functions (``operators``,
``functions``, ``sources``) or ``pyspark.ml``-style estimators
(``operators.models``); ``plans`` holds the distributed building blocks
(ordinal ranks, running sums, exact quantiles, size-checked joins) and
``jobs`` the end-to-end workflows and registered queries.
"""

__version__ = "0.1.0"
