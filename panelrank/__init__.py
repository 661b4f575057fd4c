"""panelrank: rank items of a daily performance panel for review, and audit the ranking, on Spark.

Subpackages: ``sources`` (scans, sinks, fixture views), ``functions`` (column
expressions), ``operators`` (DataFrame -> DataFrame operators), ``plans``
(end-to-end plans and the query registry), ``streaming`` (micro-batch rollup).
"""

__version__ = "0.1.0"
