"""cdmflow: wide clinical registry exports -> a person-centred clinical data model, on Spark.

Sub-packages: ``sources`` (scans, sinks, catalog), ``functions`` (scalar helpers, dense keys),
``operators`` (rules, fan-out, lookups, median, quality and vocabulary checks), ``plans``
(ETL and analytics), ``streaming`` (incremental registry batches).
"""

__version__ = "0.1.0"
