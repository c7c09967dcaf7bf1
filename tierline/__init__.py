"""tierline: medallion (bronze -> silver -> gold -> mart) operators on Spark.

Sub-packages: ``functions`` (column expressions), ``operators``
(DataFrame -> DataFrame), ``sources`` (readers and writers), ``plans`` (the
concrete pipelines and the driver queries), ``streaming`` (incremental
ingest of landing folders with the same operators).
"""

__version__ = "0.1.0"
