"""Sluice: analytics for flow networks on Spark.

Packages: ``sources`` reads and writes, ``functions`` are column expressions, ``operators`` take and
return DataFrames, ``plans`` compose them into the stages and the registered queries, ``streaming`` has
the label log and the event streams.
"""
