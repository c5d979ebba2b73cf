"""Spark-native harmonisation of location-keyed data.

Sub-packages
------------
functions   Column -> Column helpers (text, dates, numbers, geometry arithmetic)
operators   DataFrame -> DataFrame building blocks (keys, codes, places, grids, reshaping)
sources     scans and sinks
plans       whole jobs: event cleaning and merging, indicator loading, views, reports
streaming   incremental loading on Structured Streaming
workloads   the registered queries over the benchmark tables, with their SQL twins
"""

__version__ = "0.1.0"
