"""gridlake: an electricity-market lakehouse built on Spark DataFrames.

Layers (all lazy DataFrame -> DataFrame functions, I/O only in ``sources``/``sinks``):

* ``sources``   wide CSV, lake Parquet, seeds, API payloads, hour spine, driver-table adapter
* ``operators`` bronze (wide -> long), silver (pivot, rolling features, price profile),
                gold (staging, dimensions, facts, marts), quality checks, serving queries
* ``streaming`` live price decoding and scoring (Structured Streaming)
* ``sinks``     layer writers
* ``plans``     end-to-end batch flow and the registered query catalogue
"""

__version__ = "0.1.0"
