"""tidemark: change-data-capture and slowly-changing-dimension operators for Spark DataFrames.

Subpackages: ``sources`` (readers), ``sinks`` (writers), ``operators`` (SCD / merge / envelope /
mart builders), ``streaming`` (Structured Streaming jobs), ``plans`` (declarative job specs),
``functions`` (shared column expressions).
"""

__version__ = "0.1.0"
