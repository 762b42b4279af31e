"""Medallion (bronze / silver / gold) table building on PySpark.

Every operator is a function from DataFrame to DataFrame built from the
public DataFrame, SQL and Structured Streaming APIs; file I/O happens only
in ``sources``, ``sinks`` and ``streaming``.
"""

__version__ = "0.1.0"
