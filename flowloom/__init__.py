"""flowloom: IT network-flow and server-usage analytics on PySpark DataFrames."""

__version__ = "0.1.0"
