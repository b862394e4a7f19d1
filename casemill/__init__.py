"""casemill: keyed case records from JSON messages, on Spark DataFrames."""

__version__ = "0.1.0"
