"""recordloom: a Spark-native engine for turning messy multi-source records into trustworthy tables."""

__version__ = "0.1.0"
