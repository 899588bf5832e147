"""newsloom: a Spark-native engine for news feeds, archives and captions."""

__version__ = "0.1.0"
