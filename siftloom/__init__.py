"""siftloom: a Spark-native engine for curating question banks and text corpora."""

__version__ = "0.1.0"
