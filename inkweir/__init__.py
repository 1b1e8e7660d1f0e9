"""inkweir: a Spark-native engine for building citation-grounded text datasets."""

__version__ = "0.1.0"
