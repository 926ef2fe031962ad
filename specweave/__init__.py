"""specweave: a Spark-native engine for turning specification documents into evidence-backed facts."""

__version__ = "0.1.0"
