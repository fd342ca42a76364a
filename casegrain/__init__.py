"""casegrain: a PySpark-native engine for curating evidence-backed pair datasets."""

__version__ = "0.1.0"
