"""textloom: a PySpark-native engine for curating and auditing text collections."""

__version__ = "0.1.0"
