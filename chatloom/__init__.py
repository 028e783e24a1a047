"""chatloom: a PySpark-native engine for conversation analytics."""
