"""foliant: a PySpark-native document analytics engine."""
