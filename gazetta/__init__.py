"""A PySpark-native analytics engine for article collections and their audience events."""
