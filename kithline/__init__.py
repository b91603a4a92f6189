"""A Spark-native engine for linking records across data sources."""
