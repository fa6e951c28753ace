"""A Spark-native memory and retrieval engine."""
