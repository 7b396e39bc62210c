"""A Spark-native warehouse for nested event documents, and the analytics on it."""
