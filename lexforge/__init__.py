"""lexforge: a Spark-native engine for building and checking multilingual lexicons."""
