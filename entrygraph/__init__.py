"""entrygraph: a Spark-native engine for linking page text, entries and map features."""
