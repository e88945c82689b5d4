"""lodeflow: a Spark-native engine for mining, indexing and evaluating structured mentions."""
