"""tessera: a Spark-native engine for point-in-time panel research and corpus preparation."""
