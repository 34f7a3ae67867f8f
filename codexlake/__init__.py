"""codexlake: Spark-native analytics over scanned reference works."""
