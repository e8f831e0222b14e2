"""feedlake: Spark-native ingestion of delimited feed extracts."""
