"""A Spark-native engine for the tables behind a durable background-job queue."""
