"""presslake: a Spark-native engine for news-ingestion data (articles, channel messages, raw pages)."""
