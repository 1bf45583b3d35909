"""Batch document retrieval on Spark: corpus preparation, chunking, TF-IDF, vector search, prompts."""
