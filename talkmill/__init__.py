"""Spark-native operators for conversation data: crawl curation, cleaning,
packing, grading, chat-store queries and log streams."""

__version__ = "0.1.0"
