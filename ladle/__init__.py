"""Web-page corpus extraction, indexing, search and crawling as Spark jobs."""

__version__ = "0.1.0"
