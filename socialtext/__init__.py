"""Analytics on social-media text collections, written as Spark jobs."""

__version__ = "0.1.0"
