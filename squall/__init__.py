"""squall: incident x weather analytics as Spark DataFrame jobs."""

__version__ = "0.1.0"
