"""quire: a Spark-first engine that turns parsed documents into a retrieval store."""

__version__ = "0.1.0"
