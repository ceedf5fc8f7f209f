"""Landing and delivery of delimited, columnar and message data as Spark jobs."""

__version__ = "0.1.0"
