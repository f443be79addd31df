"""skyherald: cross-match of optical transient alerts with multi-messenger notices, as Spark jobs."""

__version__ = "0.1.0"
