"""Mail-fraud analytics as Spark jobs: ingest, rule-based detection, reports, streams."""

__version__ = "0.1.0"
