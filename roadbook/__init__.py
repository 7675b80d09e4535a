"""Fleet analytics as Spark DataFrame jobs: staging, star schema, daily marts, alerts, reports."""

__version__ = "0.1.0"
