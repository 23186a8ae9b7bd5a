"""Device telemetry quality gates and analytics as Spark DataFrame jobs."""
