"""Row-level and grouped operators on telemetry."""
