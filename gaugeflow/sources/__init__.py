"""Where telemetry comes from: message streams, files, catalog tables, derived events."""
