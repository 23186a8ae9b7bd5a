"""Structured Streaming jobs: gated ingest and hourly rollup."""
