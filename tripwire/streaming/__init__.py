"""Structured Streaming: ingest, detectors with watermark and bounded state, sinks."""
